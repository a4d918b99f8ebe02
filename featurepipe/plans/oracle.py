"""DuckDB SQL oracles, one per registered query key that SQL can express.

Written independently of the Spark code from the operator definitions; the
role mappings below are the fixed values both sides share.
"""

from __future__ import annotations

R = 6  # rounding digits, as in plans.common.DIGITS

# ------------------------------------------------------------ role mappings
E_TXN = """(
  SELECT event_id AS txn_id, user_id AS customer_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS merchant_id,
         value AS amount, ts,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_fraud,
         CASE event_id % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop'
                           WHEN 2 THEN 'tablet' ELSE 'pos_terminal' END AS device_type,
         event_type
  FROM events)"""

L_TXN = """(
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   CAST(round(l_extendedprice * 100) AS BIGINT)) AS txn_id,
         o_custkey AS customer_id, l_suppkey AS merchant_id,
         l_extendedprice AS amount, l_shipdate AS ts,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_fraud,
         CASE l_linenumber % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop'
                               WHEN 2 THEN 'tablet' ELSE 'pos_terminal' END AS device_type,
         l_linestatus AS event_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

MERCH = """(
  SELECT s_suppkey AS merchant_id, (s_acctbal + 1000.0) / 11000.0 AS risk_score,
         'NATION_' || CAST(s_nationkey AS VARCHAR) AS category
  FROM supplier)"""

PROF = """(
  SELECT c_custkey AS customer_id,
         CAST(floor(300.0 + 550.0 * (c_acctbal + 1000.0) / 11000.0) AS INTEGER) AS credit_score,
         CAST(30 + c_custkey % 3620 AS INTEGER) AS account_age_days,
         c_acctbal AS annual_income
  FROM customer)"""


def cust_view(txn: str) -> str:
    return f"""(
  SELECT a.customer_id, a.total_txn_count, a.avg_txn_amount, a.max_txn_amount,
         a.stddev_txn_amount, a.unique_merchants, a.historical_fraud_count,
         a.historical_fraud_rate, a.active_days, a.late_night_txn_ratio,
         p.credit_score, p.account_age_days, p.annual_income, a.feature_ts
  FROM (SELECT customer_id,
               count(*) AS total_txn_count,
               avg(amount) AS avg_txn_amount,
               max(amount) AS max_txn_amount,
               stddev_samp(amount) AS stddev_txn_amount,
               count(DISTINCT merchant_id) AS unique_merchants,
               CAST(sum(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS historical_fraud_count,
               avg(CAST(is_fraud AS DOUBLE)) AS historical_fraud_rate,
               count(DISTINCT dayofyear(ts)) AS active_days,
               avg(CASE WHEN hour(ts) < 6 OR hour(ts) > 22 THEN 1 ELSE 0 END) AS late_night_txn_ratio,
               max(ts) AS feature_ts
        FROM {txn} t GROUP BY customer_id) a
  JOIN {PROF} p ON a.customer_id = p.customer_id)"""


def rounded(x: str) -> str:
    """About 8 significant digits, decimals by magnitude (as plans.common.rounded)."""
    v = f"({x} * CAST(1.000000000001 AS DOUBLE))"
    return (f"(CASE WHEN abs({x}) < 100 THEN round({v}, 6) WHEN abs({x}) < 10000 THEN round({v}, 4) "
            f"WHEN abs({x}) < 1000000 THEN round({v}, 2) ELSE round({v}, 0) END + 0.0)")


def out(src: str, spec: str) -> str:
    """SELECT the columns of ``spec`` ('name:kind', kind d=double rounded, i=bigint, other=as is) from ``src``."""
    cols = []
    for item in spec.split():
        name, kind = item.split(":")
        if kind == "d":
            cols.append(f"{rounded(f'CAST({name} AS DOUBLE)')} AS {name}")
        elif kind == "i":
            cols.append(f"CAST({name} AS BIGINT) AS {name}")
        else:
            cols.append(name)
    return f"SELECT {', '.join(cols)} FROM {src} src"


CV_SPEC = ("customer_id:i total_txn_count:i avg_txn_amount:d max_txn_amount:d stddev_txn_amount:d "
           "unique_merchants:i historical_fraud_count:i historical_fraud_rate:d active_days:i "
           "late_night_txn_ratio:d credit_score:i account_age_days:i annual_income:d feature_ts:t")
def cust_view_out(txn: str) -> str:
    return f"""
{out(cust_view(txn), CV_SPEC)}"""



FEATURES = ("total_txn_count avg_txn_amount max_txn_amount stddev_txn_amount unique_merchants "
            "historical_fraud_count historical_fraud_rate active_days late_night_txn_ratio credit_score "
            "account_age_days annual_income").split()
FEAT_SPEC = " ".join(f"{f}:{'i' if f in ('total_txn_count', 'unique_merchants', 'historical_fraud_count', 'active_days', 'credit_score', 'account_age_days') else 'd'}" for f in FEATURES)


def txn_view(txn: str) -> str:
    return f"""(
  SELECT t.txn_id, t.customer_id, t.amount,
         t.amount / coalesce(a.cust_avg_amount, 1.0) AS amount_to_avg_ratio,
         CASE WHEN m.risk_score > 0.5 THEN 1 ELSE 0 END AS is_high_risk_merchant,
         m.risk_score AS merchant_risk_score,
         hour(t.ts) AS hour_of_day,
         CASE WHEN dayofweek(t.ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN hour(t.ts) < 6 OR hour(t.ts) > 22 THEN 1 ELSE 0 END AS is_late_night,
         t.device_type, m.category AS merchant_category, t.ts AS feature_ts,
         t.is_fraud, t.event_type
  FROM {txn} t
  LEFT JOIN {MERCH} m ON t.merchant_id = m.merchant_id
  LEFT JOIN (SELECT customer_id, avg(amount) AS cust_avg_amount FROM {txn} x GROUP BY customer_id) a
         ON t.customer_id = a.customer_id)"""


TV_SPEC = ("txn_id:{tid} customer_id:i amount:d amount_to_avg_ratio:d is_high_risk_merchant:i merchant_risk_score:d "
           "hour_of_day:i is_weekend:i is_late_night:i device_type:s merchant_category:s feature_ts:t")

# Fixed scorecard (same numbers as operators.scoring).
SCORE = ("(1.0 / (1.0 + exp(-((((((-1.5 + 2.0 * coalesce(CAST(merchant_risk_score AS DOUBLE), 0.5))"
         " + 0.8 * CAST(is_late_night AS DOUBLE)) + 0.3 * CAST(is_weekend AS DOUBLE))"
         " + 0.5 * coalesce(CAST(amount_to_avg_ratio AS DOUBLE), 1.0)) + -0.02 * CAST(hour_of_day AS DOUBLE))))))")


def scored(txn: str) -> str:
    return f"(SELECT txn_id, device_type, is_fraud, feature_ts, 1.0 - {SCORE} AS p0, {SCORE} AS p1 FROM {txn_view(txn)} v)"


def scores_table(txn: str) -> str:
    return f"(SELECT txn_id, p0, p1, feature_ts AS prediction_ts FROM {scored(txn)} s)"


def seg_metrics(txn: str) -> str:
    return f"""(
  WITH s AS (SELECT device_type, p1 AS s, is_fraud AS y FROM {scored(txn)} x WHERE p1 IS NOT NULL AND is_fraud IS NOT NULL),
  c AS (SELECT device_type, count(*) AS n,
               sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS positives,
               sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS negatives,
               sum(CASE WHEN s >= 0.5 AND y = 1 THEN 1 ELSE 0 END) AS tp,
               sum(CASE WHEN s >= 0.5 AND y = 0 THEN 1 ELSE 0 END) AS fp
        FROM s GROUP BY device_type),
  d AS (SELECT device_type, s, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS tp,
               sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS fp FROM s GROUP BY device_type, s),
  cu AS (SELECT *, sum(tp) OVER w AS ctp, sum(fp) OVER w AS cfp FROM d
         WINDOW w AS (PARTITION BY device_type ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  k AS (SELECT device_type, sum(fp * (ctp - tp / 2.0)) AS auc_num, sum(tp * ctp / (ctp + cfp)) AS ap_num
        FROM cu GROUP BY device_type),
  m AS (SELECT c.device_type, c.n, c.positives,
               CASE WHEN c.positives > 0 AND c.negatives > 0 THEN k.auc_num / (c.positives * c.negatives) END AS auc,
               CASE WHEN c.positives > 0 THEN k.ap_num / c.positives END AS ap,
               coalesce(c.tp / nullif(c.tp + c.fp, 0), 0.0) AS precision,
               coalesce(c.tp / nullif(c.positives, 0), 0.0) AS recall
        FROM c LEFT JOIN k ON c.device_type = k.device_type)
  SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM m)"""


def label_join(txn: str) -> str:
    feats = ", ".join(f"c.{f}" for f in FEATURES)
    return f"(SELECT t.txn_id, c.customer_id, {feats}, t.ts, t.is_fraud FROM {cust_view(txn)} c JOIN {txn} t ON c.customer_id = t.customer_id)"


def matrix(txn: str) -> str:
    return f"""(SELECT txn_id, {', '.join(f'coalesce(CAST({f} AS DOUBLE), 0.0) AS {f}' for f in FEATURES)},
  CAST(is_fraud AS INTEGER) AS label FROM {label_join(txn)} lj)"""


def split(txn: str) -> str:
    return f"""(
  SELECT txn_id, label,
         CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(CAST(txn_id AS VARCHAR)), txn_id)
                   <= floor(count(*) OVER (PARTITION BY label) * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split
  FROM {matrix(txn)} m)"""


MATRIX = matrix(E_TXN)
SPLIT = split(E_TXN)

FOLDS = f"""(
  SELECT txn_id, label,
         (row_number() OVER (PARTITION BY label ORDER BY md5(CAST(txn_id AS VARCHAR) || ':fold'), txn_id) - 1) % 5 AS fold
  FROM {SPLIT} s WHERE split = 'train')"""

SPINE_E = f"(SELECT txn_id, customer_id, ts, is_fraud FROM {E_TXN} t)"
ASOF_SNAPSHOT = f"""(
  SELECT s.txn_id, s.customer_id, s.ts, s.is_fraud,
         {', '.join(f'c.{f}' for f in FEATURES)}, c.feature_ts
  FROM {SPINE_E} s ASOF LEFT JOIN {cust_view(E_TXN)} c
    ON s.customer_id = c.customer_id AND s.ts >= c.feature_ts)"""
ASOF_SPEC = f"txn_id:i customer_id:i ts:t is_fraud:i {' '.join(f + ':d' for f in FEATURES)} feature_ts:t"

CLICKS = f"""(SELECT customer_id, feature_ts, amount AS last_click_amount, merchant_risk_score AS last_click_risk,
  hour_of_day AS last_click_hour FROM {txn_view(E_TXN)} v WHERE event_type = 'click')"""
ASOF_HISTORY = f"""(
  SELECT s.txn_id, s.customer_id, s.ts, s.is_fraud, c.last_click_amount, c.last_click_risk, c.last_click_hour, c.feature_ts
  FROM (SELECT txn_id, customer_id, ts, is_fraud FROM {E_TXN} t) s
  ASOF LEFT JOIN {CLICKS} c ON s.customer_id = c.customer_id AND s.ts >= c.feature_ts)"""

ASOF_ORDERS = f"""(
  SELECT * EXCLUDE (rn) FROM (
    SELECT s.txn_id, s.customer_id, s.ts, s.is_fraud, o.o_orderkey, o.o_totalprice, o.o_orderpriority,
           o.o_orderdate AS order_ts,
           row_number() OVER (PARTITION BY s.txn_id ORDER BY o.o_orderdate DESC NULLS LAST, o.o_orderkey DESC NULLS LAST) AS rn
    FROM (SELECT txn_id, customer_id, ts, is_fraud FROM {L_TXN} t) s
    LEFT JOIN orders o ON o.o_custkey = s.customer_id AND o.o_orderdate <= s.ts) x
  WHERE rn = 1)"""

E_US = f"(SELECT *, epoch_us(ts) AS us FROM {E_TXN} t)"
RUNNING = f"""(
  SELECT a.txn_id, a.customer_id, a.amount,
         count(b.txn_id) AS prior_txn_count,
         avg(b.amount) AS prior_avg_amount,
         stddev_samp(b.amount) AS prior_stddev_amount,
         coalesce(sum(CASE WHEN b.is_fraud = 1 THEN 1 ELSE 0 END), 0) AS prior_fraud_count,
         count(DISTINCT b.merchant_id) AS prior_unique_merchants
  FROM {E_US} a LEFT JOIN {E_US} b ON a.customer_id = b.customer_id AND b.us < a.us
  GROUP BY a.txn_id, a.customer_id, a.amount)"""

VELOCITY = f"""(
  SELECT a.txn_id, a.customer_id, count(b.txn_id) AS txn_count_last_hour
  FROM {E_US} a LEFT JOIN {E_US} b
    ON a.customer_id = b.customer_id AND b.us >= a.us - 3600000000 AND b.us <= a.us - 1
  GROUP BY a.txn_id, a.customer_id)"""

L_US = f"(SELECT *, epoch_us(ts) AS us FROM {L_TXN} t)"
RUNNING_L = f"""(
  SELECT a.txn_id, a.customer_id,
         count(b.txn_id) AS prior_txn_count,
         avg(b.amount) AS prior_avg_amount,
         stddev_samp(b.amount) AS prior_stddev_amount,
         coalesce(sum(CASE WHEN b.is_fraud = 1 THEN 1 ELSE 0 END), 0) AS prior_fraud_count,
         count(DISTINCT b.merchant_id) AS prior_unique_merchants
  FROM {L_US} a LEFT JOIN {L_US} b ON a.customer_id = b.customer_id AND b.us < a.us
  GROUP BY a.txn_id, a.customer_id)"""
VELOCITY_L = f"""(
  SELECT a.txn_id, a.customer_id, count(b.txn_id) AS txn_count_last_2_days
  FROM {L_US} a LEFT JOIN {L_US} b
    ON a.customer_id = b.customer_id AND b.us >= a.us - 172800000000 AND b.us <= a.us - 1
  GROUP BY a.txn_id, a.customer_id)"""

WEEK = "time_bucket(INTERVAL '7 days', {c}, TIMESTAMP '1970-01-01')"
SCORES_E = scores_table(E_TXN)
CUT_E = "TIMESTAMP '2024-01-15'"


def bin10(v: str, lo: str = "0.0", hi: str = "1.0") -> str:
    return (f"CASE WHEN {v} IS NULL OR isnan({v}) THEN -1 ELSE "
            f"CAST(least(greatest(floor(({v} - {lo}) / ({hi} - {lo}) * 10), 0), 9) AS INTEGER) END")


def psi_from_bins(binned: str, group: str, cut: str) -> str:
    """binned: rows (grp, ts, bin). Full grid of (window x bins), independent of the Spark decomposition."""
    w = WEEK.format(c="ts")
    return f"""(
  WITH b AS (SELECT * FROM {binned} z),
  base AS (SELECT grp, bin, count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY grp) AS bs
           FROM b WHERE ts < {cut} GROUP BY grp, bin),
  cur AS (SELECT grp, {w} AS w, bin, count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY grp, {w}) AS cs
          FROM b WHERE ts >= {cut} GROUP BY grp, {w}, bin),
  wins AS (SELECT DISTINCT grp, w FROM cur),
  bins AS (SELECT grp, bin FROM base UNION SELECT grp, bin FROM cur),
  g AS (SELECT wins.grp, wins.w, bins.bin, coalesce(cur.cs, 0.0) AS cs, coalesce(base.bs, 0.0) AS bs
        FROM wins JOIN bins ON wins.grp = bins.grp
        LEFT JOIN cur ON cur.grp = wins.grp AND cur.w = wins.w AND cur.bin = bins.bin
        LEFT JOIN base ON base.grp = wins.grp AND base.bin = bins.bin)
  SELECT grp AS {group}, w AS window_start,
         sum((cs + 1e-6 - (bs + 1e-6)) * ln((cs + 1e-6) / (bs + 1e-6))) AS psi,
         sum(0.5 * (CASE WHEN cs > 0 THEN cs * ln(cs / ((cs + bs) / 2)) ELSE 0 END)
           + 0.5 * (CASE WHEN bs > 0 THEN bs * ln(bs / ((cs + bs) / 2)) ELSE 0 END)) AS js
  FROM g GROUP BY grp, w)"""


SCORE_BINS = f"(SELECT 1 AS grp, prediction_ts AS ts, {bin10('p1')} AS bin FROM {SCORES_E} s WHERE prediction_ts IS NOT NULL)"


def feature_bins(rows: str, cut: str) -> str:
    unp = " UNION ALL ".join(f"SELECT ts, '{f}' AS grp, CAST({f} AS DOUBLE) AS v FROM {rows} r" for f in FEATURES)
    return f"""(
  WITH l AS ({unp}),
  rng AS (SELECT grp, min(v) AS lo, max(v) AS hi FROM l WHERE ts < {cut} GROUP BY grp)
  SELECT l.grp, l.ts,
         CASE WHEN rng.lo IS NULL THEN (CASE WHEN l.v IS NULL THEN -1 ELSE 0 END)
              WHEN rng.hi = rng.lo THEN (CASE WHEN l.v IS NULL OR isnan(l.v) THEN -1 ELSE 0 END)
              ELSE {bin10('l.v', 'rng.lo', 'rng.hi')} END AS bin
  FROM l LEFT JOIN rng ON l.grp = rng.grp WHERE l.ts IS NOT NULL)"""


def feature_quantile_bins(rows: str, cut: str) -> str:
    """Bins between the baseline's distinct deciles (the least value whose rank reaches the share)."""
    unp = " UNION ALL ".join(f"SELECT ts, '{f}' AS grp, CAST({f} AS DOUBLE) AS v FROM {rows} r" for f in FEATURES)
    shares = ", ".join(f"(CAST({i} AS DOUBLE) / 10)" for i in range(1, 10))
    return f"""(
  WITH l AS ({unp}),
  r AS (SELECT grp, v, row_number() OVER (PARTITION BY grp ORDER BY v) AS rn, count(*) OVER (PARTITION BY grp) AS n
        FROM l WHERE ts < {cut} AND v IS NOT NULL AND NOT isnan(v)),
  cuts AS (SELECT grp, list(DISTINCT v) AS c FROM r JOIN (VALUES {shares}) q(p) ON rn = greatest(1, CAST(ceil(p * n) AS BIGINT)) GROUP BY grp)
  SELECT l.grp, l.ts, CASE WHEN l.v IS NULL OR isnan(l.v) THEN -1 ELSE coalesce(len(list_filter(cuts.c, lambda x: x < l.v)), 0) END AS bin
  FROM l LEFT JOIN cuts ON l.grp = cuts.grp WHERE l.ts IS NOT NULL)"""


def ks(scores: str, cut: str) -> str:
    return f"""(
  WITH v AS (SELECT prediction_ts AS ts, p1 FROM {scores} s WHERE p1 IS NOT NULL AND NOT isnan(p1) AND prediction_ts IS NOT NULL),
  base AS (SELECT p1 FROM v WHERE ts < {cut}),
  cur AS (SELECT {WEEK.format(c='ts')} AS w, p1 FROM v WHERE ts >= {cut}),
  nb AS (SELECT count(*) AS n FROM base),
  nw AS (SELECT w, count(*) AS n FROM cur GROUP BY w),
  u AS (SELECT w, p1 AS x, 0 AS isb FROM cur UNION ALL SELECT nw.w, base.p1, 1 FROM nw CROSS JOIN base),
  c AS (SELECT w, x, sum(isb) OVER r AS cb, sum(1 - isb) OVER r AS cw FROM u
        WINDOW r AS (PARTITION BY w ORDER BY x RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
  SELECT c.w AS window_start, max(abs(c.cb * 1.0 / nb.n - c.cw * 1.0 / nw.n)) AS ks, any_value(nw.n) AS n
  FROM c JOIN nw ON c.w = nw.w CROSS JOIN nb GROUP BY c.w)"""


KS = ks(SCORES_E, CUT_E)

VERSION_MATCH = """(
  WITH r AS (SELECT row_number() OVER () AS rid, o_custkey AS model, 'V' || CAST(l_orderkey AS VARCHAR) AS model_version,
                    l_shipdate AS prediction_ts
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  v AS (SELECT o_custkey AS model, o_orderdate AS set_at, o_orderkey AS event_id, 'V' || CAST(o_orderkey AS VARCHAR) AS version FROM orders),
  j AS (SELECT r.rid, r.model, r.model_version, v.version,
               row_number() OVER (PARTITION BY r.rid ORDER BY v.set_at DESC NULLS LAST, v.event_id DESC NULLS LAST) AS rn
        FROM r LEFT JOIN v ON v.model = r.model AND v.set_at <= r.prediction_ts)
  SELECT model, count(*) AS n_rows,
         sum(CASE WHEN version IS NOT NULL AND version <> model_version THEN 1 ELSE 0 END) AS n_mismatch,
         sum(CASE WHEN version IS NULL THEN 1 ELSE 0 END) AS n_no_default
  FROM j WHERE rn = 1 GROUP BY model)"""

RESULTS = """(SELECT o_custkey AS run, o_orderpriority AS step,
  CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'P' THEN 'FAILED' ELSE 'RUNNING' END AS state,
  o_orderdate AS created_at, o_orderkey AS result_id, o_totalprice AS payload FROM orders)"""

LATEST_STATES = f"""(SELECT run, step, created_at, result_id, state FROM {RESULTS} r
  QUALIFY row_number() OVER (PARTITION BY run, step ORDER BY created_at DESC, result_id DESC) = 1)"""

RUN_LOG = f"""(
  SELECT 'segment=' || device_type AS run_id, metric, value FROM (
    UNPIVOT (SELECT device_type, CAST(auc AS DOUBLE) AS auc, CAST(ap AS DOUBLE) AS ap,
                    CAST(precision AS DOUBLE) AS precision, CAST(recall AS DOUBLE) AS recall,
                    CAST(f1 AS DOUBLE) AS f1, CAST(n AS DOUBLE) AS n, CAST(positives AS DOUBLE) AS positives
             FROM {seg_metrics(E_TXN)} m)
    ON auc, ap, precision, recall, f1, n, positives INTO NAME metric VALUE value) u
  WHERE value IS NOT NULL)"""

SQL: dict[str, str] = {
    "q01_load_time_fix": out("(SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, count(*) AS n, min(ts) AS min_ts, max(ts) AS max_ts, sum(value) AS sum_value FROM events GROUP BY 1)",
                             "day:t n:i min_ts:t max_ts:t sum_value:d"),
    "q02_customer_view": cust_view_out(E_TXN),
    "q02_customer_view_lineitem": cust_view_out(L_TXN),
    "q03_distinct_counts": out(f"(SELECT customer_id, count(DISTINCT merchant_id) AS unique_merchants, count(DISTINCT dayofyear(ts)) AS active_days FROM {E_TXN} t GROUP BY customer_id)",
                               "customer_id:i unique_merchants:i active_days:i"),
    "q04_running_features": out(RUNNING, "txn_id:i customer_id:i prior_txn_count:i prior_avg_amount:d prior_stddev_amount:d prior_fraud_count:i prior_unique_merchants:i"),
    "q05_transaction_view": out(txn_view(E_TXN), TV_SPEC.format(tid="i")),
    "q05_transaction_view_lineitem": out(txn_view(L_TXN), TV_SPEC.format(tid="s")),
    "q06_group_mean": out(f"(SELECT txn_id, customer_id, amount, avg(amount) OVER (PARTITION BY customer_id) AS cust_avg_amount FROM {E_TXN} t)",
                          "txn_id:i customer_id:i amount:d cust_avg_amount:d"),
    "q07_asof_snapshot": out(ASOF_SNAPSHOT, ASOF_SPEC),
    "q08_asof_history": out(ASOF_HISTORY, "txn_id:i customer_id:i ts:t is_fraud:i last_click_amount:d last_click_risk:d last_click_hour:d feature_ts:t"),
    "q08_asof_orders_lineitem": out(ASOF_ORDERS, "txn_id:s customer_id:i ts:t is_fraud:i o_orderkey:d o_totalprice:d o_orderpriority:s order_ts:t"),
    "q09_training_set_versioned": out(ASOF_SNAPSHOT, ASOF_SPEC),
    "q10_label_join": out(label_join(E_TXN), f"txn_id:i customer_id:i {FEAT_SPEC} ts:t is_fraud:i"),
    "q11_feature_matrix": out(MATRIX, "txn_id:i " + " ".join(f"{f}:d" for f in FEATURES) + " label:i"),
    "q12_stratified_split": out(SPLIT, "txn_id:i label:i split:s"),
    "q13_kfold": out(FOLDS, "txn_id:i label:i fold:i"),
    "q14_metrics_by_segment": out(seg_metrics(E_TXN), "device_type:s n:i positives:i auc:d ap:d precision:d recall:d f1:d"),
    "q14_metrics_by_segment_lineitem": out(seg_metrics(L_TXN), "device_type:s n:i positives:i auc:d ap:d precision:d recall:d f1:d"),
    "q18_quality_gate": out(f"""(SELECT device_type, auc, precision, recall,
        coalesce(auc >= 0.6, false) AND coalesce(precision >= 0.03, false) AND coalesce(recall >= 0.3, false) AS passed,
        concat_ws(',', CASE WHEN NOT coalesce(auc >= 0.6, false) THEN 'auc' END,
                       CASE WHEN NOT coalesce(precision >= 0.03, false) THEN 'precision' END,
                       CASE WHEN NOT coalesce(recall >= 0.3, false) THEN 'recall' END) AS failures
        FROM {seg_metrics(E_TXN)} m)""", "device_type:s auc:d precision:d recall:d passed:b failures:s"),
    "q20_amount_summary": out(f"""(SELECT is_fraud, count(amount) AS count, avg(amount) AS mean, stddev_samp(amount) AS std,
        min(amount) AS min, max(amount) AS max, quantile_cont(amount, 0.25) AS q25, quantile_cont(amount, 0.5) AS q50,
        quantile_cont(amount, 0.75) AS q75 FROM {E_TXN} t GROUP BY is_fraud)""",
                              "is_fraud:i count:i mean:d std:d min:d max:d q25:d q50:d q75:d"),
    "q21_rate_by_device": out(f"(SELECT device_type, avg(CAST(is_fraud AS DOUBLE)) AS fraud_rate, count(*) AS n FROM {E_TXN} t GROUP BY device_type)",
                              "device_type:s fraud_rate:d n:i"),
    "q22_hour_label_pivot": out(f"""(SELECT hour(ts) AS hour_of_day, sum(CASE WHEN is_fraud = 0 THEN 1 ELSE 0 END) AS is_fraud_0,
        sum(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END) AS is_fraud_1 FROM {E_TXN} t GROUP BY 1)""",
                                "hour_of_day:i is_fraud_0:i is_fraud_1:i"),
    "q23_class_balance": out(f"(SELECT is_fraud, count(*) AS n, count(*) * 1.0 / sum(count(*)) OVER () AS share FROM {E_TXN} t GROUP BY is_fraud)",
                             "is_fraud:i n:i share:d"),
    "q24_velocity": out(VELOCITY, "txn_id:i customer_id:i txn_count_last_hour:i"),
    "q25_amount_zscore": out(f"(SELECT txn_id, customer_id, CASE WHEN prior_stddev_amount > 0 THEN (amount - prior_avg_amount) / prior_stddev_amount END AS amount_zscore FROM {RUNNING} r)",
                             "txn_id:i customer_id:i amount_zscore:d"),
    "q30_score_table": out(SCORES_E, "txn_id:i p0:d p1:d prediction_ts:t"),
    "q31_score_validation": out(f"""(SELECT *, coalesce(null_rows = 0 AND max_deviation < 0.01, false) AS passed FROM (
        SELECT count(*) AS total_rows,
        sum(CASE WHEN p0 IS NULL OR p1 IS NULL OR isnan(p0) OR isnan(p1) THEN 1 ELSE 0 END) AS null_rows,
        avg(CASE WHEN NOT (p0 IS NULL OR p1 IS NULL OR isnan(p0) OR isnan(p1)) THEN p0 + p1 END) AS mean_prob_sum,
        max(CASE WHEN NOT (p0 IS NULL OR p1 IS NULL OR isnan(p0) OR isnan(p1)) THEN abs(p0 + p1 - 1.0) END) AS max_deviation
        FROM {SCORES_E} s) a)""", "total_rows:i null_rows:i mean_prob_sum:d max_deviation:d passed:b"),
    "q32_sql_scoring": out(f"(SELECT * EXCLUDE (is_fraud, event_type), {SCORE} AS fraud_probability FROM {txn_view(E_TXN)} v ORDER BY txn_id LIMIT 5)",
                           TV_SPEC.format(tid="i") + " fraud_probability:d"),
    "q33_window_summary": out(f"""(SELECT {WEEK.format(c='prediction_ts')} AS window_start, count(*) AS n, avg(p1) AS mean_score,
        stddev_samp(p1) AS std_score, sum(CASE WHEN p1 IS NULL OR isnan(p1) THEN 1 ELSE 0 END) AS null_scores
        FROM {SCORES_E} s GROUP BY 1)""", "window_start:t n:i mean_score:d std_score:d null_scores:i"),
    "q34_score_psi": out(psi_from_bins(SCORE_BINS, "grp", CUT_E), "window_start:t psi:d js:d"),
    "q35_feature_psi": out(psi_from_bins(feature_quantile_bins(label_join(E_TXN), CUT_E), "feature", CUT_E), "feature:s window_start:t psi:d js:d"),
    "q35_feature_psi_width": out(psi_from_bins(feature_bins(label_join(E_TXN), CUT_E), "feature", CUT_E), "feature:s window_start:t psi:d js:d"),
    "q35_feature_psi_lineitem": out(psi_from_bins(feature_quantile_bins(label_join(L_TXN), "TIMESTAMP '1997-01-01'"), "feature", "TIMESTAMP '1997-01-01'"),
                                    "feature:s window_start:t psi:d js:d"),
    "q36_score_ks": out(KS, "window_start:t ks:d n:i"),
    "q37_version_match": out(VERSION_MATCH, "model:i n_rows:i n_mismatch:i n_no_default:i"),
    "q40_latest_success": out(f"""(SELECT step, created_at, result_id, payload FROM {RESULTS} r WHERE state = 'SUCCEEDED'
        QUALIFY row_number() OVER (PARTITION BY step ORDER BY created_at DESC, result_id DESC) = 1)""",
                              "step:s created_at:t result_id:i payload:d"),
    "q41_latest_task_state": out(LATEST_STATES, "run:i step:s created_at:t result_id:i state:s"),
    "q42_run_completeness": out(f"""(
        WITH want(step) AS (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM')),
        grid AS (SELECT run, want.step FROM (SELECT DISTINCT run FROM {RESULTS} r) x CROSS JOIN want),
        st AS (SELECT grid.run, l.state FROM grid LEFT JOIN {LATEST_STATES} l ON l.run = grid.run AND l.step = grid.step)
        SELECT run, count(state) AS n_tasks, count(*) FILTER (state = 'SUCCEEDED') AS n_succeeded,
        CASE WHEN bool_or(coalesce(state = 'FAILED', false)) THEN 'FAILED'
             WHEN bool_and(coalesce(state = 'SUCCEEDED', false)) THEN 'DONE' ELSE 'WAITING' END AS run_status
        FROM st GROUP BY run)""", "run:i n_tasks:i n_succeeded:i run_status:s"),
    "q43_top_durations": out("""(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderpriority,
        datediff('second', o_orderdate, l_shipdate) AS duration_s
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority LIKE '1-%'
        ORDER BY duration_s DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 10)""",
                             "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i o_orderpriority:s duration_s:i"),
    "q44_run_log": out(RUN_LOG, "run_id:s metric:s value:d"),
    "q45_next_version": out("""(SELECT c_custkey AS model, 'V' || CAST(coalesce(m.mx, 0) + 1 AS VARCHAR) AS next_version
        FROM customer LEFT JOIN (SELECT o_custkey, max(CAST(nullif(regexp_extract('V' || CAST(o_orderkey AS VARCHAR), '^V(\\d+)$', 1), '') AS BIGINT)) AS mx
                                 FROM orders GROUP BY o_custkey) m ON c_custkey = m.o_custkey)""", "model:i next_version:s"),
    "q46_default_version_as_of": out("""(SELECT o_custkey AS model, o_orderdate AS set_at, o_orderkey AS event_id, 'V' || CAST(o_orderkey AS VARCHAR) AS version
        FROM orders WHERE o_orderdate <= TIMESTAMP '1997-01-01'
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)""",
                                     "model:i set_at:t event_id:i version:s"),
    "q50_incremental_view": cust_view_out(E_TXN),
}
SQL["q51_streaming_window_summary"] = SQL["q33_window_summary"]
SQL["q12_stratified_split_lineitem"] = out(split(L_TXN), "txn_id:s label:i split:s")
SQL["q36_score_ks_lineitem"] = out(ks(scores_table(L_TXN), "TIMESTAMP '1997-01-01'"), "window_start:t ks:d n:i")
SQL["q04_running_features_lineitem"] = out(RUNNING_L, "txn_id:s customer_id:i prior_txn_count:i prior_avg_amount:d prior_stddev_amount:d prior_fraud_count:i prior_unique_merchants:i")
SQL["q24_velocity_lineitem"] = out(VELOCITY_L, "txn_id:s customer_id:i txn_count_last_2_days:i")
SQL["q47_recent_task_history"] = out("""(SELECT o_orderpriority AS name, o_orderstatus AS state, o_orderdate AS scheduled_time,
        substr(concat_ws(': ', o_orderpriority, o_orderstatus), 1, 12) AS message,
        l_shipdate AS completed_time, datediff('second', o_orderdate, l_shipdate) AS duration_s,
        l_orderkey, l_linenumber, l_partkey, l_suppkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE o_orderdate > TIMESTAMP '1998-06-30' - INTERVAL 7 DAYS AND o_orderdate <= TIMESTAMP '1998-06-30'
          AND o_orderpriority LIKE '1-%'
        ORDER BY scheduled_time DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC LIMIT 20)""",
    "name:s state:s scheduled_time:t completed_time:t duration_s:i l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i message:s")
SQL["q48_result_payloads"] = out(f"""(SELECT 'segment=' || device_type AS run_id, 'training' AS step, 'SUCCESS' AS status,
        auc, recall, 0.0 AS cv_auc_mean FROM {seg_metrics(E_TXN)} m)""", "run_id:s step:s status:s auc:d recall:d cv_auc_mean:d")
SQL["q05_transaction_view_materialised"] = SQL["q05_transaction_view"]
SQL["q08_asof_two_views"] = out(f"""(SELECT a.* EXCLUDE (feature_ts), a.feature_ts AS view_ts, h.last_click_amount, h.last_click_risk, h.last_click_hour,
        h.feature_ts AS click_ts FROM {ASOF_SNAPSHOT} a JOIN {ASOF_HISTORY} h ON a.txn_id = h.txn_id)""",
    f"txn_id:i customer_id:i ts:t is_fraud:i {' '.join(f + ':d' for f in FEATURES)} view_ts:t last_click_amount:d last_click_risk:d last_click_hour:d click_ts:t")
# Tree scores have no SQL form; what must hold for every test row has.
SQL["q19_model_check"] = out(f"(SELECT txn_id, label, true AS adds_up, true AS class_fits, true AS same_as_fitted FROM {SPLIT} s WHERE split = 'test')",
                             "txn_id:i label:i adds_up:b class_fits:b same_as_fitted:b")
SQL["q26_preview"] = out(f"(SELECT txn_id, customer_id, amount, ts, is_fraud FROM {E_TXN} t ORDER BY txn_id LIMIT 10)",
                         "txn_id:i customer_id:i amount:d ts:t is_fraud:i")
SQL["q27_location_jumps"] = out(f"""(
  WITH p AS (SELECT txn_id, customer_id, ts, CAST(merchant_id * 7 % 90 - 45 AS DOUBLE) AS lat, CAST(merchant_id * 13 % 160 - 80 AS DOUBLE) AS lon FROM {E_TXN} t),
  j AS (SELECT a.*, b.ts AS bts, b.lat AS blat, b.lon AS blon FROM p a LEFT JOIN p b ON a.customer_id = b.customer_id AND b.ts < a.ts
        QUALIFY row_number() OVER (PARTITION BY a.txn_id ORDER BY b.ts DESC NULLS LAST, b.txn_id DESC NULLS LAST) = 1),
  d AS (SELECT txn_id, customer_id, 2 * 6371.0 * asin(sqrt(pow(sin(radians(lat - blat) / 2), 2)
          + cos(radians(lat)) * cos(radians(blat)) * pow(sin(radians(lon - blon) / 2), 2))) AS jump_km, epoch_us(ts) - epoch_us(bts) AS us FROM j)
  SELECT txn_id, customer_id, jump_km, jump_km / (us / 3600000000.0) AS jump_kmh FROM d)""",
    "txn_id:i customer_id:i jump_km:d jump_kmh:d")
SQL["q38_prediction_time"] = out(f"(SELECT count(*) AS n, 1 AS stamps, true AS after_data FROM {E_TXN} t)", "n:i stamps:i after_data:b")
SQL["q49_rerun_clears_results"] = out(f"""(SELECT step AS run_id, count(*) AS n, min(result_id) AS first_id,
        max(CASE WHEN step = '1-URGENT' THEN payload * 2 ELSE payload END) AS max_payload
        FROM {RESULTS} r WHERE step <> '1-URGENT' OR state = 'SUCCEEDED' GROUP BY step)""", "run_id:s n:i first_id:i max_payload:d")
SQL["q48_evaluation_gate"] = f"""SELECT 'evaluation of segment=' || device_type AS run_id, * EXCLUDE (device_type)
  FROM ({SQL["q18_quality_gate"]}) g WHERE device_type = 'pos_terminal'"""
SQL["q16_fold_check"] = out(f"(SELECT txn_id, label, fold, true AS adds_up FROM {FOLDS} f)", "txn_id:i label:i fold:i adds_up:b")
SQL["q17_model_gate"] = out(f"""(SELECT 'evaluation of FRAUD_GBT-V1' AS run_id, count(*) AS n, sum(label) AS positives, true AS gate_follows,
        true AS cv_mean_known, true AS cv_std_known FROM {SPLIT} s WHERE split = 'test')""", "run_id:s n:i positives:i gate_follows:b cv_mean_known:b cv_std_known:b")


def versioned_scores() -> str:
    """Three batches over all transactions; V1 is the default from January 5th, V2 (intercept -1.0 for -1.5) from the 15th."""
    v2 = SCORE.replace("-1.5", "-1.0")
    return f"""(
  WITH v AS (SELECT * FROM {txn_view(E_TXN)} t),
  s AS (SELECT 'given' AS run_id, 'V1' AS model_version, feature_ts AS ts, {SCORE} AS p1 FROM v
        UNION ALL SELECT 'early', 'V1', feature_ts, {SCORE} FROM v
        UNION ALL SELECT 'late', 'V2', feature_ts, {v2} FROM v),
  d AS (SELECT *, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN 'V2' WHEN ts >= TIMESTAMP '2024-01-05' THEN 'V1' END AS current FROM s)
  SELECT run_id, model_version, count(*) AS n_rows, count(*) FILTER (current <> model_version) AS n_mismatch,
         count(*) FILTER (current IS NULL) AS n_no_default, avg(p1) AS mean_p1 FROM d GROUP BY run_id, model_version)"""


SQL["q39_version_scoring"] = out(versioned_scores(), "run_id:s model_version:s n_rows:i n_mismatch:i n_no_default:i mean_p1:d")
SQL["q50_incremental_view_compacted"] = SQL["q50_incremental_view"]
SQL["q05_transaction_view_refreshed"] = SQL["q05_transaction_view"]
SQL["q33_incremental_summary"] = SQL["q33_window_summary"]
SQL["q34_incremental_psi"] = SQL["q34_score_psi"]
SQL["q51_late_rows"] = out(f"""(
  WITH s AS (SELECT prediction_ts AS ts, p1, {WEEK.format(c='prediction_ts')} AS w,
                    CASE WHEN txn_id % 8 = 0 THEN 4 ELSE (ts >= TIMESTAMP '2024-01-08')::int + (ts >= TIMESTAMP '2024-01-16')::int + (ts >= TIMESTAMP '2024-01-24')::int END AS b
             FROM {SCORES_E} x WHERE prediction_ts IS NOT NULL),
  m AS (SELECT k AS b, (SELECT max(ts) FROM s WHERE s.b < k) - INTERVAL 1 DAY AS mark FROM range(0, 6) t(k)),
  j AS (SELECT s.*, coalesce(s.w + INTERVAL 7 DAYS <= m.mark, false) AS late FROM s JOIN m ON s.b = m.b)
  SELECT w AS window_start, count(*) FILTER (NOT late) AS n, avg(p1) FILTER (NOT late) AS mean_score, stddev_samp(p1) FILTER (NOT late) AS std_score,
         count(*) FILTER (NOT late AND (p1 IS NULL OR isnan(p1))) AS null_scores, count(*) FILTER (late) AS n_late
  FROM j WHERE w + INTERVAL 7 DAYS <= (SELECT mark FROM m WHERE b = 5) GROUP BY w HAVING count(*) FILTER (NOT late) > 0)""",
    "window_start:t n:i mean_score:d std_score:d null_scores:i n_late:i")
SQL["q32_table_function"] = out(f"(SELECT txn_id, p0, p1 FROM {SCORES_E} s)", "txn_id:i p0:d p1:d")
