import random

import pytest
from helpers import plan_text, rows_by, timedelta, ts
from pyspark.sql import functions as F

from featurepipe.operators import asof

HOUR = 3_600_000_000


def _spine(spark, rows):
    return spark.createDataFrame(rows, "sid bigint, k bigint, t timestamp_ntz")


def _feats(spark, rows):
    return spark.createDataFrame(rows, "k bigint, ft timestamp_ntz, a double, b string")


def test_asof_edge_cases(spark):
    spine = _spine(spark, [
        (1, 1, ts("2024-01-01 00:00:00")),  # before any feature row
        (2, 1, ts("2024-01-02 00:00:00")),  # equal time to a feature row
        (3, 1, ts("2024-01-05 00:00:00")),  # newest row has a null field
        (4, 2, ts("2024-01-05 00:00:00")),  # key without features
        (5, 1, None),  # no time
    ])
    feats = _feats(spark, [
        (1, ts("2024-01-01 12:00:00"), 1.0, "old"),
        (1, ts("2024-01-02 00:00:00"), 2.0, "tie"),
        (1, ts("2024-01-04 00:00:00"), None, "new"),
    ])
    inc = rows_by(asof.asof_join(spine, feats, "k", "t", "ft"), "sid")
    assert len(inc) == 5
    assert inc[1]["a"] is None and inc[1]["ft"] is None
    assert inc[2]["a"] == 2.0 and inc[2]["b"] == "tie"
    assert inc[3]["a"] is None and inc[3]["b"] == "new"  # not filled from the older row
    assert inc[4]["b"] is None and inc[5]["b"] is None
    strict = rows_by(asof.asof_join(spine, feats, "k", "t", "ft", strict=True), "sid")
    assert strict[2]["b"] == "old"


def _brute_asof(spine, feats, strict=False):
    out = {}
    for sid, k, t in spine:
        best = None
        for fk, ft, a, b in feats:
            if fk != k or t is None or ft is None:
                continue
            if ft < t or (ft == t and not strict):
                if best is None or (ft, a, b) > (best[0], best[1], best[2]):
                    best = (ft, a, b)
        out[sid] = best
    return out


@pytest.mark.parametrize("partitions", [None, 9])
def test_asof_matches_brute_force_across_partitions(spark, partitions):
    rnd = random.Random(7)
    base = ts("2024-01-01 00:00:00")
    spine = [(i, rnd.choice([1, 1, 1, 2, 3]), base + timedelta(minutes=rnd.randrange(0, 3000))) for i in range(300)]
    feats = [(rnd.choice([1, 1, 2, 3, 4]), base + timedelta(minutes=rnd.randrange(0, 3000)), float(rnd.randrange(5)), rnd.choice("xyz")) for _ in range(200)]
    for strict in (False, True):
        got = rows_by(asof.asof_join(_spine(spark, spine), _feats(spark, feats), "k", "t", "ft", strict=strict, partitions=partitions), "sid")
        want = _brute_asof(spine, feats, strict)
        assert len(got) == len(spine)
        for sid, w in want.items():
            g = got[sid]
            assert (None if g["ft"] is None else (g["ft"], g["a"], g["b"])) == w, (sid, g, w)


@pytest.mark.parametrize("partitions", [None, 11])
def test_running_features_brute_force(spark, partitions):
    rnd = random.Random(3)
    base = ts("2024-01-01 00:00:00")
    rows = []
    for i in range(250):
        t = base + timedelta(minutes=rnd.randrange(0, 4000))
        if i % 17 == 0 and rows:
            t = rows[-1][4]  # ties
        rows.append((i, rnd.choice([1, 1, 1, 2, None]), rnd.choice([None, 1, 2, 3, 4]), float(rnd.randrange(1, 50)), t, rnd.choice([0, 1]), "m", "x"))
    df = spark.createDataFrame(rows, "txn_id bigint, customer_id bigint, merchant_id bigint, amount double, ts timestamp_ntz, is_fraud int, device_type string, event_type string")
    got = rows_by(asof.running_features(df, partitions=partitions), "txn_id")
    vel = rows_by(asof.trailing_count(df, window_us=HOUR, partitions=partitions), "txn_id")
    import statistics

    for r in rows:
        prior = [p for p in rows if r[1] is not None and p[1] == r[1] and p[4] < r[4]]
        g = got[r[0]]
        assert g["prior_txn_count"] == len(prior)
        assert g["prior_fraud_count"] == sum(p[5] for p in prior)
        assert g["prior_unique_merchants"] == len({p[2] for p in prior if p[2] is not None})
        if prior:
            assert abs(g["prior_avg_amount"] - statistics.mean(p[3] for p in prior)) < 1e-9
        if len(prior) >= 2:
            assert abs(g["prior_stddev_amount"] - statistics.stdev(p[3] for p in prior)) < 1e-7
        else:
            assert g["prior_stddev_amount"] is None
        hour_prior = [p for p in rows if r[1] is not None and p[1] == r[1] and r[4] - timedelta(hours=1) <= p[4] < r[4]]
        assert vel[r[0]]["txn_count_last_hour"] == len(hour_prior)


def test_zscore(spark):
    rows = [(i, 1, 1, a, ts("2024-01-01 00:00:00") + timedelta(hours=i), 0, "m", "x") for i, a in enumerate([10.0, 10.0, 20.0, 40.0])]
    df = spark.createDataFrame(rows, "txn_id bigint, customer_id bigint, merchant_id bigint, amount double, ts timestamp_ntz, is_fraud int, device_type string, event_type string")
    z = rows_by(asof.amount_zscore(asof.running_features(df)), "txn_id")
    assert z[0]["amount_zscore"] is None and z[1]["amount_zscore"] is None
    assert z[2]["amount_zscore"] is None  # two equal earlier amounts: zero spread
    import statistics

    assert abs(z[3]["amount_zscore"] - (40 - statistics.mean([10, 10, 20])) / statistics.stdev([10, 10, 20])) < 1e-9


def _hot(spark, n=4000):
    """Half of the rows share one key and one midnight, a tenth has no key, the rest are a few rows per key."""
    k = F.when(F.col("id") % 2 == 0, F.lit(1)).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 500 + 2).cast("bigint")
    t = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 40).cast("int"))
    return spark.range(0, n, 1, 4).select(F.col("id").alias("txn_id"), k.alias("customer_id"), (F.col("id") % 7).alias("merchant_id"), (F.col("id") % 97).cast("double").alias("amount"),
                                          t.alias("ts"), (F.col("id") % 3 == 0).cast("int").alias("is_fraud"))


def _sizes(spark, monkeypatch, run):
    """Rows per window partition (range partition, key) and per range partition of what ``run`` scans."""
    made = []
    real = asof.ranged

    def spy(*args, **kw):
        made.append(real(*args, **kw))
        return made[-1]

    monkeypatch.setattr(asof, "ranged", spy)
    out = run()
    rows = made[0]
    return out, [r["count"] for r in rows.groupBy("_pid", "_k").count().collect()], [r["count"] for r in rows.groupBy("_pid").count().collect()]


def test_one_key_at_one_time_is_split_into_balanced_tasks(spark, monkeypatch):
    df = _hot(spark)
    feats = df.select("customer_id", F.col("ts").alias("ft"), F.col("amount").alias("a"))
    parts = 16
    for run, rows in (
        (lambda: asof.asof_join(df, feats, "customer_id", "ts", "ft", partitions=parts), 8000 - 400),
        (lambda: asof.running_features(df, partitions=parts), 4000),
        (lambda: asof.trailing_count(df, partitions=parts), 8000),
    ):
        out, groups, tasks = _sizes(spark, monkeypatch, run)
        # one key at one time is half of all rows; no window holds more than a partition, no partition twice its share
        assert len(tasks) == parts and max(tasks) < 2.0 * rows / parts
        assert max(groups) <= max(tasks)
        assert out.count() == 4000


def test_rows_of_one_time_across_partitions_do_not_see_each_other(spark):
    df = _hot(spark)
    got = {r.txn_id: r for r in asof.running_features(df, partitions=16).collect()}
    vel = {r.txn_id: r.n for r in asof.trailing_count(df, window_us=48 * 24 * HOUR, name="n", partitions=16).collect()}
    rows = df.collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r.customer_id, []).append(r)
    for r in rows:
        prior = [p for p in by_key[r.customer_id] if r.customer_id is not None and p.ts < r.ts] if r.customer_id != 1 else []
        g = got[r.txn_id]
        assert (g.prior_txn_count, g.prior_fraud_count, g.prior_unique_merchants) == (len(prior), sum(p.is_fraud for p in prior), len({p.merchant_id for p in prior}))
        assert vel[r.txn_id] == len(prior)
        if prior:
            assert abs(g.prior_avg_amount - sum(p.amount for p in prior) / len(prior)) < 1e-9


def test_later_rows_see_all_of_a_time_that_spans_partitions(spark):
    """3,000 rows at one time, then one row: it sees them all, in count, mean, deviation, frauds and as-of match."""
    import statistics

    tie = spark.range(3000).select(F.col("id").alias("txn_id"), F.lit(1).cast("bigint").alias("customer_id"), (F.col("id") % 7).alias("merchant_id"), (F.col("id") % 89).cast("double").alias("amount"),
                                   F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), (F.col("id") % 2).cast("int").alias("is_fraud"))
    late = tie.limit(1).withColumn("txn_id", F.lit(9999).cast("bigint")).withColumn("ts", F.lit("2024-01-01 00:30:00").cast("timestamp_ntz"))
    df = tie.unionByName(late)
    g = asof.running_features(df, partitions=9).where("txn_id = 9999").first()
    amounts = [float(i % 89) for i in range(3000)]
    assert (g.prior_txn_count, g.prior_fraud_count, g.prior_unique_merchants) == (3000, 1500, 7)
    assert abs(g.prior_avg_amount - statistics.mean(amounts)) < 1e-9 and abs(g.prior_stddev_amount - statistics.stdev(amounts)) < 1e-9
    assert asof.trailing_count(df, partitions=9).where("txn_id = 9999").first().txn_count_last_hour == 3000
    feats = tie.select("customer_id", F.col("ts").alias("ft"), F.col("amount").alias("a"), F.col("txn_id").alias("b"))
    hit = asof.asof_join(df, feats, "customer_id", "ts", "ft", partitions=9)
    assert hit.where("a = 88.0 AND b = 2936").count() == 3001  # the largest of the tied feature rows, for every row of its time and later
    strict = asof.asof_join(df, feats, "customer_id", "ts", "ft", strict=True, partitions=9)
    assert strict.where("b = 2936").count() == 1 and strict.where("b IS NULL").count() == 3000


def test_location_jumps(spark):
    rows = [
        (1, 1, ts("2024-01-01 00:00:00"), 0.0, 0.0),
        (2, 1, ts("2024-01-01 01:00:00"), 0.0, 1.0),  # 1 degree of longitude on the equator in one hour
        (3, 1, ts("2024-01-01 01:00:00"), 0.0, 5.0),  # same time as row 2: neither is the other's previous row
        (4, 2, ts("2024-01-01 00:00:00"), 10.0, 10.0),
    ]
    df = spark.createDataFrame(rows, "id bigint, k bigint, t timestamp_ntz, lat double, lon double")
    out = rows_by(asof.location_jumps(df, "k", "t", "lat", "lon", "id"), "id")
    assert out[1]["jump_km"] is None and out[4]["jump_km"] is None
    assert abs(out[2]["jump_km"] - 111.19492664455873) < 1e-6
    assert abs(out[2]["jump_kmh"] - 111.19492664455873) < 1e-6
    assert abs(out[3]["jump_km"] - 5 * 111.19492664455873) < 1e-3


def _same_rows(a, b):
    assert a.columns == b.columns and a.count() == b.count()
    left, right = rows_by(a, "txn_id"), rows_by(b, "txn_id")
    for i, r in left.items():
        for c, v in r.items():
            w = right[i][c]
            assert (abs(v - w) < 1e-9 if isinstance(v, float) and w is not None else v == w), (i, c, v, w)


@pytest.mark.parametrize("hot", [1 << 19, 600, 1])  # no heavy key, one, all
def test_light_keys_by_windows_heavy_ones_by_scan(spark, monkeypatch, hot):
    df = _hot(spark).withColumn("merchant_id", F.when(F.col("txn_id") % 11 != 0, F.col("merchant_id")))
    monkeypatch.setattr(asof, "HOT_ROWS", hot)
    _same_rows(asof.running_features(df), asof.running_features(df, partitions=5))
    df = df.withColumn("ts", F.when(F.col("txn_id") % 31 != 0, F.col("ts")))
    _same_rows(asof.trailing_count(df, window_us=9 * 24 * HOUR), asof.trailing_count(df, window_us=9 * 24 * HOUR, partitions=5))


def test_rows_are_dealt_once_by_key(spark):
    for out in (asof.running_features(_hot(spark)), asof.trailing_count(_hot(spark))):
        assert plan_text(out, "simple").count("Exchange") == 1 and "Join" not in plan_text(out, "simple")
