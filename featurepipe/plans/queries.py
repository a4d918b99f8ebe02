"""Registered queries: one function (spark, sf_dir) -> DataFrame per key.

Keys follow the operator inventory (README maps them to operator ids). Every
query reads the given tables (or frames Spark derives from them) in full.
Keys ending in ``_lineitem`` run the same operator on lineitem ⋈ orders (ten
times the rows of the events mapping); they are the scale benchmark.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurepipe import fixed
from featurepipe.operators import asof, dataset, drift, ledger, metrics, model, profile, registry, scoring, views
from featurepipe.plans.common import flat
from featurepipe.session import work_dir
from featurepipe.sources.roles import roles
from featurepipe.sources.tables import read_table, spread, text_to_ntz
from featurepipe.streaming import refresh

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

BASELINE_END_EVENTS = "2024-01-15"  # drift baseline: events before this time
BASELINE_END_LINEITEM = "1997-01-01"
VERSION_AS_OF = "1997-01-01"  # time of the default-version lookup
HISTORY_AS_OF = "1998-06-30"  # stands in for CURRENT_TIMESTAMP in history queries
GATE_SEGMENT = "device_type"
EXPECTED_STEPS = ("1-URGENT", "2-HIGH", "3-MEDIUM")  # tasks a run waits for (W3)


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


# ---------------------------------------------------------------- S3 loading


@register("q01_load_time_fix")
def q01(spark, sf):
    """S3 + S9: times sent as text, parsed back to zone-less time, table overwritten, rows counted per day."""
    base = _scratch(spark, "load")
    ev = read_table(spark, sf, "events")
    ev.select("event_id", "user_id", "event_type", "value", F.col("ts").cast("string").alias("ts")).write.mode("overwrite").parquet(f"{base}/text")
    loaded = text_to_ntz(spark.read.parquet(f"{base}/text"), "ts")
    loaded.write.mode("overwrite").parquet(f"{base}/events")
    t = spark.read.parquet(f"{base}/events")
    out = t.groupBy(F.to_date("ts").cast("timestamp_ntz").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"), F.sum("value").alias("sum_value")
    )
    return flat(out)


# ---------------------------------------------------------------- feature views


def _customer_view(spark, sf, mapping="events"):
    return views.customer_risk_view(roles(spark, sf, mapping))


@register("q02_customer_view")
def q02(spark, sf):
    return flat(_customer_view(spark, sf))


@register("q02_customer_view_lineitem")
def q02l(spark, sf):
    return flat(_customer_view(spark, sf, "lineitem"))


@register("q03_distinct_counts")
def q03(spark, sf):
    return flat(views.distinct_counts(roles(spark, sf).transactions))


@register("q04_running_features")
def q04(spark, sf):
    out = asof.running_features(roles(spark, sf).transactions.select("txn_id", "customer_id", "merchant_id", "amount", "ts", "is_fraud"))
    return flat(out.select("txn_id", "customer_id", "prior_txn_count", "prior_avg_amount", "prior_stddev_amount",
                           "prior_fraud_count", "prior_unique_merchants"))


@register("q04_running_features_lineitem")
def q04l(spark, sf):
    """X1 on lineitem ⋈ orders: every time is midnight, so most rows tie with others of their day."""
    out = asof.running_features(roles(spark, sf, "lineitem").transactions.select("txn_id", "customer_id", "merchant_id", "amount", "ts", "is_fraud"))
    return flat(out.select("txn_id", "customer_id", "prior_txn_count", "prior_avg_amount", "prior_stddev_amount",
                           "prior_fraud_count", "prior_unique_merchants"))


def _joined_once(spark, sf, mapping="events", keep=()):
    """The roles, with transactions that are a join written once: the means, the heavy customers and the rows each read them.

    Joined again for the keys and amounts alone, rows are so few bytes that tasks of a set size hold, and sort, ever more of them.
    """
    r = roles(spark, sf, mapping)
    if mapping == "events":  # a scan
        return r
    path = _scratch(spark, "transactions")
    r.transactions.select("txn_id", "customer_id", "merchant_id", "amount", "ts", "device_type", *keep).write.parquet(path)
    return replace(r, transactions=spark.read.parquet(path))


@register("q05_transaction_view")
def q05(spark, sf):
    return flat(views.transaction_context_view(roles(spark, sf)))


@register("q05_transaction_view_lineitem")
def q05l(spark, sf):
    return flat(views.transaction_context_view(_joined_once(spark, sf, "lineitem")))


@register("q05_transaction_view_materialised")
def q05m(spark, sf):
    """The transaction view written as its registered table and read back."""
    return flat(views.TRANSACTION_CONTEXT_FEATURES.materialise(spark, roles(spark, sf), _scratch(spark, "views")))


@register("q06_group_mean")
def q06(spark, sf):
    txn = roles(spark, sf).transactions.select("txn_id", "customer_id", "amount")
    return flat(views.with_group_mean(txn).select("txn_id", "customer_id", "amount", "cust_avg_amount"))


# ---------------------------------------------------------------- point in time


def _spine(txn: DataFrame) -> DataFrame:
    return txn.select("txn_id", "customer_id", "ts", "is_fraud")


def _asof_snapshot(spark, sf):
    r = roles(spark, sf)
    return asof.asof_join(_spine(r.transactions), views.customer_risk_view(r), "customer_id", "ts", "feature_ts")


@register("q07_asof_snapshot")
def q07(spark, sf):
    return flat(_asof_snapshot(spark, sf), as_double=tuple(dataset.FEATURE_COLUMNS))


def _click_history(r):
    tv = views.transaction_context_view(r, keep=("event_type",)).where(F.col("event_type") == "click")
    return tv.select(
        "customer_id",
        "feature_ts",
        F.col("amount").alias("last_click_amount"),
        F.col("merchant_risk_score").alias("last_click_risk"),
        F.col("hour_of_day").alias("last_click_hour"),
    )


@register("q08_asof_history")
def q08(spark, sf):
    r = roles(spark, sf)
    return flat(asof.asof_join(_spine(r.transactions), _click_history(r), "customer_id", "ts", "feature_ts"), as_double=("last_click_hour",))


@register("q08_asof_orders_lineitem")
def q08l(spark, sf):
    r = roles(spark, sf, "lineitem")
    orders = read_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("order_ts"), "o_orderkey", "o_totalprice", "o_orderpriority"
    )
    return flat(asof.asof_join(_spine(r.transactions), orders, "customer_id", "ts", "order_ts"), as_double=("o_orderkey",))


@register("q08_asof_two_views")
def q08t(spark, sf):
    """J5 with a list of feature views: the customer view and the click history, both as of each transaction."""
    r = roles(spark, sf)
    history = [(views.customer_risk_view(r), "feature_ts", "view_ts"), (_click_history(r), "feature_ts", "click_ts")]
    return flat(asof.asof_join_all(_spine(r.transactions), history, "customer_id", "ts"), as_double=(*dataset.FEATURE_COLUMNS, "last_click_hour"))


@register("q09_training_set_versioned")
def q09(spark, sf):
    """The point-in-time training set written as FRAUD_TRAINING_DATA/V1 and read back."""
    target = _scratch(spark, "training")
    dataset.write_versioned(_asof_snapshot(spark, sf), target, fixed.TRAINING_DATASET_NAME, fixed.FIRST_VERSION)
    back = dataset.read_versioned(spark, target, fixed.TRAINING_DATASET_NAME, fixed.FIRST_VERSION)
    return flat(back, as_double=tuple(dataset.FEATURE_COLUMNS))


def _label_join(spark, sf, mapping="events"):
    """J4 as the reference runs it: the registered (materialised) customer view joined to the transactions.

    Reading the view back gives the join a file-backed side with a real size
    (and cuts lineage), from which Spark chooses the join.
    """
    r = roles(spark, sf, mapping)
    cv = views.CUSTOMER_RISK_FEATURES.materialise(spark, r, _scratch(spark, "views"))
    return dataset.label_join(spark, cv, r.transactions)


@register("q10_label_join")
def q10(spark, sf):
    return flat(_label_join(spark, sf))


def _matrix(spark, sf):
    return dataset.feature_matrix(_label_join(spark, sf))


@register("q11_feature_matrix")
def q11(spark, sf):
    return flat(_matrix(spark, sf))


def _split(spark, sf):
    return dataset.stratified_split(_matrix(spark, sf))


@register("q12_stratified_split_lineitem")
def q12l(spark, sf):
    """M2 on lineitem ⋈ orders: string ids, about a third positive."""
    split = dataset.stratified_split(dataset.feature_matrix(_label_join(spark, sf, "lineitem")))
    return flat(split.select("txn_id", "label", "split"))


@register("q12_stratified_split")
def q12(spark, sf):
    return flat(_split(spark, sf).select("txn_id", "label", "split"))


def _train_folds(split: DataFrame) -> DataFrame:
    return dataset.kfold(split.where(F.col("split") == "train"))


def _folds(spark, sf):
    return _train_folds(_split(spark, sf))


@register("q13_kfold")
def q13(spark, sf):
    return flat(_folds(spark, sf).select("txn_id", "label", "fold"))


# ---------------------------------------------------------------- metrics, gate, model


def _scored_view(spark, sf, mapping="events"):
    tv = views.transaction_context_view(_joined_once(spark, sf, mapping, ("is_fraud",)), keep=("is_fraud",))
    return scoring.score_scorecard(tv, keep=("txn_id", "device_type", "is_fraud"), prediction_ts=F.col("feature_ts"))


def _segment_metrics(spark, sf, mapping="events"):
    return metrics.binary_metrics(_scored_view(spark, sf, mapping), score="p1", label="is_fraud", segment_cols=[GATE_SEGMENT])


@register("q14_metrics_by_segment")
def q14(spark, sf):
    return flat(_segment_metrics(spark, sf))


@register("q14_metrics_by_segment_lineitem")
def q14l(spark, sf):
    return flat(_segment_metrics(spark, sf, "lineitem"))


MODEL = "FRAUD_GBT"
CV_SCORES = "FRAUD_GBT_CV"


def _registry(spark, sf) -> str:
    """The model registry of a data folder, in the shared folder: what is registered there is not fitted again."""
    return f"{work_dir(spark)}/registry-{hashlib.md5(sf.encode()).hexdigest()[:12]}"


def _registered(spark, sf, makes: dict[str, Callable[[str], None]]) -> list[str]:
    """The paths of the artefacts' first versions; those there are none of are made at the same time, then registered.

    A fit is a chain of short jobs, which leaves most of the cluster idle. The manifest has one writer, so entries follow each other.
    """
    root = _registry(spark, sf)
    known = {r.model for r in registry.versions(spark, root).where(F.col("model").isin(*makes)).select("model").distinct().collect()}
    paths = {name: f"{root}/{name}/{uuid.uuid4().hex[:12]}" for name in makes if name not in known}
    with ThreadPoolExecutor(max_workers=len(makes)) as pool:
        list(pool.map(lambda name: makes[name](paths[name]), paths))
    for name, path in paths.items():
        registry.set_default(spark, root, name, registry.register(spark, root, name, path))
    return [registry.resolve(spark, root, name)[1] for name in makes]


def _fit_saved(split: DataFrame) -> Callable[[str], None]:
    """M4 + M12: fits the model on the train rows and saves it."""
    def make(path: str) -> None:
        fitted = model.fit_gbt(model.training_table(model.equal_rows(split.where(F.col("split") == "train"))), count="_n")
        model.save_model(fitted, path)
        # scores of the model as fitted, to compare with the saved one's
        model.predict(fitted, split.where(F.col("split") == "test")).write.parquet(_fitted_scores(path))

    return make


def _saved_model(spark, sf) -> str:
    """M4 + M12: the model fitted on the train split, saved and registered."""
    return _registered(spark, sf, {MODEL: lambda path: _fit_saved(_split(spark, sf))(path)})[0]


def _fitted_scores(path: str) -> str:
    return path + "_FITTED_SCORES"


def _write_cv_scores(folds: DataFrame) -> Callable[[str], None]:
    return lambda path: model.cross_validate(folds, k=5, parallelism=5, keep=("txn_id",)).write.parquet(path)


def _cv_scores(spark, sf) -> DataFrame:
    """M5: held-out scores of the train rows, computed once per data folder."""
    return spark.read.parquet(_registered(spark, sf, {CV_SCORES: lambda path: _write_cv_scores(_folds(spark, sf))(path)})[0])


@register("q15_gbt_fit_score")
def q15(spark, sf):
    """M4 + M6 + M9 + M12: fit on the train split, save, register, score the test split table to table by the default version (rows check)."""
    out = _scratch(spark, "scores") + "/FRAUD_SCORES"
    _saved_model(spark, sf)
    registry.score_resolved(spark, _registry(spark, sf), MODEL, _split(spark, sf).where(F.col("split") == "test"), out, "batch", model.scorer(("txn_id", "label")),
                            prediction_ts=F.lit(HISTORY_AS_OF).cast("timestamp_ntz"))
    return spark.read.parquet(out).drop("run_id")


@register("q16_cross_validation")
def q16(spark, sf):
    """M5: 5-fold CV AUC per fold (rows check)."""
    return model.fold_metrics(_cv_scores(spark, sf))


@register("q16_cv_summary")
def q16s(spark, sf):
    """M5: mean and deviation of the fold AUCs (rows check)."""
    return model.cv_summary(model.fold_metrics(_cv_scores(spark, sf)))


@register("q16_fold_check")
def q16f(spark, sf):
    """M5 per train row: scored by the model of its own fold, which did not see it, with probabilities that add up."""
    rows = _cv_scores(spark, sf)
    return flat(rows.select("txn_id", "label", "fold", (F.abs(F.col("p0") + F.col("p1") - 1) < 1e-9).alias("adds_up")))


@register("q17_feature_importance")
def q17(spark, sf):
    """Features of the saved model ranked by importance (rows check)."""
    return model.feature_importance(spark, model.load_model(_saved_model(spark, sf)))


@register("q17_model_gate")
def q17g(spark, sf):
    """The fitted model's hold-out and CV metrics become its training payload; the evaluation row made of it is read back for the gate.

    The learner's figures have no SQL form; the run, the hold-out size and that the gate follows the figures have.
    """
    rows = _scratch(spark, "split")
    _split(spark, sf).write.parquet(rows)  # read by the fit, the folds and both scorings of the test rows
    split = spark.read.parquet(rows)
    path, cv_path = _registered(spark, sf, {MODEL: _fit_saved(split), CV_SCORES: _write_cv_scores(_train_folds(split))})
    test = model.predict(model.load_model(path), split.where(F.col("split") == "test"), keep=("txn_id", "label"))
    held = metrics.binary_metrics(test, score="p1", label="label")
    cv = model.cv_summary(model.fold_metrics(spark.read.parquet(cv_path))).first()
    held = held.withColumn("cv_auc_mean", F.lit(cv.cv_auc_mean)).withColumn("cv_auc_std", F.lit(cv.cv_auc_std))
    names = ["auc", "ap", "precision", "recall", "f1", "n", "positives", "cv_auc_mean", "cv_auc_std"]
    now = F.lit(HISTORY_AS_OF).cast("timestamp_ntz")
    log = _scratch(spark, "results")
    ledger.append_results(ledger.payload_rows(held.withColumn("run", F.lit(f"{MODEL}-{fixed.FIRST_VERSION}")), "run", "training", "SUCCESS", names, now), log)
    ledger.append_results(ledger.evaluation_row(spark.read.parquet(log), now), log)
    back = spark.read.parquet(log).where(F.col("step") == "evaluation")
    found = metrics.quality_gate(back.select("run_id", *[ledger.payload_metric("result", c).alias(c) for c in names]))
    meets = F.lit(True)
    for m, least in fixed.QUALITY_THRESHOLDS.items():
        meets = meets & (F.col(m) >= least)
    return flat(found.select("run_id", F.col("n").cast("bigint").alias("n"), F.col("positives").cast("bigint").alias("positives"),
                             (F.col("passed") == meets).alias("gate_follows"), F.col("cv_auc_mean").between(0, 1).alias("cv_mean_known"), (F.col("cv_auc_std") >= 0).alias("cv_std_known")))


@register("q18_quality_gate")
def q18(spark, sf):
    gated = metrics.quality_gate(_segment_metrics(spark, sf))
    return flat(gated.select(GATE_SEGMENT, "auc", "precision", "recall", "passed", "failures"))


# ---------------------------------------------------------------- exploration


@register("q19_model_check")
def q19(spark, sf):
    """M4 + M6 + M12 per test row: probabilities add up to 1, the class follows the threshold, saved model = fitted model."""
    path = _saved_model(spark, sf)
    rows = model.predict(model.load_model(path), _split(spark, sf).where(F.col("split") == "test"), keep=("txn_id", "label"))
    fitted = spark.read.parquet(_fitted_scores(path)).select("txn_id", F.col("p1").alias("fitted_p1"))
    return flat(rows.join(fitted, "txn_id", "left").select(
        "txn_id", "label",
        (F.abs(F.col("p0") + F.col("p1") - 1) < 1e-9).alias("adds_up"),
        (F.col("prediction") == F.when(F.col("p1") >= fixed.PREDICTION_THRESHOLD, 1).otherwise(0)).alias("class_fits"),
        F.col("p1").eqNullSafe(F.col("fitted_p1")).alias("same_as_fitted"),
    ))


@register("q20_amount_summary")
def q20(spark, sf):
    return flat(profile.distribution_summary(roles(spark, sf).transactions, "is_fraud", "amount"))


@register("q21_rate_by_device")
def q21(spark, sf):
    return flat(profile.rate_by(roles(spark, sf).transactions, "device_type", "is_fraud"))


@register("q22_hour_label_pivot")
def q22(spark, sf):
    txn = roles(spark, sf).transactions.withColumn("hour_of_day", F.hour("ts"))
    return flat(profile.pivot_counts(txn, "hour_of_day", "is_fraud"))


@register("q23_class_balance")
def q23(spark, sf):
    return flat(profile.class_balance(roles(spark, sf).transactions, "is_fraud"))


@register("q24_velocity")
def q24(spark, sf):
    out = asof.trailing_count(roles(spark, sf).transactions.select("txn_id", "customer_id", "ts"))
    return flat(out.select("txn_id", "customer_id", "txn_count_last_hour"))


@register("q24_velocity_lineitem")
def q24l(spark, sf):
    """X2 on lineitem ⋈ orders with a 2-day window (dates only): earlier rows within the window, same key."""
    out = asof.trailing_count(roles(spark, sf, "lineitem").transactions.select("txn_id", "customer_id", "ts"), window_us=2 * asof.DAY_US, name="txn_count_last_2_days")
    return flat(out.select("txn_id", "customer_id", "txn_count_last_2_days"))


@register("q25_amount_zscore")
def q25(spark, sf):
    out = asof.amount_zscore(asof.running_features(roles(spark, sf).transactions))
    return flat(out.select("txn_id", "customer_id", "amount_zscore"))


@register("q26_preview")
def q26(spark, sf):
    """The first ten transactions by id, a report for display."""
    return flat(roles(spark, sf).transactions.select("txn_id", "customer_id", "amount", "ts", "is_fraud").orderBy("txn_id").limit(10))


@register("q27_location_jumps")
def q27(spark, sf):
    """The tables hold no coordinates, so a transaction takes place where its merchant's number puts it."""
    txn = roles(spark, sf).transactions
    placed = txn.select("txn_id", "customer_id", "ts", (F.col("merchant_id") * 7 % 90 - 45).cast("double").alias("lat"),
                        (F.col("merchant_id") * 13 % 160 - 80).cast("double").alias("lon"))
    out = asof.location_jumps(placed, "customer_id", "ts", "lat", "lon", "txn_id")
    return flat(out.select("txn_id", "customer_id", "jump_km", "jump_kmh"))


# ---------------------------------------------------------------- scoring


def _score_table(spark, sf, mapping="events"):
    tv = views.transaction_context_view(_joined_once(spark, sf, mapping))
    scores = scoring.score_scorecard(tv, keep=("txn_id",), prediction_ts=F.col("feature_ts"))
    path = _scratch(spark, "scores") + "/FRAUD_SCORES"
    scoring.write_scores(scores, path)
    return spark.read.parquet(path)


@register("q30_score_table")
def q30(spark, sf):
    return flat(_score_table(spark, sf))


@register("q31_score_validation")
def q31(spark, sf):
    return flat(scoring.validate_scores(_score_table(spark, sf)))


@register("q32_sql_scoring")
def q32(spark, sf):
    """M11 + P12: score inside SELECT (CTE, star plus score, first 5 rows)."""
    tv = views.transaction_context_view(roles(spark, sf))
    return flat(spark.sql(
        f"""
        WITH src AS (SELECT * FROM {{tv}})
        SELECT *, {scorecard_sql()} AS fraud_probability
        FROM src ORDER BY txn_id LIMIT 5
        """,
        tv=tv,
    ))


@register("q32_table_function")
def q32t(spark, sf):
    """2.12: a model outside Spark ML called as a SQL table function over a partitioned TABLE argument."""
    spark.udtf.register("score_transactions", scoring.table_function(scoring.Scorecard()))
    terms = ", ".join(scoring.SCORECARD_WEIGHTS)
    return flat(spark.sql(
        f"""
        SELECT txn_id, p0, p1
        FROM score_transactions(TABLE(SELECT txn_id, {terms}, pmod(xxhash64(txn_id), 64) AS part FROM {{tv}}) PARTITION BY part)
        """,
        tv=views.transaction_context_view(roles(spark, sf)),
    ))


def scorecard_sql() -> str:
    z = f"{scoring.SCORECARD_INTERCEPT!r}"
    for c, w in scoring.SCORECARD_WEIGHTS.items():
        v = f"CAST({c} AS DOUBLE)"
        if c in scoring.SCORECARD_DEFAULTS:
            v = f"coalesce({v}, {scoring.SCORECARD_DEFAULTS[c]!r})"
        z = f"({z} + {w!r} * {v})"
    return f"(1.0 / (1.0 + exp(-{z})))"


@register("q38_prediction_time")
def q38(spark, sf):
    """P11 with the current time: every row of a scored table has the same stamp, later than its data."""
    tv = views.transaction_context_view(roles(spark, sf))
    path = _scratch(spark, "scores") + "/FRAUD_SCORES"
    scoring.write_scores(scoring.score_scorecard(tv, keep=("txn_id", "feature_ts")), path)
    return flat(spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("prediction_ts").alias("stamps"),
        F.min(F.col("prediction_ts") > F.col("feature_ts")).alias("after_data")))


# ---------------------------------------------------------------- drift


@register("q33_window_summary")
def q33(spark, sf):
    return flat(drift.window_summary(_score_table(spark, sf)))


@register("q34_score_psi")
def q34(spark, sf):
    return flat(drift.score_drift(_score_table(spark, sf), BASELINE_END_EVENTS))


def _profiled_drift(spark, sf, mapping, baseline_end):
    """The baseline's sketches and profile are kept as tables; the windows after it are compared with what is read back."""
    kept = _scratch(spark, "baseline")
    spread(_label_join(spark, sf, mapping).select("ts", *dataset.FEATURE_COLUMNS)).write.parquet(f"{kept}/rows")  # joined once, read per step
    rows = spark.read.parquet(f"{kept}/rows")
    cut = F.lit(baseline_end).cast("timestamp_ntz")
    base = rows.where(F.col("ts") < cut)
    drift.baseline_sketches(base, dataset.FEATURE_COLUMNS).write.parquet(f"{kept}/sketches")
    drift.baseline_profile(base, spark.read.parquet(f"{kept}/sketches")).write.parquet(f"{kept}/profile")
    return drift.profile_drift(spark.read.parquet(f"{kept}/profile"), rows.where(F.col("ts") >= cut))


@register("q35_feature_psi")
def q35(spark, sf):
    return flat(_profiled_drift(spark, sf, "events", BASELINE_END_EVENTS))


@register("q35_feature_psi_lineitem")
def q35l(spark, sf):
    return flat(_profiled_drift(spark, sf, "lineitem", BASELINE_END_LINEITEM))


@register("q35_feature_psi_width")
def q35w(spark, sf):
    """D3 over equal-width bins."""
    return flat(drift.feature_drift_width(_label_join(spark, sf), dataset.FEATURE_COLUMNS, BASELINE_END_EVENTS))


@register("q36_score_ks")
def q36(spark, sf):
    return flat(drift.ks_distance(_score_table(spark, sf), BASELINE_END_EVENTS))


@register("q36_score_ks_lineitem")
def q36l(spark, sf):
    """D4 on lineitem ⋈ orders scores: about 200 weekly windows after the baseline."""
    return flat(drift.ks_distance(_score_table(spark, sf, "lineitem"), BASELINE_END_LINEITEM))


def _version_events(spark, sf):
    o = read_table(spark, sf, "orders")
    return o.select(
        F.col("o_custkey").alias("model"),
        F.concat(F.lit("V"), F.col("o_orderkey").cast("string")).alias("version"),
        F.col("o_orderdate").alias("set_at"),
        F.col("o_orderkey").alias("event_id"),
    )


@register("q37_version_match")
def q37(spark, sf):
    """Each score row's model version against the model's default version at prediction time."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    rows = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("model"),
        F.concat(F.lit("V"), F.col("l_orderkey").cast("string")).alias("model_version"),
        F.col("l_shipdate").alias("prediction_ts"),
    )
    ev = _version_events(spark, sf).select("model", "set_at", "event_id", F.col("version").alias("default_version"))
    return flat(drift.version_match(rows, ev, default="default_version"))


@register("q39_version_scoring")
def q39(spark, sf):
    """M9 + M15 + D5: two scorecards are registered; batches score with a given version and with the default of two times.

    Every row carries the version that scored it, and is matched with the default at its prediction time.
    """
    root, out = _scratch(spark, "registry"), _scratch(spark, "scores")
    features = views.transaction_context_view(roles(spark, sf))
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    for k, (card, when) in enumerate(((scoring.Scorecard(), "2024-01-05"), (scoring.Scorecard(intercept=-1.0), BASELINE_END_EVENTS))):
        card.save(spark, f"{root}/cards/{k}")
        registry.set_default(spark, root, "SCORECARD", registry.register(spark, root, "SCORECARD", f"{root}/cards/{k}", at(when)), at(when))

    def scorer(path, rows):
        return scoring.score_scorecard(rows, keep=("txn_id", "__ts"), card=scoring.Scorecard.load(spark, path)).drop("prediction_ts")

    for run, resolve in (("given", {"version": "V1"}), ("early", {"as_of": "2024-01-10"}), ("late", {"as_of": "2024-01-20"})):
        registry.score_resolved(spark, root, "SCORECARD", features, out, run, scorer, prediction_ts=F.col("feature_ts"), **resolve)
    rows = spark.read.parquet(out)
    match = drift.version_match(rows, registry.pointers(spark, root), ["run_id", "model_version"])
    means = rows.groupBy("run_id").agg(F.avg("p1").alias("mean_p1"))
    return flat(match.join(means, "run_id").drop("model"))


# ---------------------------------------------------------------- result ledger


def _results(spark, sf):
    """Result/task ledger from orders: run = customer, step = priority, state from status."""
    o = read_table(spark, sf, "orders")
    state = F.when(F.col("o_orderstatus") == "F", F.lit(ledger.SUCCEEDED)).when(F.col("o_orderstatus") == "P", F.lit(ledger.FAILED)).otherwise(F.lit("RUNNING"))
    return o.select(
        F.col("o_custkey").alias("run"),
        F.col("o_orderpriority").alias("step"),
        state.alias("state"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderkey").alias("result_id"),
        F.col("o_totalprice").alias("payload"),
    )


@register("q40_latest_success")
def q40(spark, sf):
    out = ledger.latest_success(_results(spark, sf), "step", "state", ledger.SUCCEEDED, "created_at", "result_id", ["payload"])
    return flat(out)


def _latest_states(spark, sf):
    return ledger.latest_per_key(_results(spark, sf), ["run", "step"], ["created_at", "result_id"], ["state"])


@register("q41_latest_task_state")
def q41(spark, sf):
    return flat(_latest_states(spark, sf))


@register("q42_run_completeness")
def q42(spark, sf):
    return flat(ledger.run_completeness(_latest_states(spark, sf), "run", "step", "state", expected_tasks=EXPECTED_STEPS))


@register("q43_top_durations")
def q43(spark, sf):
    """W4 + P8 + T1: longest order-to-ship durations of urgent steps, top 10."""
    li = read_table(spark, sf, "lineitem")
    o = read_table(spark, sf, "orders").where(F.col("o_orderpriority").like("1-%"))
    j = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "o_orderpriority",
        ledger.duration_seconds("o_orderdate", "l_shipdate").alias("duration_s"),
    )
    top = j.orderBy(F.desc("duration_s"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").limit(10)
    return flat(top.drop("l_extendedprice"))


@register("q44_run_log")
def q44(spark, sf):
    """M13 + S5/S6: one run per segment, params and numeric metrics appended to the run log, read back."""
    m = _segment_metrics(spark, sf)
    raw = F.create_map(
        *[x for k in ("auc", "ap", "precision", "recall", "f1", "n", "positives") for x in (F.lit(k), F.col(k).cast("string"))],
        F.lit("feature_view"), F.lit("CUSTOMER_RISK_FEATURES__V1"),
    )
    runs = m.select(
        F.concat(F.lit("segment="), F.col(GATE_SEGMENT)).alias("run_id"),
        F.create_map(F.lit("segment"), F.col(GATE_SEGMENT), F.lit("threshold"), F.lit("0.5")).alias("params"),
        ledger.numeric_metrics(raw).alias("metrics"),
    )
    path = _scratch(spark, "runs")
    ledger.append_results(runs, path)
    back = spark.read.parquet(path)
    return flat(back.select("run_id", F.explode("metrics").alias("metric", "value")))


@register("q45_next_version")
def q45(spark, sf):
    models = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("model"))
    return flat(ledger.next_version(models, _version_events(spark, sf), "model", "version"))


@register("q46_default_version_as_of")
def q46(spark, sf):
    out = ledger.default_version_as_of(_version_events(spark, sf), "model", "version", "set_at", "event_id", VERSION_AS_OF)
    return flat(out)


@register("q47_recent_task_history")
def q47(spark, sf):
    """T1 + W4 + P8 with a lookback: urgent runs of the last 7 days before a fixed 'now', newest first."""
    li = read_table(spark, sf, "lineitem")
    o = read_table(spark, sf, "orders")
    runs = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("state"),
        F.col("o_orderdate").alias("scheduled_time"),
        F.col("l_shipdate").alias("completed_time"),
        ledger.duration_seconds("o_orderdate", "l_shipdate").alias("duration_s"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    )
    top = ledger.recent_history(runs, "scheduled_time", HISTORY_AS_OF, "7 days",
                                ["scheduled_time", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 20,
                                name_col="name", name_prefix="1-")
    # The status line of the report: name and state, cut to 12 characters.
    message = F.substring(F.concat_ws(": ", "name", "state"), 1, 12)
    return flat(top.withColumn("message", message))


@register("q48_result_payloads")
def q48(spark, sf):
    """S5 + JSON: training results appended with a VARIANT payload, every run's row read back by key."""
    m = _segment_metrics(spark, sf)
    rows = ledger.payload_rows(
        m.withColumn("run", F.concat(F.lit("segment="), F.col(GATE_SEGMENT))),
        "run", "training", "SUCCESS", ["auc", "ap", "precision", "recall", "f1"],
        created_at=F.lit(HISTORY_AS_OF).cast("timestamp_ntz"),
    )
    path = _scratch(spark, "results")
    ledger.append_results(rows, path)
    back = spark.read.parquet(path)
    return flat(back.select(
        "run_id", "step", "status",
        ledger.payload_metric("result", "auc").alias("auc"),
        ledger.payload_metric("result", "recall").alias("recall"),
        ledger.payload_metric("result", "cv_auc_mean", default=0.0).alias("cv_auc_mean"),
    ))


@register("q48_evaluation_gate")
def q48e(spark, sf):
    """Evaluate step: the newest successful training payload becomes an evaluation row, read back for the gate."""
    m = _segment_metrics(spark, sf).withColumn("run", F.concat(F.lit("segment="), F.col(GATE_SEGMENT)))
    now = F.lit(HISTORY_AS_OF).cast("timestamp_ntz")
    names = ["auc", "ap", "precision", "recall", "f1"]
    failed = F.col(GATE_SEGMENT) == "tablet"  # the last run does not succeed
    rows = ledger.payload_rows(m.where(~failed), "run", "training", "SUCCESS", names, now).unionByName(
        ledger.payload_rows(m.where(failed), "run", "training", "FAILED", names, now))
    path = _scratch(spark, "results")
    ledger.append_results(rows, path)
    ledger.append_results(ledger.evaluation_row(spark.read.parquet(path), now), path)
    back = spark.read.parquet(path).where(F.col("step") == "evaluation")
    found = back.select("run_id", *[ledger.payload_metric("result", c).alias(c) for c in ("auc", "precision", "recall")])
    return flat(metrics.quality_gate(found))


@register("q49_rerun_clears_results")
def q49(spark, sf):
    """All runs are logged, then one runs again: its earlier rows go, the others stay."""
    path = _scratch(spark, "reruns")
    first = _results(spark, sf).select(F.col("step").alias("run_id"), "state", "result_id", "payload")
    ledger.append_results(first, path)
    again = first.where((F.col("run_id") == EXPECTED_STEPS[0]) & (F.col("state") == ledger.SUCCEEDED))
    ledger.append_results(again.withColumn("payload", F.col("payload") * 2), path)
    back = spark.read.parquet(path)
    return flat(back.groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.min("result_id").alias("first_id"), F.max("payload").alias("max_payload")))


# ---------------------------------------------------------------- streaming


def _stage_files(df: DataFrame, path: str, n_files: int, order_col: str) -> None:
    """Write a frame as ``n_files`` time-ordered files, the input of a file stream."""
    df.repartitionByRange(n_files, order_col).write.mode("overwrite").parquet(path)


@register("q50_incremental_view")
def q50(spark, sf):
    """Customer view refreshed micro-batch by micro-batch equals the batch view."""
    state = refresh.new_state_dir(work_dir(spark), "custview")
    ev = read_table(spark, sf, "events")
    _stage_files(ev, f"{state}/input", 6, "ts")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 2).parquet(f"{state}/input")
    q, _ = refresh.incremental_customer_view(spark, stream, sf, state)
    q.awaitTermination()
    return flat(refresh.read_customer_view(spark, state, sf))


@register("q50_incremental_view_compacted")
def q50c(spark, sf):
    """R1 with a compaction amid the stream: half of the input, compaction, the other half by the same checkpoint."""
    state = refresh.new_state_dir(work_dir(spark), "custview")
    ev = read_table(spark, sf, "events")
    for late in (False, True):
        ev.where((F.col("event_id") % 2 == 0) == F.lit(late)).coalesce(2).write.mode("append").parquet(f"{state}/input")
        stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{state}/input")
        q, _ = refresh.incremental_customer_view(spark, stream, sf, state)
        q.awaitTermination()
        if not late:
            refresh.compact_customers(spark, state)
    return flat(refresh.read_customer_view(spark, state, sf))


@register("q05_transaction_view_refreshed")
def q05r(spark, sf):
    """The transaction view kept up to date over three batches equals its recompute."""
    state = refresh.new_state_dir(work_dir(spark), "txnview")
    ev = read_table(spark, sf, "events")
    _stage_files(ev, f"{state}/input", 3, "ts")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{state}/input")
    r = roles(spark, sf)
    refresh.incremental_transaction_view(spark, stream, r, state).awaitTermination()
    return flat(refresh.read_transaction_view(spark, state, r))


LATE_EVERY = 8  # in the late-row query, transactions whose id is a multiple of it arrive last
ARRIVALS = ("2024-01-08", "2024-01-16", "2024-01-24")  # the others arrive in four batches, cut at these times


def _arrivals(spark, sf, path: str) -> DataFrame:
    """Scores as they arrive: one file per batch, written one after the other; returns the rows with their batch."""
    scores = _score_table(spark, sf)
    number = F.lit(0)
    for t in ARRIVALS:
        number = number + (F.col("prediction_ts") >= F.lit(t).cast("timestamp_ntz")).cast("int")
    rows = scores.withColumn("batch", F.when(F.col("txn_id") % LATE_EVERY == 0, F.lit(len(ARRIVALS) + 1)).otherwise(number))
    for k in range(len(ARRIVALS) + 2):
        rows.where(F.col("batch") == k).drop("batch").coalesce(1).write.mode("append").parquet(path)
    return rows


def _monitored(spark, sf, **options):
    state = refresh.new_state_dir(work_dir(spark), "monitor")
    rows = _arrivals(spark, sf, f"{state}/input")
    stream = spark.readStream.schema(rows.drop("batch").schema).option("maxFilesPerTrigger", 1).parquet(f"{state}/input")
    monitor = refresh.ScoreMonitor(spark, state, **options)
    monitor.start(stream).awaitTermination()
    return monitor


@register("q51_late_rows")
def q51l(spark, sf):
    """R2 in append mode: closed windows of the rows in time, and how many rows of each window came after it was closed."""
    monitor = _monitored(spark, sf)
    late = monitor.late_rows().groupBy("window_start").agg(F.count(F.lit(1)).alias("n_late"))
    out = monitor.summary(closed_only=True).join(late, "window_start", "left")
    return flat(out.withColumn("n_late", F.coalesce("n_late", F.lit(0))))


@register("q33_incremental_summary")
def q33i(spark, sf):
    """D1 from the monitor's merged moments, after five batches and a compaction."""
    monitor = _monitored(spark, sf, delay_us=None)
    monitor.compact()
    return flat(monitor.summary())


@register("q34_incremental_psi")
def q34i(spark, sf):
    """D2 from the monitor's merged histograms, without a rescan of the scores."""
    return flat(_monitored(spark, sf, delay_us=None, baseline_end=BASELINE_END_EVENTS).drift())


@register("q51_streaming_window_summary")
def q51(spark, sf):
    """R2: the 7-day score summary as a watermarked streaming aggregation."""
    state = refresh.new_state_dir(work_dir(spark), "monitor")
    scores = _score_table(spark, sf)
    _stage_files(scores, f"{state}/input", 4, "prediction_ts")
    stream = spark.readStream.schema(scores.schema).option("maxFilesPerTrigger", 1).parquet(f"{state}/input")
    q, out = refresh.streaming_window_summary(stream, state)
    q.awaitTermination()
    return flat(spark.read.parquet(out))
