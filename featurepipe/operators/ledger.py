"""Result-ledger, task-state and model-version queries.

Every "latest row per key" is a ``max_by``-style aggregate over a struct
ordered by (time, tie-break id), not a ``row_number`` window: the aggregate
combines map-side, so a key with a third of all rows costs one partial row per
map task.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurepipe.functions.columns import version_number

SUCCEEDED, FAILED = "SUCCEEDED", "FAILED"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Row with the largest ``order`` tuple per key (W1 generalised, W2), as one aggregate."""
    top = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload])).alias("_top")
    return df.groupBy(*keys).agg(top).select(*keys, *[F.col("_top").getField(c).alias(c) for c in [*order, *payload]])


def latest_success(results: DataFrame, step_col: str, status_col: str, success: str, created: str, tiebreak: str, payload: Sequence[str]) -> DataFrame:
    """Latest successful row per step (the reference's ORDER BY created DESC LIMIT 1, for all steps at once)."""
    ok = results.where(F.col(status_col) == success)
    return latest_per_key(ok, [step_col], [created, tiebreak], payload)


def run_completeness(latest_states: DataFrame, run_col: str, task_col: str, state_col: str, expected_tasks: Sequence[str]) -> DataFrame:
    """FAILED if the latest state of an expected task failed; DONE if all of them succeeded; else WAITING.

    Only tasks named in ``expected_tasks`` count: a run with none of them is WAITING.
    """
    names = sorted(set(expected_tasks))
    expected = F.col(task_col).isin(names)
    agg = latest_states.groupBy(run_col).agg(
        F.count_distinct(F.when(expected, F.col(task_col))).alias("n_tasks"),
        F.count_distinct(F.when(expected & (F.col(state_col) == SUCCEEDED), F.col(task_col))).alias("n_succeeded"),
        F.max(F.when(expected & (F.col(state_col) == FAILED), 1).otherwise(0)).alias("_failed"),
    )
    status = (
        F.when(F.col("_failed") == 1, F.lit("FAILED"))
        .when(F.col("n_succeeded") == len(names), F.lit("DONE"))
        .otherwise(F.lit("WAITING"))
    )
    return agg.select(run_col, "n_tasks", "n_succeeded", status.alias("run_status"))


def duration_seconds(start, end) -> Column:
    """Whole seconds from ``start`` to ``end``."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("SECOND", s, e)


def next_version(models: DataFrame, versions: DataFrame, model_col: str, version_col: str) -> DataFrame:
    """M14: 'V' + (largest 'V<n>' + 1) per model; 'V1' for a model with no valid version."""
    top = versions.groupBy(model_col).agg(F.max(version_number(version_col)).alias("_max"))
    nxt = F.concat(F.lit("V"), (F.coalesce(F.col("_max"), F.lit(0)) + 1).cast("string"))
    return models.select(model_col).distinct().join(top, model_col, "left").select(model_col, nxt.alias("next_version"))


def default_version_as_of(events: DataFrame, model_col: str, version_col: str, set_at: str, tiebreak: str, as_of: str) -> DataFrame:
    """The default version per model at time ``as_of``: the last promote/rollback set at or before it."""
    cut = F.lit(as_of).cast("timestamp_ntz")
    return latest_per_key(events.where(F.col(set_at) <= cut), [model_col], [set_at, tiebreak], [version_col])


def numeric_metrics(raw: Column) -> Column:
    """Keep only entries of a map<string,string> whose value is a number, as map<string,double>."""
    kept = F.map_filter(raw, lambda k, v: v.try_cast("double").isNotNull())
    return F.transform_values(kept, lambda k, v: v.cast("double"))


def append_results(df: DataFrame, path: str, run_col: str = "run_id") -> None:
    """S5 + S6: append result rows keyed by run, replacing only that run's earlier rows.

    Dynamic partition overwrite on ``run_col``: a replayed run replaces its own
    partition and keeps every other run, where the reference deleted all rows.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(run_col)
        .parquet(path)
    )


def result_row(spark: SparkSession, run_id: str, step: str, status: str, payload: Mapping, created_at: Column | None = None) -> DataFrame:
    """One result-table row (step, status, JSON payload, created time), as the reference inserts it."""
    df = spark.createDataFrame([(run_id, step, status, json.dumps(payload))], "run_id string, step string, status string, result string")
    ts = created_at if created_at is not None else F.current_timestamp().cast("timestamp_ntz")
    return df.withColumn("created_at", ts)


def recent_history(df: DataFrame, ts_col: str, as_of: str, lookback: str, order: Sequence[str], limit: int,
                   name_col: str | None = None, name_prefix: str | None = None) -> DataFrame:
    """T1 with a lookback: rows in (as_of - lookback, as_of], optional name prefix, newest first, first ``limit``.

    ``lookback`` is an interval literal such as '24 hours' (the reference's
    DATEADD('hour', -24, now)); ``as_of`` stands in for the current time so the
    query is reproducible. The limit is the feature here (a top-k report):
    Spark plans it as TakeOrderedAndProject, a bounded per-task heap.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    start = now - F.expr(f"INTERVAL {lookback}")
    rows = df.where((F.col(ts_col) > start) & (F.col(ts_col) <= now))
    if name_prefix is not None:
        rows = rows.where(F.col(name_col).startswith(name_prefix))
    return rows.orderBy(*[F.desc(c) for c in order]).limit(limit)


def payload_rows(df: DataFrame, run_col: str, step: str, status: str, metric_cols: Sequence[str], created_at: Column) -> DataFrame:
    """Result rows (run, step, status, VARIANT payload, created time) built from metric columns."""
    payload = F.to_json(F.struct(F.lit(status).alias("status"), F.lit(step).alias("step"),
                                 F.struct(*[F.col(c) for c in metric_cols]).alias("metrics")))
    return df.select(
        F.col(run_col).alias("run_id"),
        F.lit(step).alias("step"),
        F.lit(status).alias("status"),
        F.parse_json(payload).alias("result"),
        created_at.alias("created_at"),
    )


def evaluation_row(results: DataFrame, created_at: Column, of_step: str = "training", success: str = "SUCCESS") -> DataFrame:
    """The payload of the newest successful ``of_step`` row copied to a row of step ``evaluation``; no row without one.

    Ties of time go to the largest run id. One aggregate with map-side partial results.
    """
    done = results.where((F.col("step") == of_step) & (F.col("status") == success))
    newest = F.max_by(F.struct("run_id", "result"), F.struct("created_at", "run_id")).alias("_top")
    return done.agg(newest).where(F.col("_top").isNotNull()).select(
        F.concat(F.lit("evaluation of "), F.col("_top.run_id")).alias("run_id"),
        F.lit("evaluation").alias("step"), F.lit(success).alias("status"), F.col("_top.result").alias("result"), created_at.alias("created_at"))


def payload_metric(result: str, name: str, default: float | None = None) -> Column:
    """Key lookup in a VARIANT payload, with a default for a missing key."""
    v = F.try_variant_get(F.col(result), f"$.metrics.{name}", "double")
    return F.coalesce(v, F.lit(default).cast("double")) if default is not None else v
