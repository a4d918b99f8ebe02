"""Model versions as tables (M9, M12, M14, M15): a manifest of artefacts, default pointers, and scoring that resolves them.

``versions`` holds a row per registered artefact (model, version, path), written after the artefact is
complete, so a version that can be resolved can be loaded. ``pointers`` holds a row per promote or rollback. Both
are append-only, so what was the default at any time stays known; scored rows carry the version that made them.
One writer registers versions of a model at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from featurepipe.operators.ledger import default_version_as_of, latest_per_key, next_version
from featurepipe.sources.tables import read_or_empty

VERSIONS = "model string, version string, path string, registered_at timestamp_ntz, event_id bigint"
POINTERS = "model string, version string, set_at timestamp_ntz, event_id bigint"
Scorer = Callable[[str, DataFrame], DataFrame]  # (artefact path, features) -> rows with p0 and p1


def versions(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root}/versions", VERSIONS)


def pointers(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root}/pointers", POINTERS)


def _append(spark: SparkSession, table: DataFrame, path: str, model: str, values: Sequence, at: Column | None) -> None:
    """One row (model, *values, time, event id): ids rise along the table."""
    last = table.agg(F.coalesce(F.max("event_id"), F.lit(0))).first()[0]
    time = at if at is not None else F.current_timestamp().cast("timestamp_ntz")
    names = [f.name for f in table.schema.fields]
    row = spark.createDataFrame([(model, *values)], ", ".join(f"{n} string" for n in names[:-2]))
    row.select("*", time.alias(names[-2]), F.lit(last + 1).cast("bigint").alias(names[-1])).coalesce(1).write.mode("append").parquet(path)


def register(spark: SparkSession, root: str, model: str, path: str, at: Column | None = None) -> str:
    """Enter a complete artefact under the model's next version; returns the version."""
    known = versions(spark, root)
    version = next_version(spark.createDataFrame([(model,)], "model string"), known, "model", "version").first().next_version
    _append(spark, known, f"{root}/versions", model, (version, path), at)
    return version


def set_default(spark: SparkSession, root: str, model: str, version: str, at: Column | None = None) -> None:
    """Promote (or roll back to) a registered version."""
    _path(spark, root, model, version)
    _append(spark, pointers(spark, root), f"{root}/pointers", model, (version,), at)


def _path(spark: SparkSession, root: str, model: str, version: str) -> str:
    mine = versions(spark, root).where(F.col("model") == model)
    found = latest_per_key(mine.where(F.col("version") == version), ["model", "version"], ["event_id"], ["path"]).first()
    if found is None:
        names = sorted(r.version for r in mine.select("version").distinct().limit(20).collect())
        raise ValueError(f"{model} has no version {version}; registered: {names}")
    return found.path


def resolve(spark: SparkSession, root: str, model: str, version: str | None = None, as_of: str | None = None) -> tuple[str, str]:
    """(version, path): the given version, or else the default (as of a time, if given)."""
    if version is None:
        events = pointers(spark, root).where(F.col("model") == model)
        if as_of is None:
            found = latest_per_key(events, ["model"], ["set_at", "event_id"], ["version"]).first()
        else:
            found = default_version_as_of(events, "model", "version", "set_at", "event_id", as_of).first()
        if found is None:
            raise ValueError(f"{model} has no default version" + (f" as of {as_of}" if as_of else ""))
        version = found.version
    return version, _path(spark, root, model, version)


def score_resolved(
    spark: SparkSession, root: str, model: str, features: DataFrame, out_path: str, run_id: str, scorer: Scorer,
    version: str | None = None, as_of: str | None = None, prediction_ts: Column | None = None,
) -> tuple[str, int]:
    """M9: score a whole table with the resolved version; every row carries model, version and prediction time.

    Rows are written as one run of the score history; a run that is repeated replaces itself. Returns the version
    and the number of rows, taken while they are written.
    """
    version, path = resolve(spark, root, model, version, as_of)
    seen = Observation()
    ts = prediction_ts if prediction_ts is not None else F.current_timestamp().cast("timestamp_ntz")
    scored = scorer(path, features.withColumn("__ts", ts)).withColumnRenamed("__ts", "prediction_ts")
    scored = scored.withColumn("model", F.lit(model)).withColumn("model_version", F.lit(version)).withColumn("run_id", F.lit(run_id))
    scored = scored.observe(seen, F.count(F.lit(1)).alias("n"))
    scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(out_path)
    return version, seen.get["n"]
