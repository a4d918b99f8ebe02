"""Tables written to the shared folder: they cut lineage and survive the loss of executors.

Tables that a job needs no longer are emptied (``release``), so that a chain of jobs holds those of the
current one only. Arrow batches are bounded by bytes as well as rows, so that a batch of long texts or large sets
takes no more memory than one of short ones.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from featurepipe.session import work_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's path, where the job has not set it up; bound Arrow batches."""
    number, unit = re.fullmatch(r"(-?\d+)([a-z]*)", str(spark.conf.get(BATCH_CONF)).lower()).groups()
    size = int(number) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit[:1]]
    if size <= 0 or size > BATCH_BYTES:
        spark.conf.set(BATCH_CONF, f"{BATCH_BYTES}b")
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


_SCOPES: list[list[str]] = []


@contextmanager
def scope() -> Iterator[list[str]]:
    """Collects the paths of the tables that are made inside."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield made
    finally:
        _SCOPES.remove(made)


def release(spark: SparkSession, paths: list[str], but: DataFrame) -> list[str]:
    """Empty the tables at ``paths`` that ``but`` does not read; the paths that it does."""
    read = [f.replace("file:///", "/") for f in but.inputFiles()]
    kept = [p for p in paths if any(p.removeprefix("file://") in f for f in read)]
    for p in set(paths) - set(kept):
        spark.createDataFrame([], "gone int").coalesce(1).write.mode("overwrite").parquet(p)
    return kept


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{work_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    for made in _SCOPES:
        made.append(path)
    return path


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back; ``options`` are the writer's."""
    path = new_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_with(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``stored``, and aggregates of the rows taken while they are written (``n`` is their number)."""
    seen = Observation()
    path = new_path(df.sparkSession, name)
    df.observe(seen, F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in measures.items()]).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get
