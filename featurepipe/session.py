"""Session helpers: a local session for tests/bench, and the shared work folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of this package relies on. AQE re-plans joins at runtime
# (broadcast conversion from real sizes, skew-join splitting, partition
# coalescing); they are defaults in Spark 4 but are pinned here explicitly.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "featurepipe") -> SparkSession:
    """A local session for tests and the benchmark (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("FEATUREPIPE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for materialised tables and checkpoints.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (shared
    storage visible to every executor). Only when it is unset and the master is
    local (tests, the benchmark) do we create one of our own and register it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext on this client: the setting must be given
        if path:
            return path.rstrip("/")
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running featurepipe jobs") from None
    path = path or sc.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running featurepipe jobs")
    path = tempfile.mkdtemp(prefix="featurepipe-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir().rstrip("/")
