"""Table scans (S1) and the load-with-time-fix step (S3)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


# Setting: fact scans are hash-partitioned into so many partitions on their key. Unset (the
# default, and right for inputs of many splits) the scan stays as it is. The benchmark sets
# it, since the test tables are files of one row group, which one task reads.
SPREAD_CONF = "spark.featurepipe.factPartitions"


def read_table(spark: SparkSession, source_dir: str, name: str, spread_by: str | None = None) -> DataFrame:
    """Scan one Parquet table. Column pruning and filter pushdown reach this scan.

    ``spread_by`` names the key a fact table is partitioned on where the session sets ``SPREAD_CONF``.
    """
    df = spark.read.parquet(f"{source_dir.rstrip('/')}/{name}.parquet")
    parts = spark.conf.get(SPREAD_CONF, None) if spread_by else None
    return df.repartition(int(parts), spread_by) if parts else df


def spread(df: DataFrame) -> DataFrame:
    """``df`` in the number of partitions that the session sets for facts, if it does: small results are merged into few files otherwise."""
    parts = df.sparkSession.conf.get(SPREAD_CONF, None)
    return df.repartition(int(parts)) if parts else df


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet table at ``path``; one that does not exist yet is empty, any other failure is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def text_to_ntz(df: DataFrame, col: str, fmt: str | None = None) -> DataFrame:
    """Replace a text time column by a zone-less time column of the same name.

    As in the reference loader, the converted column moves to the end of the
    schema. Without ``fmt`` the text is ISO ('yyyy-MM-dd HH:mm:ss[.ffffff]')
    and unparseable text becomes null; with ``fmt`` it is parsed by that
    pattern. Neither path depends on the session time zone.
    """
    parsed = F.col(col).try_cast("timestamp_ntz") if fmt is None else F.to_timestamp_ntz(F.col(col), F.lit(fmt))
    return df.withColumn(f"__{col}", parsed).drop(col).withColumnRenamed(f"__{col}", col)
