"""Exact running sums over large ordered partitions, without one-task windows.

A window ``sum(...).over(partitionBy(p).orderBy(o))`` sends every row of a
partition value to one task. When ``p`` is small (a label, a segment, the whole
table) that task holds a third or all of the data. ``bucketed_running_sum``
computes the same numbers in two levels:

1. totals per (p, bucket), where ``bucket`` is any column monotone in the
   order key: a small frame (one row per bucket);
2. the running offset of each bucket, a window over that small frame;
3. the running sum inside each (p, bucket), a window whose partitions are
   buckets, plus the bucket's offset.

The result is exact; the bucket only decides how the work is spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurepipe.operators.scan import PID, ranged


def bucketed_running_sum(
    df: DataFrame,
    partition_cols: Sequence[str],
    bucket: str,
    order: Sequence[Column],
    sum_cols: Sequence[str],
    descending_buckets: bool = False,
    prefix: str = "cum_",
    with_totals: str | None = None,
) -> DataFrame:
    """Add ``prefix + c`` = inclusive running sum of each ``c`` in ``sum_cols``.

    ``order`` must be a total order within ``partition_cols`` (ties aggregated
    beforehand) and ``bucket`` must be non-decreasing along it (non-increasing
    when ``descending_buckets``). ``with_totals`` names an extra column holding
    the partition's grand total of the first sum column.
    """
    p = list(partition_cols)
    b = F.col(bucket).desc() if descending_buckets else F.col(bucket).asc()
    totals = df.groupBy(*p, bucket).agg(*[F.sum(c).alias(c) for c in sum_cols])
    before = Window.partitionBy(*p).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    extra = []
    if with_totals:
        extra = [F.sum(sum_cols[0]).over(Window.partitionBy(*p)).alias(with_totals)]
    offsets = totals.select(
        *p, bucket, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in sum_cols], *extra, F.lit(False).alias("_in")
    )
    # a bucket's offset is a row before its first, so rows are dealt once and null keys need no join; ``order`` is made after the dealing
    rows = df.withColumn("_in", F.lit(True)).unionByName(offsets, allowMissingColumns=True).repartition(*p, bucket)
    upto = Window.partitionBy(*p, bucket).orderBy("_in", *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select(
        *[F.col(f"`{c}`") for c in df.columns],
        "_in",
        *[F.sum(c).over(upto).alias(prefix + c) for c in sum_cols],
        *([F.max(with_totals).over(upto).alias(with_totals)] if with_totals else []),
    ).where("_in").drop("_in")


def hash_bucket(key_hex: Column, n_buckets: int) -> Column:
    """Bucket in [0, n_buckets) monotone in a hex string (first 8 hex digits)."""
    prefix = F.conv(F.substring(key_hex, 1, 8), 16, 10).cast("bigint")
    return ((prefix * F.lit(n_buckets)) / F.lit(4294967296)).cast("bigint")


def ordered_running_sum(
    df: DataFrame,
    partition_cols: Sequence[str],
    value: str,
    sum_cols: Sequence[str],
    descending: bool = False,
    prefix: str = "cum_",
    with_totals: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``bucketed_running_sum`` along ``value``, with the range partitions of (partition, value) as buckets.

    ``df`` holds one row per distinct value per partition. Range partitions are equi-depth for any values: outliers,
    values packed in a tiny range and partitions of any size. A null partition value is a partition. ``df`` is computed once.
    """
    p = list(partition_cols)
    rows = ranged(df, [*p, value], partitions)
    order = [F.col(value).desc() if descending else F.col(value).asc()]
    return bucketed_running_sum(rows, p, PID, order, sum_cols, descending, prefix, with_totals).drop(PID)
