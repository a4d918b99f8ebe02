"""Scans over globally ordered rows: running values for any distribution of keys, times and values.

``ranged`` sorts a frame into range partitions: Spark samples the order columns and cuts them at
equi-depth splitters, so a partition holds about the same number of rows whether one key, one
(key, time) or one narrow range of values has half of them (the order ends with a row number
wherever ties must be split). The partitions are written with their number ``_pid``, which rises along
the order, so every reader sees the same cut and a lost executor costs no more than its tasks.

A running value is then a window inside (``_pid``, key), whose size is bounded by the partition's, plus
what the earlier partitions hand over. The hand-over is a prefix scan over a frame with a few rows
per partition: only the key that a partition begins with can have rows before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from featurepipe.session import work_dir

PID = "_pid"


def ranged(df: DataFrame, order: Sequence[str | Column], partitions: int | None = None) -> DataFrame:
    """``df`` written in range partitions of ``order``, with the partition's number ``_pid``.

    Without ``partitions`` Spark's settings decide how many there are (small ones are merged).
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    dealt = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    path = f"{work_dir(df.sparkSession)}/ranged-{uuid.uuid4().hex[:12]}"
    dealt.withColumn(PID, F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.schema(StructType([*df.schema.fields, StructField(PID, IntegerType())])).parquet(path)


def last_before(rows: DataFrame, source: Column, value: Sequence[str]) -> DataFrame:
    """(``_pid``, ``_k``, *value): the greatest ``value`` of source rows that earlier partitions hold of the key a partition begins with.

    ``rows`` are ranged by ``_k`` and then along ``value``. One row per partition is scanned.
    """
    edges = rows.groupBy(PID).agg(F.min("_k").alias("_first"), F.max(F.when(source, F.struct("_k", *value))).alias("_last"))
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    found = edges.select(PID, "_first", F.last("_last", ignorenulls=True).over(before).alias("_c"))
    return found.where(F.col("_c._k") == F.col("_first")).select(PID, "_c.*")


def _sums(sums: Sequence[str], moments: str | None) -> list[Column]:
    out = [F.sum(c).alias(c) for c in sums]
    if moments:
        n = F.count(moments)
        out += [n.alias("_cnt"), F.avg(moments).alias("_mean"), (F.coalesce(F.var_pop(moments), F.lit(0.0)) * n).alias("_m2")]
    return out


def _time_carries(rows: DataFrame, sums: Sequence[str], moments: str | None) -> DataFrame:
    """What earlier partitions hold of the key a partition begins with: (``_pid``, ``_k``, ``_us``, ``_c``).

    A partition may begin amid rows of one time. What is earlier than that time is placed just before it; that and
    the rows of the same time in earlier partitions are placed at it, where only later rows see them.
    """
    timed = rows.where(F.col("_k").isNotNull() & F.col("_us").isNotNull())
    edges = timed.groupBy(PID).agg(F.min(F.struct("_k", "_us")).alias("_first"), F.max(F.struct("_k", "_us")).alias("_last"))
    held = timed.join(edges.select(PID, "_last"), PID).where(F.col("_k") == F.col("_last._k"))
    held = held.groupBy(PID, "_k", F.col("_last._us").alias("_u"), (F.col("_us") == F.col("_last._us")).alias("_tie")).agg(*_sums(sums, moments))
    names = [*sums, *(("_cnt", "_mean", "_m2") if moments else ())]
    # rows before a partition's last time count as just before it; a partition asks from its first time
    at = F.when(F.col("_tie"), F.col("_u")).otherwise(F.col("_u") - 1)
    held = held.select(PID, "_k", at.alias("_u"), "_tie", F.lit(1).alias("_kind"), *names)
    asks = edges.select(PID, F.col("_first._k").alias("_k"), F.col("_first._us").alias("_u"), F.lit(False).alias("_tie"), F.lit(0).alias("_kind"), *[F.lit(None).cast(held.schema[c].dataType).alias(c) for c in names])
    every = held.unionByName(asks)
    # a few rows per partition and key: a key that spans all partitions has three rows of each
    earlier = Window.partitionBy("_k").orderBy("_u").rangeBetween(Window.unboundedPreceding, -1)
    tied = Window.partitionBy("_k", "_u").orderBy(PID, "_kind").rowsBetween(Window.unboundedPreceding, -1)
    parts = {c: F.col(c) for c in sums}
    if moments:  # sums around one value of the key, so that no large squares cancel
        every = every.withColumn("_shift", F.min("_mean").over(Window.partitionBy("_k")))
        d = F.col("_mean") - F.col("_shift")
        parts |= {"_cnt": F.col("_cnt"), "_a": F.col("_cnt") * d, "_b2": F.col("_cnt") * d * d, "_m2": F.col("_m2")}
    seen = every.select("*", *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_e{c}") for c, v in parts.items()],
                        *[F.coalesce(F.sum(F.when(F.col("_tie"), v)).over(tied), F.lit(0)).alias(f"_t{c}") for c, v in parts.items()],
                        F.count(F.when(F.col("_kind") == 1, 1)).over(earlier).alias("_held"), F.count(F.when(F.col("_tie"), 1)).over(tied).alias("_ties"))
    seen = seen.where("_kind = 0")

    def carry(total) -> Column:
        fields = [total(c).alias(c) for c in sums]
        if moments:
            n = total("_cnt")
            mean = F.when(n > 0, F.col("_shift") + total("_a") / n)
            m2 = F.when(n > 0, total("_m2") + total("_b2") - total("_a") * total("_a") / n)
            fields += [n.alias("_cnt"), mean.alias("_mean"), m2.alias("_m2")]
        return F.struct(*fields)

    early = seen.where("_held > 0").select(PID, "_k", (F.col("_u") - 1).alias("_us"), carry(lambda c: F.col(f"_e{c}")).alias("_c"))
    same = seen.where("_ties > 0").select(PID, "_k", F.col("_u").alias("_us"), carry(lambda c: F.col(f"_e{c}") + F.col(f"_t{c}")).alias("_c"))
    return early.unionByName(same)


def strictly_before(rows: DataFrame, sums: Sequence[str], moments: str | None = None) -> DataFrame:
    """Adds ``_before``: sums over the rows of the same ``_k`` with an earlier ``_us``; rows of one time do not see each other.

    ``rows`` are ranged by (``_k``, ``_us``, ...); the sums must not be negative. With ``moments`` (a double column) also its count
    ``_cnt``, mean ``_mean`` and sum of squared deviations ``_m2``, merged by Chan's formula.
    """
    carries = _time_carries(rows, sums, moments)
    all_rows = rows.withColumn("_kept", F.lit(True)).unionByName(carries.withColumn("_kept", F.lit(False)), allowMissingColumns=True)
    prior = Window.partitionBy(PID, "_k").orderBy("_us").rangeBetween(Window.unboundedPreceding, -1)
    # sums only grow along the key, so the greatest hand-over is the latest
    cols = [F.coalesce(F.sum(c).over(prior), F.lit(0)).alias(f"_w{c}") for c in sums] + [F.max("_c").over(prior).alias("_h")]
    if moments:
        n = F.count(moments).over(prior)
        cols += [n.alias("_wcnt"), F.avg(moments).over(prior).alias("_wmean"), (F.coalesce(F.var_pop(moments).over(prior), F.lit(0.0)) * n).alias("_wm2")]
    out = all_rows.select(*rows.columns, "_kept", *cols).where("_kept")
    fields = [(F.col(f"_w{c}") + F.coalesce(F.col(f"_h.{c}"), F.lit(0))).alias(c) for c in sums]
    if moments:
        cc, mc, m2c = F.coalesce("_h._cnt", F.lit(0)), F.col("_h._mean"), F.coalesce("_h._m2", F.lit(0.0))
        nw, mw, m2w = F.col("_wcnt"), F.col("_wmean"), F.col("_wm2")
        n, delta = cc + nw, mw - mc
        mean = F.when(nw == 0, mc).when(cc == 0, mw).otherwise(mc + delta * nw / n)
        m2 = F.when(nw == 0, m2c).when(cc == 0, m2w).otherwise(m2c + m2w + delta * delta * cc * nw / n)
        fields += [n.alias("_cnt"), mean.alias("_mean"), m2.alias("_m2")]
    return out.select(*rows.columns, F.struct(*fields).alias("_before"))
