"""Join helpers: null-safe keys, and keys that hold a large share of one side.

Which side is broadcast is left to Spark: Catalyst decides from file sizes and AQE from
the bytes a shuffle measured, both against ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left.join(right, keys, how)`` where a null key equals a null key (inner or left joins).

    A key that cannot be null on either side is compared with ``=``, which lets the join
    reuse the partitioning by that key.
    """
    maybe_null = {f.name for df in (left, right) for f in df.schema.fields if f.nullable}
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        a, b = F.col(k), F.col(f"_r_{k}")
        on = on & (a.eqNullSafe(b) if k in maybe_null else a == b)
    return left.join(right, on, how).drop(*[f"_r_{k}" for k in keys])


HOT_KEYS = 1000  # heaviest keys that a sketch reports: the bound of what is broadcast
TRACKED = 10 * HOT_KEYS  # keys that a sketch tracks


def hot_keys(df: DataFrame, key: str, parts: int) -> DataFrame:
    """(``_hot``): keys that hold more than half a task's share of the rows when ``df`` is dealt into ``parts`` tasks.

    A frequent-items sketch per task, merged: counts are off by at most rows / ``TRACKED`` or so, far below the share. At most
    ``HOT_KEYS`` rows.
    """
    live = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_k"))
    top = live.agg(F.expr(f"approx_top_k(_k, {HOT_KEYS}, {TRACKED})").alias("_top"), F.count(F.lit(1)).alias("_n"))
    found = top.select("_n", F.explode("_top").alias("_t"))
    return found.where(F.col("_t.count") * 2 * parts > F.col("_n")).select(F.col("_t.item").alias("_hot"))


def join_hot(left: DataFrame, right: DataFrame, key: str, rows: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """``left.join(right, key, "left")`` for a right side of one row per key, with heavy keys of the left side spread.

    Rows of a hot key, and rows without a key, are dealt by a hash of the whole row into as many salts as there are shuffle
    partitions; the right side repeats its row of a hot key per salt. Which keys are hot is found in the plan, over ``rows``
    (a frame with the left side's keys that is cheaper to make) or else the left side.
    """
    spark = left.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(left if rows is None else rows, key, parts))  # at most HOT_KEYS rows
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(parts)).cast("int")
    spread = F.col("_hot").isNotNull() | F.col(key).isNull()
    dealt = left.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.when(spread, salt).otherwise(0)).drop("_hot")
    copies = right.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0))))).drop("_hot")
    return dealt.join(copies, [key, "_salt"], "left").drop("_salt")
