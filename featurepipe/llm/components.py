"""Connected components of an edge table by alternating large-star and small-star steps.

Each step groups with a map-side combinable ``min`` and joins the minimum back. The
aggregate never gathers a hub's edges, but the join deals them by the hub's id: the edges of
one hub meet in one task there. Edge tables are written after each round, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.store import stored, stored_with


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.filter("v < u")
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(low, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component): the smallest id reachable, for every id that has an edge to another.

    Null ends, loops and repeated edges are ignored; without edges the result is empty.
    """
    e = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
               .filter(F.col(a).isNotNull() & F.col(b).isNotNull()).filter("u <> v").distinct(), "edges")
    seen = None
    while True:
        e, now = stored_with(_star(_star(e, True), False), "edges", mark=F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
        if now == seen or not now["n"]:
            break
        seen = now
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
