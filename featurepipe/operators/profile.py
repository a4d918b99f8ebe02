"""Exploratory aggregates (A11-A14) and exact quantiles.

``exact_quantiles`` equals linear-interpolation percentiles (``percentile`` in
Spark, ``quantile_cont`` in SQL) but never gathers a group's values in one
task: it counts distinct values, ranks them with ``ordered_running_sum`` (equi-depth
value ranges) and picks the two values around each target position with a conditional max.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.functions.joins import join_null_safe
from featurepipe.operators.prefix import ordered_running_sum


def _qname(q: float) -> str:
    return f"q{round(q * 100):02d}"


def exact_quantiles(
    df: DataFrame, group_cols: Sequence[str], value: str, qs: Sequence[float] = (0.25, 0.5, 0.75),
    partitions: int | None = None,
) -> DataFrame:
    g = list(group_cols)
    vals = df.where(F.col(value).isNotNull()).groupBy(*g, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    ranked = ordered_running_sum(vals, g, "_v", ["_c"], prefix="_cum", with_totals="_n", partitions=partitions)
    first, last = F.col("_cum_c") - F.col("_c") + 1, F.col("_cum_c")
    aggs = []
    for q in qs:
        pos = F.lit(1.0) + F.lit(float(q)) * (F.col("_n") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs.append(F.max(F.when((lo >= first) & (lo <= last), F.col("_v"))).alias(f"_lo_{_qname(q)}"))
        aggs.append(F.max(F.when((hi >= first) & (hi <= last), F.col("_v"))).alias(f"_hi_{_qname(q)}"))
        aggs.append(F.first(pos - lo).alias(f"_fr_{_qname(q)}"))
    picked = ranked.groupBy(*g).agg(*aggs)
    if not g:  # no values: no row
        picked = picked.where(F.col(f"_lo_{_qname(qs[0])}").isNotNull())
    outs = []
    for q in qs:
        n = _qname(q)
        lo, hi, fr = F.col(f"_lo_{n}"), F.col(f"_hi_{n}"), F.col(f"_fr_{n}")
        outs.append((lo + (hi - lo) * fr).alias(n))
    return picked.select(*g, *outs)


def distribution_summary(df: DataFrame, by: str, value: str) -> DataFrame:
    """Count, mean, std, min, quartiles and max of ``value`` per ``by``."""
    basic = df.groupBy(by).agg(
        F.count(F.col(value)).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    return join_null_safe(basic, exact_quantiles(df, [by], value), [by], "left")


def rate_by(df: DataFrame, by: str, label: str, name: str = "fraud_rate") -> DataFrame:
    """Share of positive labels per category, highest first."""
    return df.groupBy(by).agg(F.avg(F.col(label).cast("double")).alias(name), F.count(F.lit(1)).alias("n")).orderBy(
        F.desc(name), by
    )


def pivot_counts(df: DataFrame, row: str, label: str, values=(0, 1), first_n: int | None = None) -> DataFrame:
    """``row`` × label counts, missing cells 0, sorted by ``row``; ``first_n`` cuts the report for display."""
    out = df.groupBy(row).pivot(label, list(values)).count().na.fill(0)
    out = out.select(row, *[F.col(f"`{v}`").cast("bigint").alias(f"{label}_{v}") for v in values]).orderBy(row)
    return out.limit(first_n) if first_n else out


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per label value (the per-label frame is tiny; the share is a join to the total)."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).withColumn("_one", F.lit(1))
    total = df.agg(F.count(F.lit(1)).alias("_total")).withColumn("_one", F.lit(1))  # exactly one row
    return per.join(F.broadcast(total), "_one").select(label, "n", (F.col("n") / F.col("_total")).alias("share"))
