"""Feature views.

``customer_risk_view`` is one aggregate per customer joined to the profile;
``transaction_context_view`` enriches every transaction with its merchant and
its customer's mean amount.

Scale notes
-----------
* All per-customer aggregates are algebraic (count/sum/max/moments), so the
  aggregate runs partial-then-final: a customer holding a third of all rows
  still produces one partial row per map task, not one giant task.
* The two exact distinct counts are rewritten by Catalyst into one Expand +
  two aggregates keyed by (customer, merchant) and (customer, day): a two-stage
  pre-aggregation that shuffles distinct pairs, not raw rows.
  ``distinct_counts`` spells the same two-stage plan out by hand.
* Whether the merchant dimension is broadcast is Spark's choice by its size in bytes.
* The per-customer mean is an aggregate joined back (not a window), so a hot
  customer never lands in one window task. The aggregate's side of the join is one
  row per customer: while it is small it is broadcast. Beyond that AQE cannot split
  the join's hot customer, since that side is an aggregate above its exchange.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurepipe.fixed import CUSTOMER_VIEW_NAME, FIRST_VERSION, HIGH_RISK_MERCHANT_ABOVE, TRANSACTION_VIEW_NAME, VIEW_REFRESH
from featurepipe.functions.columns import is_late_night, is_weekend, safe_ratio
from featurepipe.functions.joins import join_hot
from featurepipe.sources.roles import Roles

# Column order of the customer view (fixed; the model input takes 12 of these).
CUSTOMER_VIEW_COLUMNS = [
    "customer_id",
    "total_txn_count",
    "avg_txn_amount",
    "max_txn_amount",
    "stddev_txn_amount",
    "unique_merchants",
    "historical_fraud_count",
    "historical_fraud_rate",
    "active_days",
    "late_night_txn_ratio",
    "credit_score",
    "account_age_days",
    "annual_income",
    "feature_ts",
]

TRANSACTION_VIEW_COLUMNS = [
    "txn_id",
    "customer_id",
    "amount",
    "amount_to_avg_ratio",
    "is_high_risk_merchant",
    "merchant_risk_score",
    "hour_of_day",
    "is_weekend",
    "is_late_night",
    "device_type",
    "merchant_category",
    "feature_ts",
]


def customer_aggregates(txn: DataFrame, key: str = "customer_id", day_of_year: bool = True, approx_rsd: float | None = None) -> DataFrame:
    """Per-customer history aggregates over all of ``txn``.

    ``day_of_year=True`` keeps the reference's ACTIVE_DAYS, which merges the
    same day of different years; ``False`` counts calendar dates.
    ``approx_rsd`` switches the two distinct counts to HyperLogLog++
    (``approx_count_distinct`` with that relative error): no Expand, one
    aggregate with bounded state per key.
    """
    day = F.dayofyear("ts") if day_of_year else F.to_date("ts")

    def distinct(c):
        return F.count_distinct(c) if approx_rsd is None else F.approx_count_distinct(c, approx_rsd)

    return txn.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_txn_count"),
        F.avg("amount").alias("avg_txn_amount"),
        F.max("amount").alias("max_txn_amount"),
        F.stddev_samp("amount").alias("stddev_txn_amount"),
        distinct(F.col("merchant_id")).alias("unique_merchants"),
        F.sum(F.when(F.col("is_fraud") == 1, 1).otherwise(0)).cast("bigint").alias("historical_fraud_count"),
        F.avg(F.col("is_fraud").cast("double")).alias("historical_fraud_rate"),
        distinct(day).alias("active_days"),
        F.avg(is_late_night("ts")).alias("late_night_txn_ratio"),
        F.max("ts").alias("feature_ts"),
    )


def customer_risk_view(r: Roles, day_of_year: bool = True, approx_rsd: float | None = None) -> DataFrame:
    """CUSTOMER_RISK_FEATURES: aggregates ⋈ profile (inner: customers missing on either side drop)."""
    agg = customer_aggregates(r.transactions, day_of_year=day_of_year, approx_rsd=approx_rsd)
    return agg.join(r.profiles, "customer_id", "inner").select(*CUSTOMER_VIEW_COLUMNS)


def distinct_counts(txn: DataFrame, key: str = "customer_id") -> DataFrame:
    """Exact UNIQUE_MERCHANTS and ACTIVE_DAYS by explicit two-stage pre-aggregation.

    Stage 1 reduces to distinct (key, merchant) and (key, day) pairs with a
    map-side combine; stage 2 counts pairs per key. The two per-key results
    come out hash-partitioned on ``key`` and are joined without a reshuffle of
    raw rows.
    """
    merchants_per_key = (
        txn.where(F.col("merchant_id").isNotNull())
        .select(key, "merchant_id")
        .distinct()
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("unique_merchants"))
    )
    days_per_key = (
        txn.where(F.col("ts").isNotNull())
        .select(key, F.dayofyear("ts").alias("doy"))
        .distinct()
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("active_days"))
    )
    keys = txn.select(key).distinct()
    return (
        keys.join(merchants_per_key, key, "left")
        .join(days_per_key, key, "left")
        .select(
            key,
            F.coalesce("unique_merchants", F.lit(0)).alias("unique_merchants"),
            F.coalesce("active_days", F.lit(0)).alias("active_days"),
        )
    )


def group_mean(txn: DataFrame, key: str = "customer_id", value: str = "amount", name: str = "cust_avg_amount") -> DataFrame:
    """A10: mean of ``value`` per ``key`` (partial + final aggregate)."""
    return txn.groupBy(key).agg(F.avg(value).alias(name))


def with_group_mean(txn: DataFrame, key: str = "customer_id", value: str = "amount", name: str = "cust_avg_amount") -> DataFrame:
    """Every row with its group's mean, as aggregate + left join.

    Equal to ``avg(value).over(partitionBy(key))`` but skew-safe: the aggregate combines
    map-side, and a key that holds a large share of the rows is joined in salted parts.
    """
    return join_hot(txn, group_mean(txn, key, value, name), key)


def transaction_context_view(r: Roles, keep: tuple[str, ...] = ()) -> DataFrame:
    """TRANSACTION_CONTEXT_FEATURES: txn ⟕ merchants ⟕ per-customer mean.

    ``keep`` passes extra transaction columns through (e.g. the label).
    """
    txn = r.transactions
    hour = F.hour("ts")
    return (
        txn.join(r.merchants, "merchant_id", "left")
        .transform(lambda df: join_hot(df, group_mean(txn), "customer_id", rows=txn))
        .select(
            "txn_id",
            "customer_id",
            "amount",
            safe_ratio("amount", "cust_avg_amount").alias("amount_to_avg_ratio"),
            F.when(F.col("risk_score") > HIGH_RISK_MERCHANT_ABOVE, 1).otherwise(0).alias("is_high_risk_merchant"),
            F.col("risk_score").alias("merchant_risk_score"),
            hour.alias("hour_of_day"),
            is_weekend("ts").alias("is_weekend"),
            is_late_night("ts").alias("is_late_night"),
            "device_type",
            F.col("category").alias("merchant_category"),
            F.col("ts").alias("feature_ts"),
            *keep,
        )
    )


@dataclass
class FeatureView:
    """A named, versioned feature view: entity keys, time column and a builder."""

    name: str
    keys: list[str]
    builder: Callable[[Roles], DataFrame]
    version: str = FIRST_VERSION
    timestamp_col: str = "feature_ts"
    refresh: str = VIEW_REFRESH
    description: str = ""
    extra: dict = field(default_factory=dict)

    @property
    def address(self) -> str:
        return f"{self.name}__{self.version}"

    def build(self, r: Roles) -> DataFrame:
        return self.builder(r)

    def materialise(self, spark: SparkSession, r: Roles, target_dir: str) -> DataFrame:
        """Overwrite the view's Parquet table and return a frame reading it back."""
        path = f"{target_dir.rstrip('/')}/{self.address}"
        self.build(r).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)


CUSTOMER_RISK_FEATURES = FeatureView(
    name=CUSTOMER_VIEW_NAME,
    keys=["customer_id"],
    builder=customer_risk_view,
    description="Customer-level risk signals",
)
TRANSACTION_CONTEXT_FEATURES = FeatureView(
    name=TRANSACTION_VIEW_NAME,
    keys=["txn_id"],
    builder=transaction_context_view,
    description="Per-transaction contextual signals",
)
