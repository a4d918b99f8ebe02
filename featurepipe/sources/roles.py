"""Role frames: the reference's transactions / merchants / profiles over the given tables.

Two mappings:

* ``events`` (E-map): one transaction per event, real times of day, 30 days.
* ``lineitem`` (L-map): one transaction per lineitem joined to its order;
  several years of dates, used for scale runs.

Every frame is a lazy projection of a Parquet scan, so Catalyst prunes the
unused columns and pushes filters into the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurepipe.sources.tables import read_table

# Fixed values of the role mapping (must equal the oracle SQL).
DEVICE_TYPES = ("mobile", "desktop", "tablet", "pos_terminal")  # by event_id % 4
FRAUD_EVENT_TYPE = "error"
FRAUD_RETURN_FLAG = "R"


def merchants(spark: SparkSession, source_dir: str) -> DataFrame:
    s = read_table(spark, source_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("merchant_id"),
        ((F.col("s_acctbal") + 1000.0) / 11000.0).alias("risk_score"),
        F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("category"),
    )


def profiles(spark: SparkSession, source_dir: str) -> DataFrame:
    c = read_table(spark, source_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.floor(300.0 + 550.0 * (F.col("c_acctbal") + 1000.0) / 11000.0).cast("int").alias("credit_score"),
        (F.lit(30) + F.col("c_custkey") % 3620).cast("int").alias("account_age_days"),
        F.col("c_acctbal").alias("annual_income"),
    )


def event_transactions(spark: SparkSession, source_dir: str) -> DataFrame:
    return events_to_transactions(read_table(spark, source_dir, "events", spread_by="event_id"))


def events_to_transactions(e: DataFrame) -> DataFrame:
    """The E-map on any frame with the events schema (batch or streaming)."""
    device = F.element_at(F.array(*[F.lit(d) for d in DEVICE_TYPES]), (F.col("event_id") % 4 + 1).cast("int"))
    return e.select(
        F.col("event_id").alias("txn_id"),
        F.col("user_id").alias("customer_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("merchant_id"),
        F.col("value").alias("amount"),
        F.col("ts"),
        F.when(F.col("event_type") == FRAUD_EVENT_TYPE, 1).otherwise(0).alias("is_fraud"),
        device.alias("device_type"),
        F.col("event_type"),
    )


def lineitem_transactions(spark: SparkSession, source_dir: str) -> DataFrame:
    li = read_table(spark, source_dir, "lineitem", spread_by="l_orderkey")
    o = read_table(spark, source_dir, "orders").select("o_orderkey", "o_custkey")
    # (orderkey, linenumber) is not unique in the fixture; these five columns are.
    txn_id = F.concat_ws(
        "-",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.round(F.col("l_extendedprice") * 100).cast("bigint"),
    )
    device = F.element_at(F.array(*[F.lit(d) for d in DEVICE_TYPES]), (F.col("l_linenumber") % 4 + 1).cast("int"))
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        txn_id.alias("txn_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_suppkey").alias("merchant_id"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_shipdate").alias("ts"),
        F.when(F.col("l_returnflag") == FRAUD_RETURN_FLAG, 1).otherwise(0).alias("is_fraud"),
        device.alias("device_type"),
        F.col("l_linestatus").alias("event_type"),
    )


@dataclass(frozen=True)
class Roles:
    """The three input roles of the feature views, for one mapping of one data directory."""

    transactions: DataFrame
    merchants: DataFrame
    profiles: DataFrame


def roles(spark: SparkSession, source_dir: str, mapping: str = "events") -> Roles:
    if mapping == "events":
        txn = event_transactions(spark, source_dir)
    elif mapping == "lineitem":
        txn = lineitem_transactions(spark, source_dir)
    else:
        raise ValueError(f"unknown mapping {mapping!r}")
    return Roles(txn, merchants(spark, source_dir), profiles(spark, source_dir))
