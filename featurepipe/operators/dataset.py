"""Training sets.

``stratified_split`` and ``kfold`` give every row an exact rank within its
label, ordered by a salted md5 of its id, without a window over a whole label:
the rank is computed by ``bucketed_running_sum`` over 2^14 hash buckets, so a
window holds about n / 2^14 rows of one label.
Test rows are the first round(fraction * n_label) of each label, so label
shares are kept exactly; folds are (rank - 1) % k on the train rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurepipe import fixed
from featurepipe.operators.prefix import bucketed_running_sum, hash_bucket

# Model input: the 12 customer-view features, in this order (fixed values).
FEATURE_COLUMNS = fixed.FEATURE_COLUMNS


def label_join(spark: SparkSession, customer_view: DataFrame, txn: DataFrame) -> DataFrame:
    """J4 (S2): every transaction with its customer's features and its label, as SQL text.

    The reference runs this join as SQL; so do we, with DataFrames bound as
    parameters (no global temp views). It repeats a customer's row for each of
    its transactions and keeps the reference's leak (history includes the
    row's own label).
    """
    feats = ", ".join(f"c.{c}" for c in FEATURE_COLUMNS)
    return spark.sql(
        f"""
        SELECT t.txn_id, c.customer_id, {feats}, t.ts, t.is_fraud
        FROM {{cv}} c
        JOIN {{txn}} t ON c.customer_id = t.customer_id
        """,
        cv=customer_view,
        txn=txn,
    )


def feature_matrix(df: DataFrame, cols: Sequence[str] = FEATURE_COLUMNS, label: str = "is_fraud", keep: Sequence[str] = ("txn_id",)) -> DataFrame:
    """M1: fixed column order, nulls filled with 0, integer label."""
    out = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols], F.col(label).cast("int").alias("label"))
    return out.na.fill(0.0, list(cols))


DEFAULT_HASH_BUCKETS = 1 << 14  # few enough that map tasks combine the rows of a bucket before they are counted


def salted_rank(
    df: DataFrame,
    id_col: str,
    label: str,
    salt: str = "",
    n_buckets: int = DEFAULT_HASH_BUCKETS,
    name: str = "_rank",
) -> DataFrame:
    """Exact 1-based rank of each row within its label, ordered by (md5(id || salt), id); adds ``_n`` = label size.

    The hash prefix fixes the bucket (2^14 by default, so a window sees
    about n / 2^14 rows of a label); bucket totals, their running offsets and
    the label sizes come from one small aggregate inside the same plan, so no
    count reaches the driver.
    """
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(salt)))
    staged = df.withColumn("_hb", hash_bucket(h, n_buckets)).withColumn("_one", F.lit(1).cast("bigint"))
    ranked = bucketed_running_sum(staged, [label], "_hb", [h, F.col(id_col)], ["_one"], prefix="_cum", with_totals="_n")
    return ranked.withColumnRenamed("_cum_one", name).drop("_hb", "_one")


def stratified_split(
    df: DataFrame,
    id_col: str = "txn_id",
    label: str = "label",
    test_fraction: float = fixed.TEST_FRACTION,
    salt: str = "",
    n_buckets: int = DEFAULT_HASH_BUCKETS,
) -> DataFrame:
    """M2: add ``split`` = 'test' for the first floor(test_fraction * n_label + 0.5) rows of each label."""
    ranked = salted_rank(df, id_col, label, salt, n_buckets)
    n_test = F.floor(F.col("_n") * F.lit(test_fraction) + F.lit(0.5))
    return ranked.withColumn("split", F.when(F.col("_rank") <= n_test, F.lit("test")).otherwise(F.lit("train"))).drop("_rank", "_n")


def kfold(
    train: DataFrame,
    k: int = fixed.CV_FOLDS,
    id_col: str = "txn_id",
    label: str = "label",
    salt: str = ":fold",
    n_buckets: int = DEFAULT_HASH_BUCKETS,
) -> DataFrame:
    """M3: stratified fold id in [0, k) for each train row: (rank - 1) % k under a second salt."""
    ranked = salted_rank(train, id_col, label, salt, n_buckets)
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_n")


def write_versioned(df: DataFrame, target_dir: str, name: str, version: str, overwrite: bool = False) -> str:
    """Materialise a named, versioned dataset; returns its path. An existing version fails unless ``overwrite``."""
    path = f"{target_dir.rstrip('/')}/datasets/{name}/{version}"
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)
    return path


def read_versioned(spark: SparkSession, target_dir: str, name: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{target_dir.rstrip('/')}/datasets/{name}/{version}")
