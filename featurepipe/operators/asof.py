"""Point-in-time operators.

All of them need rows of one key in time order. ``running_features`` and ``trailing_count`` deal the rows by key, once, and
take windows over each key; what follows holds for keys of more than ``HOT_ROWS`` rows, and for all rows of ``asof_join``.

They range-partition the rows by (key, time, row)
and scan the partitions (``operators.scan``): a key, a day or a single midnight that holds half of all
rows is many partitions of about equal size, since ties in time are cut by a row number. What a partition must know of
earlier ones comes from a frame with a few rows per partition:

* ``asof_join``: the last feature row of the key that the partition begins with;
* ``running_features``, ``trailing_count``: the totals of that key's earlier rows, those of the
  partition's first time apart, since rows of one time do not see each other.

Nothing depends on a time bucket, and no row reaches the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurepipe.functions.columns import epoch_micros
from featurepipe.operators.scan import PID, last_before, ranged, strictly_before
from featurepipe.session import work_dir

DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000
HOT_ROWS = 1 << 19  # rows of a key that one window task may hold


def _columns(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def asof_join(
    spine: DataFrame,
    features: DataFrame,
    key: str,
    spine_ts: str,
    feature_ts: str,
    feature_cols: Sequence[str] | None = None,
    strict: bool = False,
    feature_ts_alias: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Left as-of join: each spine row gets the latest feature row of its key at or before its time.

    * ``strict=True`` only takes feature rows strictly before the spine time.
    * The feature row is carried as one struct, so a null field of the newest
      row stays null (it is never filled from an older row).
    * Ties between feature rows at the same time resolve to the largest row
      (deterministic); spine rows without a match, without a key or without a time keep null features.
    * Every spine row is kept exactly once.
    """
    if feature_cols is None:
        feature_cols = [c for c in features.columns if c not in (key, feature_ts)]
    feature_cols = list(feature_cols)
    fts_out = feature_ts_alias or (feature_ts if feature_ts not in spine.columns else f"{feature_ts}_feature")
    clash = set(feature_cols) & set(spine.columns)
    if clash:
        raise ValueError(f"feature columns clash with spine columns: {sorted(clash)}")

    spine_tag, feat_tag = (0, 1) if strict else (1, 0)  # the order of rows of one time
    f_struct = F.struct(F.col(feature_ts).alias("_fts"), *[F.col(f"`{c}`") for c in feature_cols])
    feats = features.where(F.col(key).isNotNull() & F.col(feature_ts).isNotNull()).select(
        F.col(key).alias("_k"), epoch_micros(feature_ts).alias("_us"), F.lit(feat_tag).alias("_t"), f_struct.alias("_f")
    )
    sp = spine.select(F.col(key).alias("_k"), epoch_micros(spine_ts).alias("_us"), F.lit(spine_tag).alias("_t"), F.struct(*_columns(spine)).alias("_s"))
    rows = sp.unionByName(feats, allowMissingColumns=True).withColumn("_u", F.monotonically_increasing_id())
    rows = ranged(rows, ["_k", "_us", "_t", "_u"], partitions).drop("_u")

    carried = last_before(rows, F.col("_t") == feat_tag, ["_us", "_f"])
    rows = rows.unionByName(carried.withColumn("_t", F.lit(-1)), allowMissingColumns=True)
    upto = Window.partitionBy(PID, "_k").orderBy("_us", "_t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.max(F.when(F.col("_t") != spine_tag, F.struct("_us", "_f"))).over(upto)
    matched = rows.select("_t", "_us", "_s", last.getField("_f").alias("_f")).where(F.col("_t") == spine_tag)
    timed = F.col("_us").isNotNull()  # as in SQL's ASOF JOIN, a null time matches nothing
    return matched.select(
        *[F.col("_s").getField(c).alias(c) for c in spine.columns],
        *[F.when(timed, F.col("_f").getField(c)).alias(c) for c in feature_cols],
        F.when(timed, F.col("_f").getField("_fts")).alias(fts_out),
    )


def asof_join_all(spine: DataFrame, views: Sequence[tuple[DataFrame, str, str]], key: str, spine_ts: str, **options) -> DataFrame:
    """J5 over several feature views: each (features, time column, name of the matched time) is joined as of the spine time in turn.

    Every spine row is kept once; column names of the views must differ from each other and from the spine's.
    """
    out = spine
    for features, feature_ts, alias in views:
        out = asof_join(out, features, key, spine_ts, feature_ts, feature_ts_alias=alias, **options)
    return out


def _per_key(txn: DataFrame, key: str, partitions: int | None, scan: Callable[[DataFrame], DataFrame], window: Callable[[DataFrame], DataFrame], none: dict[str, Column]) -> DataFrame:
    """``window`` over the rows of most keys, ``scan`` over those of keys with more than ``HOT_ROWS`` rows; ``none`` for rows without a key.

    The rows are written once to the shared folder, since each part reads them. The heavy keys are at most rows / ``HOT_ROWS``. With
    ``partitions`` all rows are scanned, in so many range partitions.
    """
    if partitions:
        return scan(txn)
    spark = txn.sparkSession
    path = f"{work_dir(spark)}/history-{uuid.uuid4().hex[:12]}"
    txn.write.option("compression", "zstd").parquet(f"{path}/rows")
    rows = spark.read.schema(txn.schema).parquet(f"{path}/rows")
    known = F.col(key).isNotNull()
    rows.where(known).groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > HOT_ROWS).select("_hot").write.parquet(f"{path}/hot")
    hot = spark.read.parquet(f"{path}/hot")
    rest = rows.where(~known).select("*", *[v.alias(c) for c, v in none.items()])
    if hot.isEmpty():
        return window(rows.where(known)).unionByName(rest)
    hot = F.broadcast(hot)
    light = rows.where(known).join(hot, F.col(key) == F.col("_hot"), "left_anti")
    heavy = rows.where(known).join(hot, F.col(key) == F.col("_hot"), "left_semi")
    return window(light).unionByName(scan(heavy)).unionByName(rest)


def running_features(
    txn: DataFrame,
    key: str = "customer_id",
    ts: str = "ts",
    amount: str = "amount",
    label: str = "is_fraud",
    distinct_of: str = "merchant_id",
    partitions: int | None = None,
) -> DataFrame:
    """Leak-safe history features of each transaction, from strictly earlier rows of its key.

    Adds prior_txn_count, prior_avg_amount, prior_stddev_amount (sample),
    prior_fraud_count and prior_unique_merchants. Rows at the same time never
    see each other. The running distinct count counts first meetings: the earliest time of
    each (key, merchant). In a scan it enters as a row of its own, combined map-side, so no row is joined to a hot pair.
    """
    def scan(rows: DataFrame) -> DataFrame:
        return _scanned_features(rows, key, ts, amount, label, distinct_of, partitions)

    def window(rows: DataFrame) -> DataFrame:
        names = {"_k": F.col(key), "_us": epoch_micros(ts), "_m": F.col(distinct_of), "_fraud": F.when(F.col(label) == 1, 1).otherwise(0).cast("bigint"), "_amt": F.col(amount).cast("double")}
        dealt = rows.repartition(F.col(key)).withColumns(names)
        timed = F.col("_us").isNotNull()
        met = F.row_number().over(Window.partitionBy(key, "_m").orderBy(F.col("_us").asc_nulls_last())) == 1
        dealt = dealt.withColumn("_met", F.when(F.col("_m").isNotNull() & timed & met, 1).otherwise(0).cast("bigint"))
        before = Window.partitionBy(key).orderBy("_us").rangeBetween(Window.unboundedPreceding, -1)
        n = F.col("_cnt")
        seen = dealt.select("*", F.count("_us").over(before).alias("_n"), F.count("_amt").over(before).alias("_cnt"), F.avg("_amt").over(before).alias("_mean"), F.var_pop("_amt").over(before).alias("_var"),
                            F.sum("_fraud").over(before).alias("_frauds"), F.sum("_met").over(before).alias("_uniq"))
        return seen.select(
            *_columns(rows),
            F.when(timed, F.col("_n")).otherwise(0).cast("bigint").alias("prior_txn_count"),
            F.when(timed & (n > 0), F.col("_mean")).alias("prior_avg_amount"),
            F.when(timed & (n >= 2), F.sqrt(F.greatest(F.col("_var") * n, F.lit(0.0)) / (n - 1))).alias("prior_stddev_amount"),
            F.when(timed, F.coalesce("_frauds", F.lit(0))).otherwise(0).cast("bigint").alias("prior_fraud_count"),
            F.when(timed, F.coalesce("_uniq", F.lit(0))).otherwise(0).cast("bigint").alias("prior_unique_merchants"),
        )

    zero, null = F.lit(0).cast("bigint"), F.lit(None).cast("double")
    return _per_key(txn, key, partitions, scan, window, {"prior_txn_count": zero, "prior_avg_amount": null, "prior_stddev_amount": null, "prior_fraud_count": zero, "prior_unique_merchants": zero})


def _scanned_features(txn: DataFrame, key: str, ts: str, amount: str, label: str, distinct_of: str, partitions: int | None) -> DataFrame:
    """``running_features`` by a scan over range partitions."""
    us = epoch_micros(ts)
    rows = txn.select(
        F.col(key).alias("_k"),
        us.alias("_us"),
        F.when(us.isNotNull(), 1).otherwise(0).cast("bigint").alias("_n"),
        F.lit(0).cast("bigint").alias("_uniq"),
        F.when(F.col(label) == 1, 1).otherwise(0).cast("bigint").alias("_fraud"),
        F.col(amount).cast("double").alias("_amt"),
        F.struct(*_columns(txn)).alias("_s"),
    )
    met = txn.where(F.col(key).isNotNull() & F.col(distinct_of).isNotNull() & us.isNotNull())
    met = met.groupBy(F.col(key).alias("_k"), F.col(distinct_of)).agg(F.min(us).alias("_us"))
    met = met.select("_k", "_us", *[F.lit(v).cast("bigint").alias(c) for c, v in (("_n", 0), ("_uniq", 1), ("_fraud", 0))])
    rows = rows.unionByName(met, allowMissingColumns=True).withColumn("_u", F.monotonically_increasing_id())
    rows = ranged(rows, ["_k", "_us", "_u"], partitions).drop("_u")
    seen = strictly_before(rows, ["_n", "_uniq", "_fraud"], "_amt").where(F.col("_s").isNotNull())
    # Rows without a time or without a key have no history (equi-join semantics: null keys match nothing).
    known = F.col("_us").isNotNull() & F.col("_k").isNotNull()
    n = F.col("_before._cnt")
    return seen.select(
        *[F.col("_s").getField(c).alias(c) for c in txn.columns],
        F.when(known, F.col("_before._n")).otherwise(0).cast("bigint").alias("prior_txn_count"),
        F.when(known & (n > 0), F.col("_before._mean")).alias("prior_avg_amount"),
        F.when(known & (n >= 2), F.sqrt(F.greatest(F.col("_before._m2"), F.lit(0.0)) / (n - 1))).alias("prior_stddev_amount"),
        F.when(known, F.col("_before._fraud")).otherwise(0).cast("bigint").alias("prior_fraud_count"),
        F.when(known, F.col("_before._uniq")).otherwise(0).cast("bigint").alias("prior_unique_merchants"),
    )


def trailing_count(
    txn: DataFrame,
    key: str = "customer_id",
    ts: str = "ts",
    window_us: int = HOUR_US,
    name: str = "txn_count_last_hour",
    partitions: int | None = None,
) -> DataFrame:
    """Number of earlier rows of the same key in the trailing window (row itself excluded).

    The rows before a time, less the rows before the window's start: a window of any width and any number of rows is
    two running counts.
    """
    def window(rows: DataFrame) -> DataFrame:
        def before(end: int) -> Column:
            return F.count(F.lit(1)).over(Window.partitionBy(key).orderBy("_us").rangeBetween(Window.unboundedPreceding, end))

        dealt = rows.repartition(F.col(key)).withColumn("_us", epoch_micros(ts))
        return dealt.select(*_columns(rows), F.when(F.col("_us").isNotNull(), before(-1) - before(-window_us - 1)).otherwise(0).cast("bigint").alias(name))

    return _per_key(txn, key, partitions, lambda rows: _scanned_count(rows, key, ts, window_us, name, partitions), window, {name: F.lit(0).cast("bigint")})


def _scanned_count(txn: DataFrame, key: str, ts: str, window_us: int, name: str, partitions: int | None) -> DataFrame:
    """``trailing_count`` by a scan over range partitions.

    Each row asks for both counts in one scan, as itself and as a row of no weight at the window's start. The two answers meet by row number.
    """
    us = epoch_micros(ts)
    base = txn.select(F.col(key).alias("_k"), us.alias("_us"), F.monotonically_increasing_id().alias("_u"), F.struct(*_columns(txn)).alias("_s"))
    both = F.array(
        F.struct(F.col("_us"), F.when(F.col("_us").isNotNull(), 1).otherwise(0).cast("bigint").alias("_n"), F.col("_s")),
        F.struct((F.col("_us") - F.lit(window_us)).alias("_us"), F.lit(0).cast("bigint").alias("_n"), F.when(F.lit(False), F.col("_s")).alias("_s")),
    )
    rows = ranged(base.select("_k", "_u", F.explode(both).alias("_x")).select("_k", "_u", "_x.*"), ["_k", "_us", "_u"], partitions)
    seen = strictly_before(rows, ["_n"])
    starts = seen.where("_s IS NULL").select("_u", F.col("_before._n").alias("_start"))
    out = seen.where("_s IS NOT NULL").join(starts, "_u")
    known = F.col("_us").isNotNull() & F.col("_k").isNotNull()
    return out.select(*[F.col("_s").getField(c).alias(c) for c in txn.columns], F.when(known, F.col("_before._n") - F.col("_start")).otherwise(0).cast("bigint").alias(name))


def amount_zscore(with_history: DataFrame, amount: str = "amount", name: str = "amount_zscore") -> DataFrame:
    """(amount - prior mean) / prior sample std; null without two earlier rows or with zero spread."""
    std = F.col("prior_stddev_amount")
    return with_history.withColumn(name, F.when(std > 0, (F.col(amount) - F.col("prior_avg_amount")) / std))


def location_jumps(df: DataFrame, key: str, ts: str, lat: str, lon: str, id_col: str, partitions: int | None = None) -> DataFrame:
    """Distance (km) and speed (km/h) from each row's previous location of the same key.

    The previous row is the latest strictly earlier row of the key, found with
    the skew-safe as-of join (not ``lag`` over the whole key). Haversine on a
    6371 km sphere. Rows without an earlier row get nulls.
    """
    prev = df.select(
        F.col(key),
        F.col(ts).alias("_prev_ts"),
        F.col(lat).alias("_prev_lat"),
        F.col(lon).alias("_prev_lon"),
        F.col(id_col).alias("_prev_id"),
    )
    j = asof_join(df, prev, key, ts, "_prev_ts", feature_cols=["_prev_id", "_prev_lat", "_prev_lon"], strict=True, partitions=partitions)
    rad = F.lit(3.141592653589793 / 180.0)
    p1, p2 = F.col(lat) * rad, F.col("_prev_lat") * rad
    dphi, dlmb = p1 - p2, (F.col(lon) - F.col("_prev_lon")) * rad
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    # ``least`` skips nulls, so guard the no-previous-row case explicitly.
    km = F.when(a.isNotNull(), F.lit(2 * 6371.0) * F.asin(F.least(F.lit(1.0), F.sqrt(a))))
    hours = (epoch_micros(ts) - epoch_micros("_prev_ts")) / F.lit(HOUR_US)
    return j.withColumn("jump_km", km).withColumn("jump_kmh", F.when(hours > 0, km / hours)).drop(
        "_prev_id", "_prev_lat", "_prev_lon", "_prev_ts"
    )
