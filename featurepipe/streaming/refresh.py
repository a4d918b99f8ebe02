"""Incremental refresh with Structured Streaming.

All states are logs (``streaming.log``): a micro-batch appends what it adds, reads merge, compaction folds.

R1 keeps the customer view equal to a batch recompute without rereading history:

* ``agg``: per customer and batch, the additive parts of the view (row count, amount
  count / mean / M2 for the sample deviation, max amount, fraud and late-night
  counts, last time) and HyperLogLog sketches of its merchants and days, which merge too;
* ``merchants`` and ``days``: the distinct (customer, merchant) and
  (customer, day-of-year) pairs, from which the exact distinct counts come. A batch appends the pairs that
  the log lacks (an anti-join), nothing is rewritten.

S8 keeps the transaction view: a new transaction changes its customer's mean and so the ratios of
that customer's rows and of no others. A batch appends the customer's rows anew; a row counts if the last batch
that wrote its customer wrote it.

R2 is the windowed score summary: as a streaming aggregation with a watermark, or as event-time
state in a log, where rows that come after their window was closed are kept in a table of their own.
D1 and D2 read the same log: moments and histograms per window, merged without a rescan of scores.

The states use the session's shared folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurepipe.functions.columns import epoch_micros, is_late_night, ntz_from_micros, safe_ratio, to_instant
from featurepipe.operators.drift import WEEK_US, counts_drift, fixed_bins, window_start
from featurepipe.operators.views import transaction_context_view
from featurepipe.sources.roles import Roles, events_to_transactions, profiles
from featurepipe.streaming.log import BatchLog, merged_moments

SKETCH_LG_K = 12  # HyperLogLog: about 1.6 % relative standard error (1.04 / sqrt(2^12))
CUSTOMER_TABLES = {
    "agg": "customer_id bigint, n_rows bigint, n_amt bigint, mean_amt double, m2_amt double, max_amt double, fraud bigint, late bigint, max_ts timestamp_ntz, merchant_sketch binary, day_sketch binary",
    "merchants": "customer_id bigint, merchant_id bigint",
    "days": "customer_id bigint, doy int",
}


# ---------------------------------------------------------------- R1


def customer_log(spark: SparkSession, state_dir: str) -> BatchLog:
    return BatchLog(spark, state_dir, CUSTOMER_TABLES)


def _customer_parts(txn: DataFrame) -> DataFrame:
    """Partial state of one micro-batch, per customer."""
    return txn.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("amount").alias("n_amt"),
        F.avg("amount").alias("mean_amt"),
        (F.coalesce(F.var_pop("amount"), F.lit(0.0)) * F.count("amount")).alias("m2_amt"),
        F.max("amount").alias("max_amt"),
        F.sum(F.when(F.col("is_fraud") == 1, 1).otherwise(0)).cast("bigint").alias("fraud"),
        F.sum(is_late_night("ts")).cast("bigint").alias("late"),
        F.max("ts").alias("max_ts"),
        F.hll_sketch_agg("merchant_id", F.lit(SKETCH_LG_K)).alias("merchant_sketch"),
        F.hll_sketch_agg(F.dayofyear("ts"), F.lit(SKETCH_LG_K)).alias("day_sketch"),
    )


def _merged_parts(parts: DataFrame) -> DataFrame:
    return merged_moments(
        parts, ["customer_id"], n_rows=F.sum("n_rows"), max_amt=F.max("max_amt"), fraud=F.sum("fraud"), late=F.sum("late"), max_ts=F.max("max_ts"),
        merchant_sketch=F.hll_union_agg("merchant_sketch"), day_sketch=F.hll_union_agg("day_sketch"))


def refresh_customers(log: BatchLog, txn: DataFrame, batch_id: int) -> None:
    """One micro-batch: its parts, and the pairs that earlier batches lack."""
    txn = txn.where(F.col("customer_id").isNotNull())
    for table, col in (("merchants", F.col("merchant_id").cast("bigint").alias("merchant_id")), ("days", F.dayofyear("ts").alias("doy"))):
        pairs = txn.select("customer_id", col).dropna().distinct()
        known = log.read(table, before=batch_id).drop("batch_id")
        log.append(table, batch_id, pairs.join(known, pairs.columns, "left_anti"))
    log.append("agg", batch_id, _customer_parts(txn))


def compact_customers(spark: SparkSession, state_dir: str) -> int:
    """Fold the log: one row per customer, each pair once."""
    once = lambda df: df.drop("batch_id").distinct()
    return customer_log(spark, state_dir).compact({"agg": _merged_parts, "merchants": once, "days": once})


def incremental_customer_view(
    spark: SparkSession,
    events_stream: DataFrame,
    source_dir: str,
    state_dir: str,
    available_now: bool = True,
    processing_time: str = "1 hour",
):
    """Start the R1 refresh; returns (query, state_dir). Read the view with :func:`read_customer_view`.

    A checkpoint that is not the state's own raises :class:`~featurepipe.streaming.log.ForeignCheckpoint`.
    """
    log = customer_log(spark, state_dir)
    q = log.run(events_stream, lambda batch, k: refresh_customers(log, events_to_transactions(batch), k), None if available_now else processing_time)
    return q, state_dir


def read_customer_view(spark: SparkSession, state_dir: str, source_dir: str, approximate: bool = False) -> DataFrame:
    """The customer view from the log: merged parts ⋈ distinct counts ⋈ profile.

    ``approximate`` takes the distinct counts from the merged sketches and reads no pairs.
    """
    log = customer_log(spark, state_dir)
    agg = _merged_parts(log.read("agg"))
    if approximate:
        agg = agg.withColumn("unique_merchants", F.hll_sketch_estimate("merchant_sketch")).withColumn("active_days", F.hll_sketch_estimate("day_sketch"))
    else:
        for table, name in (("merchants", "unique_merchants"), ("days", "active_days")):
            agg = agg.join(log.read(table).groupBy("customer_id").agg(F.count(F.lit(1)).alias(name)), "customer_id", "left")
    return agg.join(profiles(spark, source_dir), "customer_id", "inner").select(
        "customer_id",
        F.col("n_rows").alias("total_txn_count"),
        F.col("mean_amt").alias("avg_txn_amount"),
        F.col("max_amt").alias("max_txn_amount"),
        F.when(F.col("n_amt") >= 2, F.sqrt(F.greatest(F.col("m2_amt"), F.lit(0.0)) / (F.col("n_amt") - 1))).alias("stddev_txn_amount"),
        F.coalesce("unique_merchants", F.lit(0)).alias("unique_merchants"),
        F.col("fraud").alias("historical_fraud_count"),
        (F.col("fraud") / F.col("n_rows")).alias("historical_fraud_rate"),
        F.coalesce("active_days", F.lit(0)).alias("active_days"),
        (F.col("late") / F.col("n_rows")).alias("late_night_txn_ratio"),
        "credit_score",
        "account_age_days",
        "annual_income",
        F.col("max_ts").alias("feature_ts"),
    )


# ---------------------------------------------------------------- S8


def transaction_log(spark: SparkSession, state_dir: str, r: Roles) -> BatchLog:
    rows = transaction_context_view(r)
    return BatchLog(spark, state_dir, {"rows": ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields), "written": "customer_id bigint"})


def _current(log: BatchLog, before: int | None = None) -> DataFrame:
    """The rows that the last batch of their customer wrote; rows without a customer never change."""
    rows = log.read("rows", before)
    last = log.read("written", before).groupBy("customer_id").agg(F.max("batch_id").alias("_last"))
    kept = rows.join(last, "customer_id").where(F.col("batch_id") == F.col("_last")).select(*rows.columns)
    return kept.unionByName(rows.where(F.col("customer_id").isNull()))


def refresh_transactions(log: BatchLog, r: Roles, txn: DataFrame, batch_id: int) -> DataFrame:
    """One micro-batch: the new rows, and anew the earlier rows of the customers they touch; returns what was written."""
    fresh = transaction_context_view(Roles(txn, r.merchants, r.profiles))
    touched = txn.select("customer_id").where(F.col("customer_id").isNotNull()).distinct()
    log.append("written", batch_id, touched)
    touched = log.spark.read.schema("customer_id bigint").parquet(f"{log.root}/written/batch_id={batch_id}")
    rows = _current(log, batch_id).drop("batch_id").join(touched, "customer_id", "left_semi").unionByName(fresh)
    means = rows.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.avg("amount").alias("_mean"))
    anew = rows.join(means, "customer_id", "left").withColumn("amount_to_avg_ratio", safe_ratio("amount", "_mean")).select(*fresh.columns)
    log.append("rows", batch_id, anew)
    return anew


def incremental_transaction_view(spark: SparkSession, events_stream: DataFrame, r: Roles, state_dir: str, processing_time: str | None = None):
    """Start the refresh of the transaction view; read it with :func:`read_transaction_view`. ``r`` gives merchants and profiles."""
    log = transaction_log(spark, state_dir, r)
    return log.run(events_stream, lambda batch, k: refresh_transactions(log, r, events_to_transactions(batch), k), processing_time)


def read_transaction_view(spark: SparkSession, state_dir: str, r: Roles) -> DataFrame:
    return _current(transaction_log(spark, state_dir, r)).drop("batch_id")


def compact_transactions(spark: SparkSession, state_dir: str, r: Roles) -> int:
    """Fold the log: each row once, as its customer's last batch wrote it."""
    log = transaction_log(spark, state_dir, r)
    return log.compact({"rows": lambda _: _current(log), "written": lambda df: df.select("customer_id").distinct()})


# ---------------------------------------------------------------- R2, D1, D2


MONITOR_TABLES = {
    "moments": "window_start timestamp_ntz, baseline boolean, n bigint, n_amt bigint, mean_amt double, m2_amt double, null_scores bigint",
    "histogram": "window_start timestamp_ntz, baseline boolean, bin int, n bigint",
    "late": "prediction_ts timestamp_ntz, p1 double, window_start timestamp_ntz",
    "seen": "max_us bigint",
}


class ScoreMonitor:
    """Event-time state of a score stream: moments and a histogram per window and batch, and the rows that came too late.

    The watermark of a batch is the latest time of all batches before it less ``delay_us``; a row whose window has ended by then is late
    and changes no window. A window is closed once the watermark after the last batch has reached its end.
    Rows without a time belong to no window and are not counted. ``baseline_end`` splits the rows for D2.
    """

    def __init__(self, spark: SparkSession, state_dir: str, baseline_end: str | None = None, delay_us: int | None = 86_400_000_000, width_us: int = WEEK_US, n_bins: int = 10):
        """``delay_us`` None: no row is ever late."""
        self.log = BatchLog(spark, state_dir, MONITOR_TABLES)
        self.delay_us, self.width_us, self.n_bins = delay_us, width_us, n_bins
        self.baseline = F.col("prediction_ts") < F.lit(baseline_end).cast("timestamp_ntz") if baseline_end else F.lit(False)

    def watermark(self, before: int | None = None) -> int | None:
        """Micros up to which windows are closed by the committed batches (before ``before``)."""
        top = self.log.read("seen", before).agg(F.max("max_us")).first()[0]
        return None if top is None or self.delay_us is None else top - self.delay_us

    def _end(self):
        return epoch_micros("window_start") + F.lit(self.width_us)

    def add(self, scores: DataFrame, batch_id: int, ts: str = "prediction_ts", score: str = "p1") -> None:
        """One micro-batch of (prediction time, score)."""
        rows = scores.select(F.col(ts).alias("prediction_ts"), F.col(score).cast("double").alias("p1")).where("prediction_ts IS NOT NULL")
        rows = rows.withColumn("window_start", window_start("prediction_ts", self.width_us))
        mark = self.watermark(batch_id)
        late = F.lit(False) if mark is None else self._end() <= F.lit(mark)
        self.log.append("late", batch_id, rows.where(late))
        kept = rows.where(~late).withColumn("baseline", self.baseline)
        bad = F.col("p1").isNull() | F.isnan("p1")
        parts = kept.groupBy("window_start", "baseline").agg(
            F.count(F.lit(1)).alias("n"), F.count("p1").alias("n_amt"), F.avg("p1").alias("mean_amt"),
            (F.coalesce(F.var_pop("p1"), F.lit(0.0)) * F.count("p1")).alias("m2_amt"), F.sum(bad.cast("bigint")).alias("null_scores"))
        self.log.append("moments", batch_id, parts)
        self.log.append("histogram", batch_id, kept.groupBy("window_start", "baseline", fixed_bins(F.col("p1"), self.n_bins).alias("bin")).agg(F.count(F.lit(1)).alias("n")))
        self.log.append("seen", batch_id, rows.agg(F.max(epoch_micros("prediction_ts")).alias("max_us")))

    def start(self, stream: DataFrame, processing_time: str | None = None):
        return self.log.run(stream, self.add, processing_time)

    def summary(self, closed_only: bool = False) -> DataFrame:
        """Per window rows, mean, sample deviation and null scores; only closed windows if asked, as append mode emits them."""
        parts = self.log.read("moments")
        if closed_only:
            mark = self.watermark()
            parts = parts.where(F.lit(False) if mark is None else self._end() <= F.lit(mark))
        out = merged_moments(parts, ["window_start"], n=F.sum("n"), null_scores=F.sum("null_scores"))
        std = F.when(F.col("n_amt") >= 2, F.sqrt(F.greatest(F.col("m2_amt"), F.lit(0.0)) / (F.col("n_amt") - 1)))
        return out.select("window_start", "n", F.col("mean_amt").alias("mean_score"), std.alias("std_score"), "null_scores")

    def late_rows(self) -> DataFrame:
        return self.log.read("late").drop("batch_id")

    def drift(self) -> DataFrame:
        """PSI and JS of every window after the baseline, from the merged histograms."""
        counts = self.log.read("histogram").groupBy("window_start", "baseline", "bin").agg(F.sum("n").alias("n")).withColumn("_g", F.lit(1))
        base = counts.where("baseline").groupBy("_g", "bin").agg(F.sum("n").alias("n"))
        return counts_drift(base, counts.where("NOT baseline").select("_g", "window_start", "bin", "n"), ["_g"], "window_start", "bin").drop("_g")

    def compact(self) -> int:
        return self.log.compact({
            "moments": lambda df: merged_moments(df, ["window_start", "baseline"], n=F.sum("n"), null_scores=F.sum("null_scores")),
            "histogram": lambda df: df.groupBy("window_start", "baseline", "bin").agg(F.sum("n").alias("n")),
            "late": lambda df: df, "seen": lambda df: df.agg(F.max("max_us").alias("max_us"))})


def streaming_window_summary(
    scores_stream: DataFrame,
    state_dir: str,
    ts: str = "prediction_ts",
    score: str = "p1",
    watermark: str = "1 day",
    width: str = "7 days",
    output_mode: str = "complete",
):
    """Start the R2 monitor: per 7-day window count/mean/std/nulls of the score.

    Zone-less times are read as UTC instants (watermarks need TIMESTAMP). Rows
    later than the watermark are dropped in append mode; complete mode keeps
    every window. Results are written per micro-batch to Parquet; read them with
    :func:`read_window_summary`.
    """
    out_path = f"{state_dir}/summary"
    s = scores_stream.withColumn("_t", to_instant(ts)).withWatermark("_t", watermark)
    agg = s.groupBy(F.window("_t", width).alias("w")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(score).alias("mean_score"),
        F.stddev_samp(score).alias("std_score"),
        F.sum(F.when(F.col(score).isNull() | F.isnan(score), 1).otherwise(0)).cast("bigint").alias("null_scores"),
    )
    agg = agg.select(ntz_from_micros(F.unix_micros(F.col("w.start"))).alias("window_start"), "n", "mean_score", "std_score", "null_scores")

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_summary(batch, batch_id, out_path, output_mode)

    q = (
        agg.writeStream.outputMode(output_mode)
        .foreachBatch(sink)
        .option("checkpointLocation", f"{state_dir}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    return q, out_path


def write_summary(batch: DataFrame, batch_id: int, path: str, output_mode: str) -> None:
    """Write one micro-batch. In append mode each batch has a folder of its own, which a replay replaces."""
    target = path if output_mode == "complete" else f"{path}/batch_id={batch_id}"
    batch.write.mode("overwrite").parquet(target)


def read_window_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")


def new_state_dir(work: str, name: str) -> str:
    return f"{work}/streams/{name}-{uuid.uuid4().hex[:12]}"
