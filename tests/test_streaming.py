from pyspark.sql import functions as F

from featurepipe.operators import views
from featurepipe.session import work_dir
from featurepipe.sources.roles import roles
from featurepipe.sources.tables import read_table
from featurepipe.streaming import refresh

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def _stream(spark, df, path, files, order="ts", per_trigger=1):
    df.repartitionByRange(files, order).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def test_incremental_view_equals_batch_and_replay_is_idempotent(spark):
    state = refresh.new_state_dir(work_dir(spark), "t-custview")
    ev = read_table(spark, SF, "events")
    q, _ = refresh.incremental_customer_view(spark, _stream(spark, ev, f"{state}/input", 5, per_trigger=2), SF, state)
    q.awaitTermination()
    want = _rows(views.customer_risk_view(roles(spark, SF)))
    assert _rows(refresh.read_customer_view(spark, state, SF)) == want
    log = refresh.customer_log(spark, state)
    assert log.last() == 2  # three micro-batches
    # a pair is appended once, by the first batch that has it
    for table in ("merchants", "days"):
        pairs = log.read(table).drop("batch_id")
        assert pairs.count() == pairs.distinct().count()
    # Replaying the last batch (as after a crash before the commit) changes nothing.
    held = spark.read.parquet(f"{state}/agg/batch_id=2").count()
    written = {t: _rows(log.read(t)) for t in log.tables if t != "agg"}
    _replay(spark, ev, log, 2)
    assert _rows(refresh.read_customer_view(spark, state, SF)) == want and held == spark.read.parquet(f"{state}/agg/batch_id=2").count()
    assert {t: _rows(log.read(t)) for t in written} == written


def _replay(spark, ev, log, batch_id):
    """The rows of a batch are those that the other batches do not hold."""
    from featurepipe.sources.roles import events_to_transactions

    n = {r.customer_id: r.n for r in log.read("agg").where(F.col("batch_id") != batch_id).groupBy("customer_id").agg(F.sum("n_rows").alias("n")).collect()}
    from pyspark.sql import Window

    numbered = ev.withColumn("k", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    before = spark.createDataFrame(list(n.items()), "user_id bigint, n bigint")
    rest = numbered.join(before, "user_id", "left").where(F.col("k") > F.coalesce("n", F.lit(0))).select(*ev.columns)
    refresh.refresh_customers(log, events_to_transactions(rest), batch_id)
    log.commit(batch_id)


def test_a_batch_that_was_not_committed_is_not_read(spark):
    from featurepipe.sources.roles import events_to_transactions

    state = refresh.new_state_dir(work_dir(spark), "t-torn")
    ev = read_table(spark, SF, "events")
    log = refresh.customer_log(spark, state)
    halves = [events_to_transactions(ev.where((F.col("event_id") % 2) == k)) for k in (0, 1)]
    refresh.refresh_customers(log, halves[0], 0)
    log.commit(0)
    first = _rows(refresh.read_customer_view(spark, state, SF))
    refresh.refresh_customers(log, halves[1], 1)  # crashes before its commit
    assert _rows(refresh.read_customer_view(spark, state, SF)) == first
    refresh.refresh_customers(log, halves[1], 1)  # runs again
    log.commit(1)
    assert _rows(refresh.read_customer_view(spark, state, SF)) == _rows(views.customer_risk_view(roles(spark, SF)))


def test_compaction_keeps_the_view_and_later_batches_go_on(spark):
    state = refresh.new_state_dir(work_dir(spark), "t-compact")
    ev = read_table(spark, SF, "events")
    q, _ = refresh.incremental_customer_view(spark, _stream(spark, ev.where("event_id % 3 > 0"), f"{state}/input", 4), SF, state)
    q.awaitTermination()
    before = _rows(refresh.read_customer_view(spark, state, SF))
    upto = refresh.compact_customers(spark, state)
    log = refresh.customer_log(spark, state)
    assert upto == log.base() == log.last() and _rows(refresh.read_customer_view(spark, state, SF)) == before
    agg = log.read("agg")
    assert agg.count() == agg.select("customer_id").distinct().count()  # one row per customer
    assert refresh.compact_customers(spark, state) == upto  # nothing new to fold
    q, _ = refresh.incremental_customer_view(spark, _stream(spark, ev.where("event_id % 3 = 0"), f"{state}/input", 2), SF, state)
    q.awaitTermination()
    assert _rows(refresh.read_customer_view(spark, state, SF)) == _rows(views.customer_risk_view(roles(spark, SF)))


def test_a_reset_or_foreign_checkpoint_is_refused(spark):
    import pytest

    from featurepipe.streaming.log import BatchLog, ForeignCheckpoint

    logs = [BatchLog(spark, refresh.new_state_dir(work_dir(spark), "t-owner"), {"t": "x int"}) for _ in range(3)]
    ids = [log.claim() for log in logs]
    assert ids[0] != ids[1] and logs[0].claim() == ids[0]
    # the checkpoint of another stream
    spark.read.parquet(f"{logs[1].checkpoint}/owner").write.mode("overwrite").parquet(f"{logs[0].checkpoint}/owner")
    with pytest.raises(ForeignCheckpoint):
        logs[0].claim()
    # a checkpoint that was reset, and a state that was
    for log, path in ((logs[1], logs[1].checkpoint), (logs[2], logs[2].root)):
        spark.createDataFrame([], "stream_id string").coalesce(1).write.mode("overwrite").parquet(f"{path}/owner")
        with pytest.raises(ForeignCheckpoint):
            log.claim()


def test_sketched_distinct_counts_are_within_their_error(spark):
    """Merged over batches, the sketches stay within five standard errors (1.04 / sqrt(4096)) of the exact counts."""
    from featurepipe.sources.roles import events_to_transactions  # noqa: F401 - the columns below are its output

    txn = spark.range(60_000).select(F.col("id").alias("txn_id"), (F.col("id") % 3).alias("customer_id"), F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.col("id") % 500).alias("merchant_id"),
                                     F.lit(1.0).alias("amount"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("id") % 300).cast("int"))).alias("ts"), F.lit(0).alias("is_fraud"))
    log = refresh.customer_log(spark, refresh.new_state_dir(work_dir(spark), "t-sketch"))
    for k in range(4):
        refresh.refresh_customers(log, txn.where(F.pmod(F.xxhash64("txn_id"), F.lit(4)) == k), k)
        log.commit(k)
    got = refresh._merged_parts(log.read("agg")).select("customer_id", F.hll_sketch_estimate("merchant_sketch").alias("m"), F.hll_sketch_estimate("day_sketch").alias("d"))
    exact = {r.customer_id: (r.m, r.d) for r in txn.groupBy("customer_id").agg(F.count_distinct("merchant_id").alias("m"), F.count_distinct(F.dayofyear("ts")).alias("d")).collect()}
    for r in got.collect():
        for est, true in zip((r.m, r.d), exact[r.customer_id]):
            assert abs(est - true) <= max(1, 5 * 1.04 / 64 * true)


def test_transaction_view_rewrites_only_touched_customers(spark):
    from featurepipe.sources.roles import events_to_transactions

    r = roles(spark, SF)
    state = refresh.new_state_dir(work_dir(spark), "t-txnview")
    log = refresh.transaction_log(spark, state, r)
    txn = events_to_transactions(read_table(spark, SF, "events"))
    first, last = txn.where("txn_id % 5 > 0"), txn.where("txn_id % 5 = 0 AND customer_id % 7 = 1")
    for k, batch in enumerate((first, last)):
        refresh.refresh_transactions(log, r, batch, k)
        log.commit(k)
    written = log.read("rows").where("batch_id = 1")
    touched = {x.customer_id for x in last.select("customer_id").distinct().collect()}
    assert {x.customer_id for x in written.select("customer_id").distinct().collect()} == touched
    want = _rows(views.transaction_context_view(refresh.Roles(first.unionByName(last), r.merchants, r.profiles)))
    assert _rows(refresh.read_transaction_view(spark, state, r)) == want
    refresh.refresh_transactions(log, r, last, 1)  # a replay
    assert _rows(refresh.read_transaction_view(spark, state, r)) == want
    refresh.compact_transactions(spark, state, r)
    assert _rows(refresh.read_transaction_view(spark, state, r)) == want
    rest = txn.where("txn_id % 5 = 0 AND customer_id % 7 <> 1").unionByName(txn.limit(1).withColumn("txn_id", F.lit(-1).cast("bigint")).withColumn("customer_id", F.lit(None).cast("bigint")))
    refresh.refresh_transactions(log, r, rest, 2)
    log.commit(2)
    got = refresh.read_transaction_view(spark, state, r)
    assert _rows(got.where("txn_id >= 0")) == _rows(views.transaction_context_view(r)) and got.where("customer_id IS NULL").count() == 1


def test_late_rows_are_kept_apart_and_change_no_window(spark):
    from helpers import timedelta, ts

    day = lambda d: ts("2024-01-04 00:00:00") + timedelta(days=d)  # noqa: E731 - a window starts on that day
    monitor = refresh.ScoreMonitor(spark, refresh.new_state_dir(work_dir(spark), "t-late"), baseline_end="2024-01-05")
    batches = [[(day(0), 0.1), (day(1), None), (day(6), 0.3)], [(day(7.5), 0.5)], [(day(2), 0.9), (day(8.5), 0.7)], [(day(3), 0.2), (day(9), float("nan")), (None, 0.4)], []]
    for k, rows in enumerate(batches):
        monitor.add(spark.createDataFrame(rows, "prediction_ts timestamp_ntz, p1 double"), k)
        monitor.log.commit(k)
    # batch 2 sees a watermark of day 6.5: the first window is open; batch 3 one of day 7.5: it is closed
    assert [(r.prediction_ts, r.p1) for r in monitor.late_rows().collect()] == [(day(3), 0.2)]
    closed = monitor.summary(closed_only=True).collect()
    assert [(r.window_start, r.n, r.null_scores) for r in closed] == [(day(0), 4, 1)]
    assert {r.window_start: r.n for r in monitor.summary().collect()} == {day(0): 4, day(7): 3}
    before = repr((_rows(monitor.summary()), _rows(monitor.drift()), _rows(monitor.late_rows())))
    monitor.compact()
    assert repr((_rows(monitor.summary()), _rows(monitor.drift()), _rows(monitor.late_rows()))) == before


def test_streaming_window_summary_equals_batch(spark):
    from featurepipe.operators import drift

    state = refresh.new_state_dir(work_dir(spark), "t-monitor")
    ev = read_table(spark, SF, "events").select(F.col("ts").alias("prediction_ts"), (F.col("value") / 1000).alias("p1"))
    ev.repartitionByRange(3, "prediction_ts").write.parquet(f"{state}/input")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{state}/input")
    q, out = refresh.streaming_window_summary(stream, state)
    q.awaitTermination()
    assert _rows(spark.read.parquet(out)) == _rows(drift.window_summary(ev))


def test_append_mode_leaves_the_last_window_open(spark):
    """Append mode emits a window once the watermark passes its end; the newest window stays open."""
    from featurepipe.operators import drift

    state = refresh.new_state_dir(work_dir(spark), "t-monitor-append")
    ev = read_table(spark, SF, "events").select(F.col("ts").alias("prediction_ts"), (F.col("value") / 1000).alias("p1"))
    # Files arrive in time order (one write after another), as a live feed would.
    cuts = ["2024-01-08", "2024-01-16", "2024-01-24"]
    bounds = [None, *cuts, None]
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        part = ev
        if lo:
            part = part.where(F.col("prediction_ts") >= F.lit(lo).cast("timestamp_ntz"))
        if hi:
            part = part.where(F.col("prediction_ts") < F.lit(hi).cast("timestamp_ntz"))
        part.coalesce(1).write.mode("append").parquet(f"{state}/input")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{state}/input")
    q, out = refresh.streaming_window_summary(stream, state, output_mode="append")
    q.awaitTermination()
    got = _rows(refresh.read_window_summary(spark, out))
    full = _rows(drift.window_summary(ev))
    assert 0 < len(got) < len(full)
    assert got == full[: len(got)]  # closed windows equal the batch summary


def test_state_that_cannot_be_read_fails(spark, tmp_path):
    import pytest

    from featurepipe.sources.tables import read_or_empty

    assert read_or_empty(spark, str(tmp_path / "none"), "bucket int").collect() == []
    with pytest.raises(Exception):  # noqa: B017 - whatever the file system raises
        read_or_empty(spark, "nosuchfs://state/x", "bucket int")


def test_replayed_append_batch_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "summary")
    rows = [spark.createDataFrame([(i, float(i))], "n int, mean_score double") for i in range(2)]
    for i in (0, 1, 1):  # batch 1 runs twice, as after a crash before its commit
        refresh.write_summary(rows[i], i, out, "append")
    assert _rows(refresh.read_window_summary(spark, out)) == [(0, 0.0), (1, 1.0)]
