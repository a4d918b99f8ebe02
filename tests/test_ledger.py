from helpers import ts
from pyspark.sql import functions as F

from featurepipe.operators import ledger


def test_next_version_parsing(spark):
    models = spark.createDataFrame([("m1",), ("m2",), ("m3",)], "model string")
    versions = spark.createDataFrame([("m1", "V2"), ("m1", "V10"), ("m1", "Vx"), ("m3", "v7")], "model string, version string")
    out = {r.model: r.next_version for r in ledger.next_version(models, versions, "model", "version").collect()}
    assert out == {"m1": "V11", "m2": "V1", "m3": "V1"}


def test_default_version_with_rollback(spark):
    ev = spark.createDataFrame(
        [("m", "V1", ts("2024-01-01 00:00:00"), 1), ("m", "V2", ts("2024-01-05 00:00:00"), 2),
         ("m", "V1", ts("2024-01-07 00:00:00"), 3), ("n", "V9", ts("2024-02-01 00:00:00"), 4)],
        "model string, version string, set_at timestamp_ntz, id bigint",
    )
    at = lambda t: {r.model: r.version for r in ledger.default_version_as_of(ev, "model", "version", "set_at", "id", t).collect()}
    assert at("2024-01-06") == {"m": "V2"}
    assert at("2024-01-08") == {"m": "V1"}  # rolled back
    assert at("2023-12-31") == {}


def test_latest_state_and_completeness(spark):
    rows = [
        ("r1", "a", "FAILED", ts("2024-01-01 00:00:00"), 1), ("r1", "a", "SUCCEEDED", ts("2024-01-02 00:00:00"), 2),
        ("r1", "b", "SUCCEEDED", ts("2024-01-02 00:00:00"), 3),
        ("r2", "a", "SUCCEEDED", ts("2024-01-01 00:00:00"), 4), ("r2", "b", "FAILED", ts("2024-01-03 00:00:00"), 5),
        ("r3", "a", "SUCCEEDED", ts("2024-01-01 00:00:00"), 6), ("r3", "a", "RUNNING", ts("2024-01-01 00:00:00"), 7),
    ]
    df = spark.createDataFrame(rows, "run string, task string, state string, created timestamp_ntz, id bigint")
    latest = ledger.latest_per_key(df, ["run", "task"], ["created", "id"], ["state"])
    st = {(r.run, r.task): r.state for r in latest.collect()}
    assert st[("r1", "a")] == "SUCCEEDED" and st[("r3", "a")] == "RUNNING"  # tie on time broken by id
    comp = {r.run: r.run_status for r in ledger.run_completeness(latest, "run", "task", "state", ["a", "b"]).collect()}
    assert comp == {"r1": "DONE", "r2": "FAILED", "r3": "WAITING"}
    only_a = {r.run: r.run_status for r in ledger.run_completeness(latest, "run", "task", "state", ["a"]).collect()}
    assert only_a == {"r1": "DONE", "r2": "DONE", "r3": "WAITING"}  # r2's unrelated failure does not count
    other = {r.run: r.run_status for r in ledger.run_completeness(latest, "run", "task", "state", ["a", "x"]).collect()}
    assert set(other.values()) == {"WAITING"}  # b does not stand in for x
    succ = {r.task: r.id for r in ledger.latest_success(df, "task", "state", "SUCCEEDED", "created", "id", []).collect()}
    assert succ == {"a": 6, "b": 3} or succ == {"a": 2, "b": 3}
    assert succ["a"] == 2  # 2024-01-02 is later than 2024-01-01


def test_numeric_metrics_and_idempotent_append(spark, tmp_path):
    raw = spark.createDataFrame([("run1", {"auc": "0.7", "feature_view": "FV__V1", "n": "10"})], "run_id string, m map<string,string>")
    runs = raw.select("run_id", ledger.numeric_metrics(F.col("m")).alias("metrics"))
    assert runs.first().metrics == {"auc": 0.7, "n": 10.0}
    path = str(tmp_path / "runs")
    ledger.append_results(runs, path)
    ledger.append_results(runs, path)  # replay of the same run replaces it
    ledger.append_results(runs.withColumn("run_id", F.lit("run2")), path)
    assert sorted(r.run_id for r in spark.read.parquet(path).collect()) == ["run1", "run2"]


def test_result_row_and_duration(spark):
    row = ledger.result_row(spark, "r", "training", "SUCCESS", {"metrics": {"auc": 0.7}}, created_at=F.lit("2024-01-01").cast("timestamp_ntz"))
    r = row.select(F.get_json_object("result", "$.metrics.auc").cast("double").alias("auc"), "created_at").first()
    assert r.auc == 0.7
    d = spark.createDataFrame([(ts("2024-01-01 00:00:00"), ts("2024-01-01 01:00:05"))], "a timestamp_ntz, b timestamp_ntz")
    assert d.select(ledger.duration_seconds("a", "b").alias("s")).first().s == 3605
