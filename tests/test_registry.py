import pytest
from pyspark.sql import functions as F

from featurepipe.operators import drift, registry
from featurepipe.operators.scoring import Scorecard, score_scorecard


def _at(t):
    return F.lit(t).cast("timestamp_ntz")


def _features(spark):
    return spark.createDataFrame([(i, None if i == 0 else i / 10) for i in range(5)], "txn_id bigint, x double")


def _scorer(spark):
    return lambda path, df: score_scorecard(df, keep=("txn_id", "__ts"), card=Scorecard.load(spark, path)).drop("prediction_ts")


def _registered(spark, root):
    for k, card in enumerate((Scorecard(0.0, {"x": 1.0}, {"x": 0.5}), Scorecard(1.0, {"x": -2.0}, {}))):
        card.save(spark, f"{root}/cards/{k}")
        assert registry.register(spark, root, "card", f"{root}/cards/{k}", _at(f"2024-01-0{k + 1}")) == f"V{k + 1}"
    registry.set_default(spark, root, "card", "V1", _at("2024-01-03"))
    registry.set_default(spark, root, "card", "V2", _at("2024-01-05"))
    registry.set_default(spark, root, "card", "V1", _at("2024-01-07"))


def test_versions_resolve_as_given_or_by_the_default_of_a_time(spark, tmp_path):
    root = str(tmp_path / "r")
    with pytest.raises(ValueError, match="no default"):
        registry.resolve(spark, root, "card")
    _registered(spark, root)
    assert registry.resolve(spark, root, "card", "V2") == ("V2", f"{root}/cards/1")
    assert registry.resolve(spark, root, "card")[0] == "V1"
    assert [registry.resolve(spark, root, "card", as_of=f"2024-01-0{d}")[0] for d in (3, 4, 5, 6, 7)] == ["V1", "V1", "V2", "V2", "V1"]
    with pytest.raises(ValueError, match="as of 2024-01-02"):
        registry.resolve(spark, root, "card", as_of="2024-01-02")
    with pytest.raises(ValueError, match="no version V9; registered: .'V1', 'V2'."):
        registry.set_default(spark, root, "card", "V9")
    assert registry.register(spark, root, "other", "somewhere") == "V1"


def test_scored_rows_carry_their_version_and_feed_the_match(spark, tmp_path):
    root, out = str(tmp_path / "r"), str(tmp_path / "scores")
    _registered(spark, root)
    run = lambda run_id, **kw: registry.score_resolved(spark, root, "card", _features(spark), out, run_id, _scorer(spark), prediction_ts=_at("2024-01-06"), **kw)
    assert run("a", version="V1") == ("V1", 5)
    assert run("b", as_of="2024-01-06") == ("V2", 5)
    assert run("b", as_of="2024-01-06") == ("V2", 5)  # a repeated run replaces itself
    rows = spark.read.parquet(out)
    assert rows.count() == 10
    p = {(r.run_id, r.txn_id): r.p1 for r in rows.collect()}
    sigmoid = lambda z: 1 / (1 + 2.718281828459045 ** -z)
    assert abs(p["a", 0] - sigmoid(0.5)) < 1e-12 and abs(p["a", 4] - sigmoid(0.4)) < 1e-12 and p["b", 0] is None and abs(p["b", 4] - sigmoid(0.2)) < 1e-12
    got = {(r.run_id, r.model_version): (r.n_rows, r.n_mismatch, r.n_no_default) for r in drift.version_match(rows, registry.pointers(spark, root), ["run_id", "model_version"]).collect()}
    assert got == {("a", "V1"): (5, 5, 0), ("b", "V2"): (5, 0, 0)}
