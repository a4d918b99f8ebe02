import math

from helpers import roles_of, ts
from pyspark.sql import functions as F

from featurepipe.operators import scoring, views


def _scores(spark, rows):
    return spark.createDataFrame(rows, "txn_id bigint, p0 double, p1 double")


def test_validation_cases(spark):
    ok = scoring.validate_scores(_scores(spark, [(1, 0.3, 0.7), (2, 0.5, 0.5)])).first()
    assert ok.passed and ok.null_rows == 0 and ok.total_rows == 2
    off = scoring.validate_scores(_scores(spark, [(1, 0.3, 0.72)])).first()
    assert not off.passed and abs(off.max_deviation - 0.02) < 1e-12
    nulls = scoring.validate_scores(_scores(spark, [(1, None, 0.7), (2, float("nan"), 0.5), (3, 0.5, 0.5)])).first()
    assert not nulls.passed and nulls.null_rows == 2 and nulls.max_deviation == 0.0
    empty = scoring.validate_scores(_scores(spark, [])).first()
    assert empty.total_rows == 0 and not empty.passed


def test_scorecard_properties(spark):
    rows = [
        (1, 1, 1, 100.0, ts("2024-01-06 23:30:00"), 0, "mobile", "x"),  # risky merchant, night, weekend
        (2, 1, 2, 10.0, ts("2024-01-08 12:00:00"), 0, "mobile", "x"),
        (3, 2, 2, 10.0, ts("2024-01-09 12:00:00"), 0, "mobile", "x"),
    ]
    tv = views.transaction_context_view(roles_of(spark, rows))
    s = {r.txn_id: r for r in scoring.score_scorecard(tv, prediction_ts=F.col("feature_ts")).collect()}
    assert len(s) == 3
    for r in s.values():
        assert 0.0 <= r.p1 <= 1.0 and math.isclose(r.p0 + r.p1, 1.0, abs_tol=1e-12)
    assert s[1].p1 > s[2].p1  # risky profile scores above clean one


def test_write_scores_overwrite_and_append(spark, tmp_path):
    p = str(tmp_path / "scores")
    scoring.write_scores(_scores(spark, [(1, 0.5, 0.5)]), p)
    scoring.write_scores(_scores(spark, [(2, 0.5, 0.5)]), p)
    assert [r.txn_id for r in spark.read.parquet(p).collect()] == [2]
    hist = str(tmp_path / "hist")
    for run in ("r1", "r2"):
        scoring.write_scores(_scores(spark, [(1, 0.5, 0.5)]).withColumn("run", F.lit(run)), hist, mode="append", partition_by="run")
    assert spark.read.parquet(hist).count() == 2
