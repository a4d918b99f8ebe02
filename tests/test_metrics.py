import random

import pytest
from pyspark.sql import functions as F

from featurepipe.operators import metrics


def _brute(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    if not pos or not neg:
        auc = None
    else:
        auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap = 0.0
    if pos:
        prev_r = 0.0
        for t in sorted({s for s, _ in rows}, reverse=True):
            sel = [(s, y) for s, y in rows if s >= t]
            tp = sum(y for _, y in sel)
            r = tp / len(pos)
            ap += (r - prev_r) * tp / len(sel)
            prev_r = r
    else:
        ap = None
    tp = sum(1 for s, y in rows if s >= 0.5 and y == 1)
    fp = sum(1 for s, y in rows if s >= 0.5 and y == 0)
    precision = tp / (tp + fp) if tp + fp else 0.0
    recall = tp / len(pos) if pos else 0.0
    f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
    return auc, ap, precision, recall, f1


@pytest.mark.parametrize("partitions", [None, 3, 13])
def test_metrics_match_brute_force_with_ties(spark, partitions):
    rnd = random.Random(11)
    rows = [(round(rnd.random(), 2), rnd.choice([0, 0, 1]), rnd.choice("ab")) for _ in range(400)]
    df = spark.createDataFrame(rows, "p1 double, label int, seg string")
    got = {r.seg: r for r in metrics.binary_metrics(df, segment_cols=["seg"], partitions=partitions).collect()}
    for seg in "ab":
        want = _brute([(s, y) for s, y, g in rows if g == seg])
        g = got[seg]
        for name, w in zip(("auc", "ap", "precision", "recall", "f1"), want):
            assert abs(g[name] - w) < 1e-9, (name, g[name], w)
    overall = metrics.binary_metrics(df, partitions=partitions).first()
    assert abs(overall.auc - _brute([(s, y) for s, y, _ in rows])[0]) < 1e-9


def test_metric_edge_cases(spark):
    one_class = spark.createDataFrame([(0.9, 0), (0.1, 0)], "p1 double, label int")
    r = metrics.binary_metrics(one_class).first()
    assert r.auc is None and r.ap is None and r.precision == 0.0 and r.recall == 0.0
    with_nan = spark.createDataFrame([(float("nan"), 0), (None, 1), (0.9, 1), (0.1, 0)], "p1 double, label int")
    r = metrics.binary_metrics(with_nan).first()
    assert r.n == 2 and r.auc == 1.0  # NaN and null scores are left out
    no_positive_prediction = spark.createDataFrame([(0.2, 1), (0.1, 0)], "p1 double, label int")
    r = metrics.binary_metrics(no_positive_prediction).first()
    assert r.precision == 0.0 and r.recall == 0.0 and r.f1 == 0.0 and r.auc == 1.0


def test_gate(spark):
    m = spark.createDataFrame(
        [("ok", 0.7, 0.5, 0.5), ("low", 0.5, 0.01, 0.5), ("missing", None, 0.5, 0.5)],
        "seg string, auc double, precision double, recall double",
    )
    g = {r.seg: r for r in metrics.quality_gate(m).collect()}
    assert g["ok"].passed and g["ok"].failures == ""
    assert not g["low"].passed and g["low"].failures == "auc,precision"
    assert not g["missing"].passed and g["missing"].failures == "auc"
    strict = {r.seg: r for r in metrics.quality_gate(m, {"auc": 0.85, "precision": 0.70, "recall": 0.60}).collect()}
    assert not strict["ok"].passed


def test_gate_fails_on_nan(spark):
    from featurepipe.operators.metrics import DEFAULT_THRESHOLDS, quality_gate

    names = list(DEFAULT_THRESHOLDS)
    row = quality_gate(spark.createDataFrame([(float("nan"), *[1.0] * (len(names) - 1))], ", ".join(f"{m} double" for m in names))).first()
    assert not row.passed and row.failures == names[0]


def test_null_segments_labels_and_groups(spark):
    from featurepipe.operators import dataset, profile

    rows = [(i, None if i % 2 else "a", (i * 7 % 40) / 40.0, int(i % 3 == 0)) for i in range(40)]
    df = spark.createDataFrame(rows, "id bigint, seg string, p1 double, label int")
    got = {r.seg: r for r in metrics.binary_metrics(df, segment_cols=["seg"]).collect()}
    for seg in ("a", None):
        pos = [r[2] for r in rows if r[1] == seg and r[3]]
        neg = [r[2] for r in rows if r[1] == seg and not r[3]]
        auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
        assert abs(got[seg].auc - auc) < 1e-9 and got[seg].ap is not None
    q = {r.seg: r for r in profile.distribution_summary(df, "seg", "p1").collect()}
    assert set(q) == {"a", None} and all(r.q50 is not None for r in q.values())
    nulls = df.withColumn("label", F.when(F.col("id") % 4 > 0, F.col("label")))
    split = dataset.stratified_split(nulls.select("id", "label"), id_col="id", n_buckets=16).collect()
    assert len(split) == 40 and sum(r.label is None and r.split == "test" for r in split) == 2  # floor(10 * 0.2 + 0.5)
