import hashlib

import pytest
from pyspark.sql import functions as F

from featurepipe.operators import dataset


def _frame(spark, n=1000):
    return spark.range(n).select(F.col("id").alias("txn_id"), (F.col("id") % 5 == 0).cast("int").alias("label"))


def _brute_rank(ids_labels, salt=""):
    by = {}
    for i, y in ids_labels:
        by.setdefault(y, []).append(i)
    out = {}
    for y, ids in by.items():
        for r, i in enumerate(sorted(ids, key=lambda i: (hashlib.md5(f"{i}{salt}".encode()).hexdigest(), i)), 1):
            out[i] = (y, r, len(ids))
    return out


def test_split_exact_shares_and_rank_with_many_buckets(spark):
    df = _frame(spark)
    want = _brute_rank([(i, int(i % 5 == 0)) for i in range(1000)])
    for n_buckets in (1, 3, 1 << 20):  # one bucket / many rows per bucket / about one row per bucket
        got = {r.txn_id: r.split for r in dataset.stratified_split(df, n_buckets=n_buckets).collect()}
        for i, (y, rank, n) in want.items():
            assert got[i] == ("test" if rank <= int(n * 0.2 + 0.5) else "train")
    counts = dataset.stratified_split(df).groupBy("label", "split").count().collect()
    c = {(r.label, r.split): r["count"] for r in counts}
    assert c[(1, "test")] == 40 and c[(0, "test")] == 160


def test_kfold_disjoint_covering_balanced(spark):
    train = dataset.stratified_split(_frame(spark)).where("split = 'train'")
    folds = dataset.kfold(train, k=5, n_buckets=7)
    rows = folds.collect()
    assert len(rows) == train.count() and len({r.txn_id for r in rows}) == len(rows)
    per = {}
    for r in rows:
        per.setdefault((r.label, r.fold), 0)
        per[(r.label, r.fold)] += 1
    assert set(f for _, f in per) == set(range(5))
    for y in (0, 1):
        sizes = [per[(y, f)] for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    want = _brute_rank([(r.txn_id, r.label) for r in rows], ":fold")
    assert all(r.fold == (want[r.txn_id][1] - 1) % 5 for r in rows)


def test_feature_matrix_fills_and_orders(spark):
    cols = dataset.FEATURE_COLUMNS
    row = {c: None for c in cols}
    row.update(txn_id=1, is_fraud=1, credit_score=700.0)
    df = spark.createDataFrame([row], ", ".join([f"{c} double" for c in cols] + ["txn_id bigint", "is_fraud int"]))
    m = dataset.feature_matrix(df)
    assert m.columns == ["txn_id", *cols, "label"]
    r = m.first()
    assert r.stddev_txn_amount == 0.0 and r.credit_score == 700.0 and r.label == 1


def test_versioned_roundtrip(spark, tmp_path):
    df = _frame(spark, 10)
    path = dataset.write_versioned(df, str(tmp_path), "DS", "V1")
    assert path.endswith("datasets/DS/V1")
    assert dataset.read_versioned(spark, str(tmp_path), "DS", "V1").count() == 10
    with pytest.raises(Exception, match="(?i)exist"):
        dataset.write_versioned(df, str(tmp_path), "DS", "V1")
    dataset.write_versioned(df, str(tmp_path), "DS", "V1", overwrite=True)


def test_ranked_rows_are_dealt_once_without_a_join(spark):
    from helpers import plan_text

    df = spark.range(50).select(F.col("id").alias("txn_id"), F.when(F.col("id") % 7 != 0, (F.col("id") % 3).cast("int")).alias("label"))
    plan = plan_text(dataset.stratified_split(df), "simple")
    assert "Join" not in plan
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(label" in line and "_hb" in line]
    assert len(dealt) == 2  # the counts of the buckets, and the rows
    got = dataset.stratified_split(df).groupBy("label", "split").count().collect()
    assert sum(r["count"] for r in got) == 50 and {r.label for r in got} == {None, 0, 1, 2}
