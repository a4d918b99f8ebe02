import threading

from pyspark.sql import functions as F

from featurepipe.operators import dataset, model
from featurepipe.plans import queries


def _train(spark, n=200):
    cols = dataset.FEATURE_COLUMNS
    df = spark.range(n).select(
        F.col("id").alias("txn_id"),
        *[((F.col("id") * (i + 3)) % 17).cast("double").alias(c) for i, c in enumerate(cols)],
        (F.col("id") % 5 == 0).cast("int").alias("label"),
    )
    return df


def test_fit_predict_save_load_and_score_table(spark, tmp_path):
    df = _train(spark)
    fitted = model.fit_gbt(df, max_iter=3, max_depth=3)
    pred = model.predict(fitted, df, keep=("txn_id", "label")).collect()
    assert len(pred) == 200
    assert all(abs(r.p0 + r.p1 - 1) < 1e-9 and 0 <= r.p1 <= 1 and r.prediction == int(r.p1 >= 0.5) for r in pred)
    path = str(tmp_path / "m")
    model.save_model(fitted, path)
    again = model.predict(model.load_model(path), df).collect()
    assert {r.txn_id: r.p1 for r in again} == {r.txn_id: r.p1 for r in pred}
    out = str(tmp_path / "scores")
    n = model.score_table(model.load_model(path), df, out, prediction_ts=F.lit("2024-01-01").cast("timestamp_ntz"))
    assert n == 200 and spark.read.parquet(out).count() == 200
    imp = model.feature_importance(spark, fitted).collect()
    assert len(imp) == 12 and imp == sorted(imp, key=lambda r: (-r.importance, r.feature))


def test_cv_summary(spark):
    folds = dataset.kfold(_train(spark), k=3)
    scored = model.cross_validate(folds, k=3, parallelism=3, keep=["txn_id"], max_iter=2, max_depth=2)
    held = {r.txn_id: r.fold for r in scored.collect()}
    assert held == {r.txn_id: r.fold for r in folds.collect()} and scored.count() == 200  # every row is scored once, by the model of its fold
    per_fold = model.fold_metrics(scored)
    rows = per_fold.collect()
    assert sorted(r.fold for r in rows) == [0, 1, 2]
    s = model.cv_summary(per_fold).first()
    assert s.folds == 3 and s.cv_auc_mean is not None


def test_a_planted_signal_ranks_first_and_risky_rows_score_higher(spark):
    """Only ``historical_fraud_rate`` carries the label; the others are noise."""
    df = _train(spark, 600).withColumn("label", (F.xxhash64("txn_id") % 10 == 0).cast("int"))
    df = df.withColumn("historical_fraud_rate", F.col("label") * 0.5 + F.abs(F.xxhash64("txn_id", F.lit(1)) % 10) / 100.0)
    fitted = model.fit_gbt(df, max_iter=5, max_depth=3)
    imp = model.feature_importance(spark, fitted).collect()
    assert imp[0].feature == "historical_fraud_rate" and imp[0].importance > 0.9
    scores = {r.label: r.p for r in model.predict(fitted, df, keep=("label",)).groupBy("label").agg(F.min(F.when(F.col("label") == 1, F.col("p1"))).alias("low"), F.max(F.when(F.col("label") == 0, F.col("p1"))).alias("high"))
              .select("label", F.coalesce("low", "high").alias("p")).collect()}
    assert scores[1] > 0.5 > scores[0]


def test_training_table_partitions_follow_the_rows(spark, monkeypatch):
    df = _train(spark, 200).repartition(40)
    assert model.training_table(df).rdd.getNumPartitions() == 1
    monkeypatch.setattr(model, "TRAIN_ROWS", 60)
    assert model.training_table(df).rdd.getNumPartitions() == 4


def test_equal_rows_are_fitted_once_with_their_count(spark):
    cols = dataset.FEATURE_COLUMNS
    df = _train(spark, 60).unionByName(_train(spark, 40))
    groups = model.equal_rows(df, counts={"_even": F.col("txn_id") % 2 == 0}).collect()
    want = {}
    for r in df.collect():
        n = want.setdefault((*[r[c] for c in cols], r.label), [0, 0])
        n[0] += 1
        n[1] += r.txn_id % 2 == 0
    assert {(*[r[c] for c in cols], r.label): [r._n, r._even] for r in groups} == want and len(groups) < 60
    rows = model.predict(model.fit_gbt(df, max_iter=4, max_depth=3), df).collect()
    few = model.predict(model.fit_gbt(model.equal_rows(df), max_iter=4, max_depth=3, count="_n"), df).collect()
    assert [r.txn_id for r in rows] == [r.txn_id for r in few] and all(abs(a.p1 - b.p1) < 1e-9 for a, b in zip(rows, few))


def test_folds_are_fitted_on_the_distinct_rows_of_the_others(spark, monkeypatch):
    folds = dataset.kfold(_train(spark), k=2)
    seen = []
    fit = model.fit_gbt
    monkeypatch.setattr(model, "fit_gbt", lambda train, *args, **more: seen.append([(r.label, r[more["count"]]) for r in train.collect()]) or fit(train, *args, **more))
    scored = {r.txn_id: r.p1 for r in model.cross_validate(folds, k=2, keep=["txn_id"], max_iter=2, max_depth=2).collect()}
    sizes = [folds.where(F.col("fold") != f).count() for f in range(2)]
    assert [sum(n for _, n in rows) for rows in seen] == sizes and all(len(rows) < n for rows, n in zip(seen, sizes))
    for f in range(2):
        alone = model.predict(fit(folds.where(F.col("fold") != f), max_iter=2, max_depth=2), folds.where(F.col("fold") == f)).collect()
        assert all(abs(scored[r.txn_id] - r.p1) < 1e-9 for r in alone)


def _tables(spark, folder):
    i = F.col("id")
    events = spark.range(240).select(
        i.alias("event_id"), F.timestamp_seconds(1704067200 + i * 7200).cast("timestamp_ntz").alias("ts"), (i % 12).alias("user_id"),
        F.when(i % 7 < 2, "error").otherwise("click").alias("event_type"), (i * 13 % 50).cast("double").alias("value"),
        F.format_string('{"k": %d}', i % 3).alias("props"))
    events.write.parquet(f"{folder}/events.parquet")
    spark.range(12).select(i.alias("c_custkey"), (i * 100).cast("double").alias("c_acctbal")).write.parquet(f"{folder}/customer.parquet")
    spark.range(3).select(i.alias("s_suppkey"), (i * 900).cast("double").alias("s_acctbal"), i.alias("s_nationkey")).write.parquet(f"{folder}/supplier.parquet")


def test_the_model_gate_fits_the_model_and_its_folds_at_the_same_time(spark, tmp_path, monkeypatch):
    _tables(spark, tmp_path)
    fit, together, fits = model.fit_gbt, threading.Barrier(6, timeout=60), []

    def short_fit(*args, count, **more):
        together.wait()  # passed only by six fits at once
        fits.append(count)
        return fit(*args, count=count, max_iter=2, max_depth=2, **more)

    monkeypatch.setattr(model, "fit_gbt", short_fit)
    for _ in range(2):  # the second time, both are registered
        row = queries.REGISTRY["q17_model_gate"](spark, str(tmp_path)).collect()[0]
        assert row.n == 48 and row.gate_follows and row.cv_mean_known and row.cv_std_known
    assert sorted(fits) == ["_n", "_n0", "_n1", "_n2", "_n3", "_n4"]
    root = queries._registry(spark, str(tmp_path))
    assert {(r.model, r.version) for r in queries.registry.versions(spark, root).collect()} == {(queries.MODEL, "V1"), (queries.CV_SCORES, "V1")}
    assert sorted(r.event_id for r in queries.registry.versions(spark, root).collect()) == [1, 2]
