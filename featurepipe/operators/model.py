"""Model work with Spark ML (M4-M6, M12, T2): boosted trees, CV, importance, save/load.

The reference trains a gradient-boosted classifier in one container on a
pandas frame; here the same steps run as Spark ML jobs on the distributed
training frame. ``GBTClassifier`` has no positive-class weight, so a weight
column (``pos_weight`` for positives, 1 otherwise) takes its place.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from featurepipe import fixed
from featurepipe.operators.dataset import FEATURE_COLUMNS
from featurepipe.operators.metrics import binary_metrics
from featurepipe.session import work_dir

# Hyper-parameters of the training step (fixed values, see featurepipe.fixed).
DEFAULT_PARAMS = {
    "max_iter": fixed.GBT_ITERATIONS,
    "step_size": fixed.GBT_STEP_SIZE,
    "max_depth": fixed.GBT_MAX_DEPTH,
    "pos_weight": fixed.POSITIVE_CLASS_WEIGHT,
    "seed": fixed.RANDOM_SEED,
}


def build_pipeline(features: Sequence[str] = FEATURE_COLUMNS, label: str = "label", max_iter: int = fixed.GBT_ITERATIONS,
                   step_size: float = fixed.GBT_STEP_SIZE, max_depth: int = fixed.GBT_MAX_DEPTH, seed: int = fixed.RANDOM_SEED,
                   checkpoint_interval: int = 10) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")
    gbt = GBTClassifier(
        featuresCol="_features",
        labelCol=label,
        weightCol="_weight",
        maxIter=max_iter,
        stepSize=step_size,
        maxDepth=max_depth,
        seed=seed,
        lossType="logistic",
        checkpointInterval=checkpoint_interval,
        cacheNodeIds=False,  # a tree of a few levels is walked faster than ids are kept from level to level
    )
    return Pipeline(stages=[assembler, gbt])


def _weighted(df: DataFrame, label: str, pos_weight: float, count: str | None = None) -> DataFrame:
    n = F.col(count).cast("double") if count else F.lit(1.0)
    return df.withColumn(label, F.col(label).cast("double")).withColumn(
        "_weight", F.when(F.col(label) == 1.0, F.lit(float(pos_weight))).otherwise(F.lit(1.0)) * n
    )


def fit_gbt(train: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, label: str = "label", max_iter: int = fixed.GBT_ITERATIONS,
            step_size: float = fixed.GBT_STEP_SIZE, max_depth: int = fixed.GBT_MAX_DEPTH,
            pos_weight: float = fixed.POSITIVE_CLASS_WEIGHT, seed: int = fixed.RANDOM_SEED, count: str | None = None) -> PipelineModel:
    """M4: fit assembler + GBT. Tree state is checkpointed every 10 iterations to the session's checkpoint dir.

    ``count`` names a column that says how many equal rows a row stands for (``equal_rows``); without it each is one.
    """
    work_dir(train.sparkSession)  # GBT checkpoints its state into the shared folder
    assembler, gbt = build_pipeline(features, label, max_iter, step_size, max_depth, seed).getStages()
    # every level of every tree is a job, and each ships its plan to the tasks: one that reads a checkpoint is short
    rows = assembler.transform(_weighted(train, label, pos_weight, count)).select("_features", label, "_weight").checkpoint()
    return PipelineModel(stages=[assembler, gbt.fit(rows)])


def scorer(keep: Sequence[str]):
    """How ``registry.score_resolved`` scores with a saved pipeline: keeps ``keep`` and the prediction time."""
    return lambda path, features: predict(load_model(path), features, keep=(*keep, "__ts"))


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("txn_id",), threshold: float = fixed.PREDICTION_THRESHOLD) -> DataFrame:
    """M6: p0, p1 and the class (p1 >= threshold) for every row."""
    out = model.transform(df)
    prob = vector_to_array("probability")
    return out.select(*keep, prob[0].alias("p0"), prob[1].alias("p1")).withColumn(
        "prediction", (F.col("p1") >= F.lit(threshold)).cast("int")
    )


TRAIN_ROWS = 50_000  # rows of a training partition: boosting runs thousands of short passes over them


def equal_rows(train: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, label: str = "label", counts: dict[str, Column] | None = None) -> DataFrame:
    """The distinct (features, label) of the training rows, and how many rows are equal to each: ``_n``.

    The label join repeats a customer's features for each of its transactions. Boosting sees a row only through
    its features, label and weight, and all its statistics are sums of weights, so n equal rows are one row of n times the
    weight. ``counts`` names other counts: how many of the rows fulfil each condition. Where all rows differ, none is merged.
    """
    more = [F.count(F.when(c, 1)).alias(name) for name, c in (counts or {}).items()]
    return train.groupBy(*features, label).agg(F.count(F.lit(1)).alias("_n"), *more)


def training_table(train: DataFrame) -> DataFrame:
    """The training frame written once, in partitions of about ``TRAIN_ROWS``, and read back.

    Boosting passes over its input some thousand times; partitions sized to the rows, not to the shuffle that made them,
    keep each pass short, and a lost executor rereads a table instead of the plan.
    """
    spark = train.sparkSession
    base = f"{work_dir(spark)}/training-{uuid.uuid4().hex[:12]}"
    seen = Observation()
    train.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{base}/rows")
    rows = spark.read.schema(train.schema).parquet(f"{base}/rows")
    return rows.repartition(max(1, -(-seen.get["n"] // TRAIN_ROWS)))


def cross_validate(train_folds: DataFrame, k: int = fixed.CV_FOLDS, features: Sequence[str] = FEATURE_COLUMNS, label: str = "label",
                   parallelism: int = 1, keep: Sequence[str] = (), **fit_args) -> DataFrame:
    """M5: the held-out scores of every row (``keep``, label, fold, p0, p1, prediction): fit on k-1 folds, score the other.

    All folds share one persisted training table of distinct rows, with a count for each fold's model. ``parallelism`` fits that many folds at once (concurrent Spark jobs from
    driver threads, as Spark ML's CrossValidator does); each fit is itself
    distributed, so 1 suits a busy cluster and k suits small folds.
    """
    from concurrent.futures import ThreadPoolExecutor

    spark = train_folds.sparkSession
    out = f"{work_dir(spark)}/cv-{uuid.uuid4().hex[:12]}"
    train_folds.write.parquet(f"{out}/rows")  # read by the grouping and by the scoring of each fold
    rows = spark.read.schema(train_folds.schema).parquet(f"{out}/rows")
    others = {f"_n{f}": F.col("fold") != f for f in range(k)}
    table = training_table(equal_rows(rows, features, label, others)).persist()
    try:
        def fit_fold(f: int) -> None:
            fitted = fit_gbt(table.where(F.col(f"_n{f}") > 0), features, label, count=f"_n{f}", **fit_args)
            predict(fitted, rows.where(F.col("fold") == f), keep=[*keep, label]).write.parquet(f"{out}/scores/fold={f}")

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            list(pool.map(fit_fold, range(k)))
    finally:
        table.unpersist()
    return spark.read.parquet(f"{out}/scores")


def fold_metrics(scored: DataFrame, label: str = "label") -> DataFrame:
    """Rows and AUC per fold from held-out scores (AUC computed distributed)."""
    return binary_metrics(scored, score="p1", label=label, segment_cols=["fold"]).select("fold", "n", "auc")


def cv_summary(per_fold: DataFrame) -> DataFrame:
    """Mean and population std of the fold AUCs."""
    return per_fold.agg(F.avg("auc").alias("cv_auc_mean"), F.stddev_pop("auc").alias("cv_auc_std"), F.count(F.lit(1)).alias("folds"))


def feature_importance(spark: SparkSession, model: PipelineModel, features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Importance per feature, highest first (a vector of len(features) numbers)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = list(zip(features, [float(x) for x in imp]))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def save_model(model: PipelineModel, path: str) -> None:
    """Write the fitted pipeline (overwrites)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_table(model: PipelineModel, features: DataFrame, out_path: str, keep: Sequence[str] = ("txn_id",),
                prediction_ts=None) -> int:
    """M9: score a whole table, stamp the prediction time, overwrite the output; returns the row count, taken while writing."""
    seen = Observation()
    ts = prediction_ts if prediction_ts is not None else F.current_timestamp().cast("timestamp_ntz")
    scored = predict(model, features, keep).withColumn("prediction_ts", ts).observe(seen, F.count(F.lit(1)).alias("n"))
    scored.write.mode("overwrite").parquet(out_path)
    return seen.get["n"]
