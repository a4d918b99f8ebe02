"""Scoring (M9, M11), score validation (A15, M10) and sinks for score tables.

The fixed-weight scorecard is a plain Column expression, so it scores inside
whole-stage codegen and is equally expressible in SQL (M11). Model-based
scoring lives in ``operators.model``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurepipe.fixed import PROBABILITY_SUM_TOLERANCE
from featurepipe.functions.columns import sigmoid

# Fixed scorecard weights over the transaction context view (fixed values; the
# SQL oracle writes the same numbers).
SCORECARD_INTERCEPT = -1.5
SCORECARD_WEIGHTS = {
    "merchant_risk_score": 2.0,
    "is_late_night": 0.8,
    "is_weekend": 0.3,
    "amount_to_avg_ratio": 0.5,
    "hour_of_day": -0.02,
}
SCORECARD_DEFAULTS = {"merchant_risk_score": 0.5, "amount_to_avg_ratio": 1.0}


@dataclass(frozen=True)
class Scorecard:
    """A linear model over named features: a missing feature takes its default, if it has one."""

    intercept: float = SCORECARD_INTERCEPT
    weights: Mapping[str, float] = field(default_factory=lambda: dict(SCORECARD_WEIGHTS))
    defaults: Mapping[str, float] = field(default_factory=lambda: dict(SCORECARD_DEFAULTS))

    def logit(self) -> Column:
        z = F.lit(self.intercept)
        for c, w in self.weights.items():
            v = F.col(c).cast("double")
            if c in self.defaults:
                v = F.coalesce(v, F.lit(self.defaults[c]))
            z = z + F.lit(w) * v
        return z

    def save(self, spark: SparkSession, path: str) -> None:
        """The artefact: a row per term in order, the intercept first."""
        rows = [(0, None, self.intercept, None), *((i, c, w, self.defaults.get(c)) for i, (c, w) in enumerate(self.weights.items(), 1))]
        spark.createDataFrame(rows, "place int, feature string, weight double, missing double").coalesce(1).write.mode("errorifexists").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Scorecard:
        rows = spark.read.parquet(path).orderBy("place").collect()  # one row per feature
        return Scorecard(rows[0].weight, {r.feature: r.weight for r in rows[1:]}, {r.feature: r.missing for r in rows[1:] if r.missing is not None})


def scorecard_logit() -> Column:
    return Scorecard().logit()


def score_scorecard(features: DataFrame, keep=("txn_id",), prediction_ts: Column | None = None, card: Scorecard | None = None) -> DataFrame:
    """Score rows with the scorecard: p1 = sigmoid(z), p0 = 1 - p1, plus a prediction time.

    ``prediction_ts`` defaults to the current time (as the reference stamps it);
    tests and replays pass a column to make the output reproducible.
    """
    p1 = sigmoid((card or Scorecard()).logit())
    ts = prediction_ts if prediction_ts is not None else F.current_timestamp().cast("timestamp_ntz")
    return features.select(*keep, (F.lit(1.0) - p1).alias("p0"), p1.alias("p1"), ts.alias("prediction_ts"))


def write_scores(scores: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None) -> None:
    """Replace the score table (``mode='overwrite'``), or append one partition per run."""
    w = scores.write.mode(mode)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def validate_scores(scores: DataFrame, p0: str = "p0", p1: str = "p1", tolerance: float = PROBABILITY_SUM_TOLERANCE) -> DataFrame:
    """A15 + M10: one global aggregate; only the summary row reaches the driver.

    ``passed`` needs no null probabilities and max |p0 + p1 - 1| < tolerance.
    NaN counts as a null probability (Spark orders NaN above every number, so a
    NaN would otherwise become the maximum deviation). An empty table fails.
    """
    bad = F.col(p0).isNull() | F.col(p1).isNull() | F.isnan(p0) | F.isnan(p1)
    s = F.col(p0) + F.col(p1)
    agg = scores.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(F.when(bad, 1).otherwise(0)).cast("bigint").alias("null_rows"),
        F.avg(F.when(~bad, s)).alias("mean_prob_sum"),
        F.max(F.when(~bad, F.abs(s - 1.0))).alias("max_deviation"),
    )
    passed = F.coalesce((F.col("null_rows") == 0) & (F.col("max_deviation") < tolerance), F.lit(False))
    return agg.withColumn("passed", passed)


def table_function(card: Scorecard, key: str = "txn_id"):
    """A model outside Spark ML as a SQL table function: ``name(TABLE(...) PARTITION BY ...)`` gives (key, p0, p1) per row.

    Arrow batches of a partition come in, numpy scores them, Arrow comes out; the weights travel with the
    function. Rows come with the key and the card's features, by name; further columns are not read.
    """
    intercept, terms = card.intercept, [(c, w, card.defaults.get(c)) for c, w in card.weights.items()]

    @F.arrow_udtf(returnType=f"{key} bigint, p0 double, p1 double")
    class Score:
        def eval(self, rows):
            import numpy as np
            import pyarrow as pa

            z = np.full(rows.num_rows, intercept)
            for c, w, missing in terms:
                v = rows.column(c).cast(pa.float64())
                z = z + w * (v if missing is None else v.fill_null(missing)).to_numpy(zero_copy_only=False)  # a null without a default is NaN
            with np.errstate(over="ignore"):
                p = 1.0 / (1.0 + np.exp(-z))
            p = pa.array(p, from_pandas=True)  # NaN: no score
            yield pa.table({key: rows.column(key).cast(pa.int64()), "p0": pa.compute.subtract(1.0, p), "p1": p})

    return Score
