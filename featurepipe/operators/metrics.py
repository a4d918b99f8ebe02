"""Classification metrics (M7) and the quality gate (M8), per segment.

ROC AUC and average precision are exact. Rows are first reduced to distinct
scores per segment (tp, fp per score); the running sums over scores in
descending order come from ``ordered_running_sum``, whose window partitions
are equi-depth score ranges, so no task holds a whole segment. Rows are aggregated once;
all figures of a segment come from one aggregation of its curve.

* AUC = Σ fp_i · (cum_tp_i − tp_i / 2) / (P · N)  (ties count half)
* AP  = Σ tp_i · cum_tp_i / (cum_tp_i + cum_fp_i) / P  (step sum, not trapezoid)
* precision, recall, F1 at score >= threshold, 0 when undefined.
A segment with one class only gets a null AUC (and a null AP without positives).
Rows with a null or NaN score or a null label are left out; a null segment is a segment.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.fixed import PREDICTION_THRESHOLD, QUALITY_THRESHOLDS
from featurepipe.operators.prefix import ordered_running_sum

DEFAULT_THRESHOLDS = QUALITY_THRESHOLDS


def binary_metrics(
    df: DataFrame,
    score: str = "p1",
    label: str = "label",
    segment_cols: Sequence[str] = (),
    threshold: float = PREDICTION_THRESHOLD,
    partitions: int | None = None,
) -> DataFrame:
    seg = list(segment_cols)
    rows = df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score)) & F.col(label).isNotNull()).select(
        *seg, F.col(score).cast("double").alias("_s"), F.col(label).cast("int").alias("_y")
    )
    # The only aggregation over raw rows: positives / negatives per distinct score.
    per_score = rows.groupBy(*seg, "_s").agg(
        F.sum((F.col("_y") == 1).cast("bigint")).alias("tp"), F.sum((F.col("_y") == 0).cast("bigint")).alias("fp")
    )
    cum = ordered_running_sum(per_score, seg, "_s", ["tp", "fp"], descending=True, partitions=partitions)
    hit = F.col("_s") >= F.lit(threshold)
    # Products of counts in double: at 10^10+ rows per class a bigint product overflows (an error under ANSI).
    tp, fp, ctp, cfp = (F.col(c).cast("double") for c in ("tp", "fp", "cum_tp", "cum_fp"))
    curve = cum.groupBy(*seg).agg(
        F.coalesce(F.sum(F.col("tp") + F.col("fp")), F.lit(0)).alias("n"),
        F.coalesce(F.sum("tp"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("fp"), F.lit(0)).alias("negatives"),
        F.sum(F.when(hit, F.col("tp")).otherwise(0)).alias("_tp"),
        F.sum(F.when(hit, F.col("fp")).otherwise(0)).alias("_fp"),
        F.sum(fp * (ctp - tp / 2.0)).alias("_auc_num"),
        F.sum(F.try_divide(tp * ctp, ctp + cfp)).alias("_ap_num"),
    )
    p, n = F.col("positives"), F.col("negatives")
    precision = F.coalesce(F.try_divide(F.col("_tp"), F.col("_tp") + F.col("_fp")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("_tp"), p), F.lit(0.0))
    return curve.select(
        *seg,
        "n",
        "positives",
        F.when((p > 0) & (n > 0), F.col("_auc_num") / (p.cast("double") * n.cast("double"))).alias("auc"),
        F.when(p > 0, F.col("_ap_num") / p).alias("ap"),
        precision.cast("double").alias("precision"),
        recall.cast("double").alias("recall"),
        F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)).cast("double").alias("f1"),
    )


def quality_gate(metrics: DataFrame, thresholds: Mapping[str, float] = DEFAULT_THRESHOLDS) -> DataFrame:
    """M8: ``passed`` when every metric meets its floor; ``failures`` lists the others.

    A missing (null) or NaN metric fails with its name, instead of raising.
    """
    ok = {m: F.coalesce((F.col(m) >= F.lit(t)) & ~F.isnan(m), F.lit(False)) for m, t in thresholds.items()}
    passed = F.lit(True)
    for c in ok.values():
        passed = passed & c
    failures = F.concat_ws(",", *[F.when(~c, F.lit(m)) for m, c in ok.items()])
    return metrics.withColumn("passed", passed).withColumn("failures", failures)
