"""Score and feature drift over tumbling time windows.

The reference declares a monitor (score column, 7-day window) and leaves the
statistics to a hosted service; the formulas here are the textbook ones:

* PSI = Σ_bins (c - b) · ln(c / b) with shares floored by ε = 1e-6;
* Jensen-Shannon divergence (natural log) of the bin shares;
* two-sample Kolmogorov-Smirnov distance of the raw values.

Windows are epoch-aligned (1970-01-01 + k · width), computed from epoch
micros, so they do not depend on the session time zone.

No operator replicates the baseline per window: PSI/JS add, per window, only
the bins the window has plus a baseline-only constant; KS evaluates both
empirical CDFs at the window's own points in one scan along the values.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurepipe.functions.columns import epoch_micros, ntz_from_micros
from featurepipe.operators.asof import asof_join
from featurepipe.operators.scan import PID, ranged
from featurepipe.session import work_dir

WEEK_US = 7 * 86_400_000_000  # fixed.MONITOR_WINDOW, "7 days"
EPS = 1e-6


def window_start(ts, width_us: int = WEEK_US) -> Column:
    us = epoch_micros(ts)
    return ntz_from_micros(F.floor(us / F.lit(width_us)).cast("bigint") * F.lit(width_us))


def window_summary(scores: DataFrame, ts: str = "prediction_ts", score: str = "p1", width_us: int = WEEK_US) -> DataFrame:
    """Per tumbling window: rows, mean, sample std and null count of the score."""
    w = window_start(ts, width_us)
    return scores.groupBy(w.alias("window_start")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(score).alias("mean_score"),
        F.stddev_samp(score).alias("std_score"),
        F.sum(F.when(F.col(score).isNull() | F.isnan(score), 1).otherwise(0)).cast("bigint").alias("null_scores"),
    )


def fixed_bins(value: Column, n_bins: int = 10, lo: float = 0.0, hi: float = 1.0) -> Column:
    """Equal-width bin in [0, n_bins) over [lo, hi], clamped; null / NaN -> bin -1."""
    raw = F.floor((value - F.lit(lo)) / F.lit(hi - lo) * F.lit(n_bins))
    b = F.least(F.greatest(raw, F.lit(0)), F.lit(n_bins - 1)).cast("int")
    return F.when(value.isNull() | F.isnan(value), F.lit(-1)).otherwise(b)


def _psi_term(c: Column, b: Column) -> Column:
    return (c - b) * F.log(c / b)


def _xlogy(x: Column, y: Column) -> Column:
    return F.when(x > 0, x * F.log(x / y)).otherwise(F.lit(0.0))


def _js_term(c: Column, b: Column) -> Column:
    m = (c + b) / 2
    return 0.5 * _xlogy(c, m) + 0.5 * _xlogy(b, m)


def binned_drift(binned: DataFrame, group_cols: Sequence[str], window_col: str, bin_col: str, is_baseline: Column) -> DataFrame:
    """PSI and JS per (group, window) of current rows against the baseline rows of the same group.

    ``group_cols`` must be non-empty (use a constant column for one group).

    ``binned`` holds one row per observation with its bin. Baseline rows form
    one distribution per group; every other row belongs to its window.
    """
    g = list(group_cols)
    # One aggregation over the observations: counts per (group, window or baseline, bin).
    counts = binned.groupBy(
        *g, F.when(is_baseline, F.lit(None)).otherwise(F.col(window_col)).alias(window_col),
        F.col(bin_col), is_baseline.alias("_base"),
    ).agg(F.count(F.lit(1)).alias("n"))
    return counts_drift(counts.where(F.col("_base")).select(*g, bin_col, "n"), counts.where(~F.col("_base")).drop("_base"), g, window_col, bin_col)


def counts_drift(baseline: DataFrame, current: DataFrame, group_cols: Sequence[str], window_col: str, bin_col: str) -> DataFrame:
    """PSI and JS per (group, window) from counts ``n`` per bin: ``baseline`` (group, bin), ``current`` (group, window, bin)."""
    g = list(group_cols)
    # Shares within each distribution: window sums over the small count frames
    # (one row per bin; a window partition holds the bins of one distribution).
    base = baseline.select(*g, bin_col, F.coalesce(F.try_divide(F.col("n").cast("double"), F.sum("n").over(Window.partitionBy(*g))), F.lit(0.0)).alias("_bs"))
    cur = current.select(*g, window_col, bin_col, (F.col("n") / F.sum("n").over(Window.partitionBy(*g, window_col))).alias("_cs"))
    # Sum over baseline bins as if the window were empty there (one row per group) ...
    base_only = base.groupBy(*g).agg(
        F.sum(_psi_term(F.lit(EPS), F.col("_bs") + EPS)).alias("_psi0"),
        F.sum(_js_term(F.lit(0.0), F.col("_bs"))).alias("_js0"),
    )
    # ... then correct it on the bins the window has.
    bs = F.coalesce(F.col("_bs"), F.lit(0.0))
    present = cur.join(base, [*g, bin_col], "left").groupBy(*g, window_col).agg(
        F.sum(_psi_term(F.col("_cs") + EPS, bs + EPS) - F.when(F.col("_bs").isNotNull(), _psi_term(F.lit(EPS), bs + EPS)).otherwise(0.0)).alias("_dpsi"),
        F.sum(_js_term(F.col("_cs"), bs) - F.when(F.col("_bs").isNotNull(), _js_term(F.lit(0.0), bs)).otherwise(0.0)).alias("_djs"),
    )
    # Groups without baseline rows compare against an empty baseline (every bin ε).
    return present.join(base_only, g, "left").select(
        *g,
        window_col,
        (F.col("_dpsi") + F.coalesce("_psi0", F.lit(0.0))).alias("psi"),
        (F.col("_djs") + F.coalesce("_js0", F.lit(0.0))).alias("js"),
    )


def score_drift(
    scores: DataFrame, baseline_end: str, ts: str = "prediction_ts", score: str = "p1", n_bins: int = 10, width_us: int = WEEK_US
) -> DataFrame:
    """PSI and JS of the score distribution of each window at or after ``baseline_end`` vs all rows before it."""
    cut = F.lit(baseline_end).cast("timestamp_ntz")
    binned = scores.where(F.col(ts).isNotNull()).select(
        F.lit(1).alias("_g"), window_start(ts, width_us).alias("window_start"), fixed_bins(F.col(score), n_bins).alias("_bin"), F.col(ts)
    )
    return binned_drift(binned, ["_g"], "window_start", "_bin", F.col(ts) < cut).drop("_g")


SKETCH_K = 65_535  # of a quantile sketch: exact up to so many values, about 0.01 % of rank beyond
SPREAD = 256  # sketches of tasks are merged in so many groups before the last merge


def _number(feature: str) -> Column:
    """The feature as a double, null where missing."""
    v = F.col(f"`{feature}`").cast("double")
    return F.when(~F.isnan(v), v)


def baseline_sketches(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, n, sketch): a mergeable quantile sketch of each feature's values; ``n`` values, null sketch without any.

    One pass over ``rows``; tasks' sketches (at most about a megabyte per feature) are merged in ``SPREAD`` groups, then
    together. Sketches of several periods or tables merge with ``merge_sketches``.
    """
    named = rows.select(*[_number(f).alias(f"_{i}") for i, f in enumerate(features)], F.pmod(F.spark_partition_id(), F.lit(SPREAD)).alias("_g"))
    aggs = [x for i, _ in enumerate(features) for x in (F.count(f"_{i}").alias(f"_n{i}"), F.kll_sketch_agg_double(f"_{i}", F.lit(SKETCH_K)).alias(f"_s{i}"))]
    wide = named.groupBy("_g").agg(*aggs)
    long = wide.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"_n{i}").alias("n"), F.col(f"_s{i}").alias("sketch")) for i, f in enumerate(features)])).alias("_x")).select("_x.*")
    return merge_sketches(long.unionByName(_for_each(rows, features, "n bigint", 0), allowMissingColumns=True))


def _for_each(rows: DataFrame, features: Sequence[str], more: str, value: int) -> DataFrame:
    """One row per feature, for those that have no rows."""
    return rows.sparkSession.createDataFrame([(f, value) for f in features], f"feature string, {more}")


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One sketch per feature from any number of them."""
    live = F.when(F.col("n") > 0, F.col("sketch"))
    merged = sketches.groupBy("feature").agg(F.sum("n").alias("n"), F.kll_merge_agg_double(live, F.lit(SKETCH_K)).alias("sketch"))
    return merged.withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch")))


def cut_points(sketches: DataFrame, n_bins: int = 10) -> dict[str, list[float]]:
    """The distinct inner quantiles of each feature's baseline: ``n_bins`` - 1 numbers per feature reach the driver."""
    at = F.array(*[F.lit(i / n_bins) for i in range(1, n_bins)])
    cuts = F.when(F.col("n") > 0, F.array_sort(F.array_distinct(F.kll_sketch_get_quantile_double("sketch", at))))
    return {r.feature: r.cuts or [] for r in sketches.select("feature", cuts.alias("cuts")).collect()}


def quantile_bin(value: Column, cuts: Sequence[float]) -> Column:
    """How many of the cut points are below the value; -1 for a missing one."""
    points = F.array(*[F.lit(float(c)) for c in cuts]).cast("array<double>")
    return F.when(value.isNull(), F.lit(-1)).otherwise(F.size(F.filter(points, lambda c: c < value)))


def _binned(rows: DataFrame, cuts: dict[str, list[float]], *keep: Column) -> DataFrame:
    """(feature, bin, ``keep``) of every feature of every row; rows aggregate map-side before they are shuffled.

    A branch per feature reads that column only, and its few comparisons stay compiled; comparisons of all features in one
    projection outgrow what the JVM compiles. ``rows`` is read once per feature: a table, not a costly plan.
    """
    out = None
    for f, c in cuts.items():
        one = rows.select(F.lit(f).alias("feature"), quantile_bin(_number(f), c).alias("bin"), *keep)
        out = one if out is None else out.unionByName(one)
    return out


def baseline_profile(rows: DataFrame, sketches: DataFrame, n_bins: int = 10) -> DataFrame:
    """(feature, cuts, bin, n): the cut points of the baseline's quantile bins and how many baseline rows each bin holds.

    The profile is a small table to keep: monitors compare new windows with it and do not read the baseline again.
    """
    cuts = cut_points(sketches, n_bins)
    counts = _binned(rows, cuts).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    none = _for_each(rows, list(cuts), "bin int", 0).withColumn("n", F.lit(0).cast("bigint"))
    counts = counts.unionByName(none).groupBy("feature", "bin").agg(F.sum("n").alias("n"))
    kept = F.lit(None).cast("array<double>")
    for f, c in cuts.items():
        kept = F.when(F.col("feature") == f, F.array(*[F.lit(float(x)) for x in c]).cast("array<double>")).otherwise(kept)
    return counts.select("feature", kept.alias("cuts"), "bin", "n")


def profile_drift(profile: DataFrame, rows: DataFrame, ts: str = "ts", width_us: int = WEEK_US) -> DataFrame:
    """D3: PSI and JS per (feature, window) of ``rows`` against a stored baseline profile, over its quantile bins."""
    cuts = {r.feature: r.cuts or [] for r in profile.groupBy("feature").agg(F.first("cuts").alias("cuts")).orderBy("feature").collect()}  # one row per feature
    seen = _binned(rows.where(F.col(ts).isNotNull()), cuts, window_start(ts, width_us).alias("window_start"))
    seen = seen.groupBy("feature", "window_start", "bin").agg(F.count(F.lit(1)).alias("n"))
    return counts_drift(profile.select("feature", "bin", "n"), seen, ["feature"], "window_start", "bin")


def feature_drift(
    rows: DataFrame, features: Sequence[str], baseline_end: str, ts: str = "ts", n_bins: int = 10, width_us: int = WEEK_US
) -> DataFrame:
    """D3 in one call: the rows before ``baseline_end`` are profiled, the windows from then on compared with them.

    The features are written once to the shared folder, since each step reads them.
    """
    path = f"{work_dir(rows.sparkSession)}/drift-{uuid.uuid4().hex[:12]}"
    rows.select(ts, *features).write.parquet(path)
    rows = rows.sparkSession.read.parquet(path)
    cut = F.lit(baseline_end).cast("timestamp_ntz")
    base = rows.where(F.col(ts) < cut)
    return profile_drift(baseline_profile(base, baseline_sketches(base, features), n_bins), rows.where(F.col(ts) >= cut), ts, width_us)


def feature_drift_width(
    rows: DataFrame, features: Sequence[str], baseline_end: str, ts: str = "ts", n_bins: int = 10, width_us: int = WEEK_US
) -> DataFrame:
    """D3 with equal-width bins over each feature's baseline range.

    The baseline min/max per feature form one broadcast row; rows are binned in
    wide form and then unpivoted to (feature, bin) pairs that aggregate
    map-side, so the ×features fan-out never reaches a shuffle.
    """
    cut = F.lit(baseline_end).cast("timestamp_ntz")
    # Baseline range of every feature: a global aggregate, so exactly one row;
    # broadcasting it is bounded, and the rows are binned in wide form.
    rng = rows.where(F.col(ts) < cut).agg(
        *[F.min(F.col(f).cast("double")).alias(f"_lo_{i}") for i, f in enumerate(features)],
        *[F.max(F.col(f).cast("double")).alias(f"_hi_{i}") for i, f in enumerate(features)],
    ).withColumn("_g", F.lit(1))
    wide = rows.where(F.col(ts).isNotNull()).withColumn("_g", F.lit(1)).join(F.broadcast(rng), "_g")
    bins = []
    for i, f in enumerate(features):
        lo, hi, v = F.col(f"_lo_{i}"), F.col(f"_hi_{i}"), F.col(f).cast("double")
        missing = v.isNull() | F.isnan(v)
        raw = F.floor((v - lo) / (hi - lo) * F.lit(n_bins))
        b = (
            F.when(missing, F.lit(-1))
            .when(lo.isNull() | (hi == lo), F.lit(0))
            .otherwise(F.least(F.greatest(raw, F.lit(0)), F.lit(n_bins - 1)).cast("int"))
        )
        bins.append(F.struct(F.lit(f).alias("feature"), b.cast("int").alias("_bin")))
    long = wide.select(
        window_start(ts, width_us).alias("window_start"), F.col(ts), F.explode(F.array(*bins)).alias("_fb")
    ).select("window_start", ts, "_fb.feature", "_fb._bin")
    return binned_drift(long, ["feature"], "window_start", "_bin", F.col(ts) < cut)


def ks_distance(
    scores: DataFrame, baseline_end: str, ts: str = "prediction_ts", score: str = "p1", width_us: int = WEEK_US, partitions: int | None = None,
) -> DataFrame:
    """KS distance between each window's score sample and the baseline sample.

    Both CDFs are step functions; the supremum of |F_b - F_w| is reached at a
    window point x_i, either at x_i itself or just before it. So for each
    window point we need F_w(x_i), F_w(x_{i-1}), F_b(x_i) and F_b(x_i^-).

    Rows are aggregated once, to counts per (window or baseline, value), and these are range-partitioned by
    value. A value is in one partition (one row per window at most), so running sums inside a partition, over all
    baseline rows and per window, plus what earlier partitions hold (one row per partition
    and window) give every figure; nothing is joined but these offsets.
    """
    cut = F.lit(baseline_end).cast("timestamp_ntz")
    valid = scores.where(F.col(ts).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score))
    is_base = F.col(ts) < cut
    counts = valid.groupBy(
        F.when(is_base, F.lit(None)).otherwise(window_start(ts, width_us)).alias("window_start"),
        F.col(score).cast("double").alias("_v"),
    ).agg(F.count(F.lit(1)).alias("_c"))
    rows = ranged(counts, ["_v"], partitions)
    base = F.col("window_start").isNull()  # every row that is not baseline has a window
    rows = rows.withColumn("_cb", F.when(base, F.col("_c")).otherwise(0))

    held = rows.groupBy(PID, "window_start").agg(F.sum("_c").alias("_c"))
    earlier = Window.partitionBy("window_start").orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("window_start")
    held = held.select(PID, "window_start", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_w0"), F.sum("_c").over(whole).alias("_nw"))
    # baseline rows before each partition, and all: one row per partition
    per_pid = rows.groupBy(PID).agg(F.sum("_cb").alias("_cb"))
    first = Window.orderBy(PID)
    per_pid = per_pid.select(F.col(PID).alias("_p"), F.coalesce(F.sum("_cb").over(first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b0"),
                             F.sum("_cb").over(first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_nb"))
    upto = Window.partitionBy(PID).orderBy("_v").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    at = Window.partitionBy(PID, "_v")
    mine = Window.partitionBy(PID, "window_start").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.select(PID, "window_start", "_c", F.sum("_cb").over(upto).alias("_le"), F.sum("_cb").over(at).alias("_eq"), F.sum("_c").over(mine).alias("_w")).where(~base)
    held = held.where(~base).withColumnsRenamed({PID: "_hp", "window_start": "_hw"})
    j = seen.join(held, (F.col(PID) == F.col("_hp")) & (F.col("window_start") == F.col("_hw"))).join(per_pid, F.col(PID) == F.col("_p"))
    fw = (F.col("_w0") + F.col("_w")) / F.col("_nw")
    fw_prev = (F.col("_w0") + F.col("_w") - F.col("_c")) / F.col("_nw")
    fb_le = F.coalesce(F.try_divide(F.col("_b0") + F.col("_le"), F.col("_nb")), F.lit(0.0))
    fb_lt = F.coalesce(F.try_divide(F.col("_b0") + F.col("_le") - F.col("_eq"), F.col("_nb")), F.lit(0.0))
    d = F.greatest(F.abs(fb_le - fw), F.abs(fb_lt - fw_prev))
    return j.groupBy("window_start").agg(F.max(d).alias("ks"), F.first("_nw").alias("n"))


def version_match(scores: DataFrame, pointers: DataFrame, keep: Sequence[str] = (), model: str = "model", version: str = "model_version", ts: str = "prediction_ts",
                  default: str = "version", set_at: str = "set_at", event_id: str = "event_id") -> DataFrame:
    """Scored rows per model (and ``keep``) whose version was not the model's default at prediction time.

    The default is the last pointer set at or before the row's time (ties: the greatest event id), by the as-of join.
    """
    events = pointers.select(F.col(model), F.col(set_at).alias("_set_at"), F.col(event_id).alias("_event"), F.col(default).alias("_default"))
    j = asof_join(scores.select(*dict.fromkeys([model, *keep, version, ts])), events, model, ts, "_set_at", feature_cols=["_event", "_default"])
    known = F.col("_default").isNotNull()
    return j.groupBy(model, *keep).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(known & (F.col("_default") != F.col(version)), 1).otherwise(0)).cast("bigint").alias("n_mismatch"),
        F.sum(F.when(~known, 1).otherwise(0)).cast("bigint").alias("n_no_default"),
    )
