import math
import random

from helpers import timedelta, ts
from pyspark.sql import functions as F

from featurepipe.operators import drift


def _scores(spark, rows):
    return spark.createDataFrame(rows, "prediction_ts timestamp_ntz, p1 double")


def test_window_alignment_is_epoch_weeks(spark):
    df = _scores(spark, [(ts("2024-01-03 23:59:59"), 0.1), (ts("2024-01-04 00:00:00"), 0.2), (ts("2024-01-10 23:00:00"), None)])
    out = {r.window_start: r for r in drift.window_summary(df).collect()}
    # 1970-01-01 was a Thursday; 2024-01-04 is a Thursday, so a window starts there.
    assert set(out) == {ts("2023-12-28 00:00:00"), ts("2024-01-04 00:00:00")}
    assert out[ts("2024-01-04 00:00:00")].n == 2 and out[ts("2024-01-04 00:00:00")].null_scores == 1


def _brute_psi(base, cur, n_bins=10, eps=1e-6):
    def b(v):
        return -1 if v is None else min(max(math.floor(v * n_bins), 0), n_bins - 1)

    bins = {b(v) for v in base} | {b(v) for v in cur}
    psi = js = 0.0
    for k in bins:
        c = sum(1 for v in cur if b(v) == k) / len(cur)
        q = sum(1 for v in base if b(v) == k) / len(base)
        psi += (c - q) * math.log((c + eps) / (q + eps))
        m = (c + q) / 2
        js += 0.5 * (c * math.log(c / m) if c else 0) + 0.5 * (q * math.log(q / m) if q else 0)
    return psi, js


def test_psi_js_and_ks_vs_brute_force(spark):
    rnd = random.Random(5)
    start = ts("2024-01-01 00:00:00")
    rows = [(start + timedelta(hours=rnd.randrange(0, 24 * 30)), rnd.choice([None, round(rnd.random() ** (2 if i % 2 else 1), 3)])) for i in range(600)]
    df = _scores(spark, rows)
    cut = ts("2024-01-15 00:00:00")
    base = [v for t, v in rows if t < cut]
    psi = {r.window_start: r for r in drift.score_drift(df, "2024-01-15").collect()}
    ks = {r.window_start: r for r in drift.ks_distance(df, "2024-01-15").collect()}
    ks_split = {r.window_start: r.ks for r in drift.ks_distance(df, "2024-01-15", partitions=7).collect()}
    assert ks_split == {w: r.ks for w, r in ks.items()}
    wins = {}
    for t, v in rows:
        if t >= cut:
            us = int((t - ts("1970-01-01 00:00:00")).total_seconds() * 1e6)
            w = ts("1970-01-01 00:00:00") + timedelta(microseconds=us // (7 * 86400 * 10**6) * 7 * 86400 * 10**6)
            wins.setdefault(w, []).append(v)
    assert set(psi) == set(wins) == set(ks)
    bv = sorted(v for v in base if v is not None)
    for w, cur in wins.items():
        p, j = _brute_psi(base, cur)
        assert abs(psi[w].psi - p) < 1e-9 and abs(psi[w].js - j) < 1e-9
        cv = sorted(v for v in cur if v is not None)
        pts = set(bv) | set(cv)
        want = max(abs(sum(x <= t for x in bv) / len(bv) - sum(x <= t for x in cv) / len(cv)) for t in pts)
        assert abs(ks[w].ks - want) < 1e-12


def test_identical_distributions_have_zero_drift(spark):
    start = ts("2024-01-01 00:00:00")
    rows = [(start + timedelta(days=d), v) for d in (0, 20) for v in (0.1, 0.5, 0.9)]
    r = drift.score_drift(_scores(spark, rows), "2024-01-15").first()
    assert abs(r.psi) < 1e-12 and abs(r.js) < 1e-12
    assert drift.ks_distance(_scores(spark, rows), "2024-01-15").first().ks == 0.0


def test_feature_drift_per_feature(spark):
    start = ts("2024-01-01 00:00:00")
    rows = [(start + timedelta(days=d), float(d % 3), None if d % 5 == 0 else 1.0) for d in range(28)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, f1 double, f2 double")
    for drifted in (drift.feature_drift, drift.feature_drift_width):
        out = drifted(df, ["f1", "f2"], "2024-01-15").collect()
        assert {r.feature for r in out} == {"f1", "f2"}
        assert all(r.psi >= 0 and r.js >= 0 for r in out)


def _skewed(spark, n=3000):
    """Most values in a range of a billionth, a few far outliers, some missing."""
    r = random.Random(3)
    values = [None if i % 50 == 0 else float("nan") if i % 50 == 1 else 1e9 * r.random() if i % 50 == 2 else 1e-9 * r.randrange(1000) for i in range(n)]
    return values, spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, f double")


def test_profile_bins_are_quantiles_whatever_the_outliers(spark):
    values, df = _skewed(spark)
    live = sorted(v for v in values if v is not None and not math.isnan(v))
    profile = drift.baseline_profile(df, drift.baseline_sketches(df.repartition(5), ["f"])).collect()
    cuts = profile[0].cuts
    assert cuts == sorted({live[math.ceil(i / 10 * len(live)) - 1] for i in range(1, 10)})
    counts = {r.bin: r.n for r in profile}
    assert counts[-1] == len(values) - len(live) and sum(counts.values()) == len(values)
    assert all(counts[b] < 0.13 * len(values) for b in range(10))  # equal-width bins would hold nearly all in one
    for b in range(10):
        low, high = ([-math.inf] + cuts)[b], (cuts + [math.inf])[b]
        assert counts[b] == sum(low < v <= high for v in live)


def test_sketches_of_parts_merge_to_the_sketch_of_all(spark):
    _, df = _skewed(spark)
    parts = [drift.baseline_sketches(df.where(F.col("i") % 3 == k), ["f"]) for k in range(3)]
    merged = drift.merge_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert drift.cut_points(merged) == drift.cut_points(drift.baseline_sketches(df, ["f"]))
    assert merged.first().n == drift.baseline_sketches(df, ["f"]).first().n


def test_profile_edge_cases(spark):
    """A constant feature, one without values, and no baseline rows at all."""
    df = spark.createDataFrame([(ts("2024-01-01 00:00:00") + timedelta(days=d), 5.0, None) for d in range(28)], "ts timestamp_ntz, c double, e double")
    out = {r.feature: r for r in drift.feature_drift(df, ["c", "e"], "2024-01-15").collect()}
    assert abs(out["c"].psi) < 1e-9 and abs(out["e"].psi) < 1e-9
    late = drift.feature_drift(df, ["c"], "2023-01-01").collect()
    assert late and all(r.psi > 1 for r in late)  # an empty baseline: everything is new


def test_outliers_do_not_fill_a_range_partition(spark):
    from featurepipe.operators import scan

    _, df = _skewed(spark)
    vals = df.where("f IS NOT NULL").groupBy("f").count()
    sizes = [r["count"] for r in scan.ranged(vals, ["f"], 8).groupBy("_pid").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8
