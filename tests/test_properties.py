"""Property tests: random small frames (nulls, ties, hot keys) against brute force."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from featurepipe.operators import asof, prefix

BASE = datetime(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

times = st.one_of(st.none(), st.integers(0, 48).map(lambda m: BASE + timedelta(minutes=30 * m)))
keys = st.one_of(st.none(), st.sampled_from([1, 1, 1, 2, 3]))


@SETTINGS
@given(
    spine=st.lists(st.tuples(keys, times), min_size=1, max_size=25),
    feats=st.lists(st.tuples(keys, times, st.one_of(st.none(), st.integers(0, 3))), max_size=25),
    strict=st.booleans(),
    partitions=st.sampled_from([None, 5]),
)
def test_asof_join_property(spark, spine, feats, strict, partitions):
    s = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(spine)], "sid bigint, k bigint, t timestamp_ntz")
    f = spark.createDataFrame(feats, "k bigint, ft timestamp_ntz, v bigint")
    out = {r.sid: r for r in asof.asof_join(s, f, "k", "t", "ft", strict=strict, partitions=partitions).collect()}
    assert len(out) == len(spine)
    for i, (k, t) in enumerate(spine):
        cands = [(ft, v) for fk, ft, v in feats if fk is not None and fk == k and t is not None and ft is not None and (ft < t or (ft == t and not strict))]
        best = max(cands, key=lambda c: (c[0], -1 if c[1] is None else c[1]), default=None)
        got = out[i]
        if best is None:
            assert got.ft is None
        else:
            assert got.ft == best[0]
            # ties on time resolve to the largest feature row (null sorts first)
            assert got.v == max((c[1] for c in cands if c[0] == best[0]), key=lambda v: -1 if v is None else v)


@SETTINGS
@given(
    rows=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 40), st.integers(-5, 5)), min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1])),
    n_buckets=st.sampled_from([1, 2, 7, 1 << 20]),
    descending=st.booleans(),
)
def test_bucketed_running_sum_property(spark, rows, n_buckets, descending):
    df = spark.createDataFrame(rows, "p string, o bigint, x bigint")
    df = df.withColumn("b", F.floor(F.col("o") * n_buckets / 41))
    order = [F.col("o").desc()] if descending else [F.col("o")]
    got = {(r.p, r.o): r.cum_x for r in prefix.bucketed_running_sum(df, ["p"], "b", order, ["x"], descending_buckets=descending).collect()}
    for p, o, _ in rows:
        want = sum(x for q, oo, x in rows if q == p and (oo >= o if descending else oo <= o))
        assert got[(p, o)] == want


@SETTINGS
@given(
    values=st.lists(st.one_of(st.none(), st.integers(-20, 20), st.floats(0, 1e-6)), min_size=1, max_size=40),
    partitions=st.sampled_from([None, 1, 5]),
)
def test_exact_quantiles_property(spark, values, partitions):
    """Equal to linear-interpolation quantiles, including values packed in a tiny range."""
    from featurepipe.operators import profile

    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "x double")
    got = profile.exact_quantiles(df, [], "x", (0.0, 0.25, 0.5, 0.9, 1.0), partitions).first()
    xs = sorted(float(v) for v in values if v is not None)
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        name = f"q{round(q * 100):02d}"
        if not xs:  # no values: no quantile row (distribution_summary left-joins it to nulls)
            assert got is None
            continue
        pos = q * (len(xs) - 1)
        lo, hi = int(pos // 1), min(int(pos // 1) + 1, len(xs) - 1)
        want = xs[lo] + (xs[hi] - xs[lo]) * (pos - lo)
        assert abs(got[name] - want) < 1e-9, (q, got[name], want)
