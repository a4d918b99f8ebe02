"""Driver contract and the SQL oracle at sf0.001 (the driver checks sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from featurepipe.plans.oracle import SQL
from featurepipe.plans.queries import REGISTRY
from featurepipe.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {"q15_gbt_fit_score", "q16_cross_validation", "q16_cv_summary", "q17_feature_importance"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "customer_id" in df.columns


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(REGISTRY) - set(E.oracle_sql()) == ROWS_ONLY


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _canon(df):
    import math

    cols = sorted(df.columns)
    out = []
    for r in df[cols].itertuples(index=False):
        vals = []
        for v in r:
            if v is None or (isinstance(v, float) and math.isnan(v)):
                vals.append(None)
            elif hasattr(v, "isoformat"):
                vals.append(v.isoformat())
            elif isinstance(v, float):
                vals.append(round(v, 6) + 0.0)
            else:
                vals.append(v.item() if hasattr(v, "item") else v)
        out.append(tuple(map(str, vals)))
    return cols, sorted(out)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, con, key):
    got = E.queries()[key](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[key]).df()
    assert _canon(got) == _canon(want)


@pytest.mark.parametrize("key", sorted(ROWS_ONLY))
def test_rows_only_queries(spark, key):
    df = E.queries()[key](spark, SF)
    rows = df.collect()
    assert len(rows) > 0
    if key == "q15_gbt_fit_score":
        assert all(abs(r.p0 + r.p1 - 1) < 1e-9 and 0 <= r.p1 <= 1 and r.prediction in (0, 1) for r in rows)
    if key == "q16_cross_validation":
        assert sorted(r.fold for r in rows) == [0, 1, 2, 3, 4]
    if key == "q16_cv_summary":
        assert rows[0].folds == 5 and 0 <= rows[0].cv_auc_mean <= 1 and rows[0].cv_auc_std >= 0
    if key == "q17_feature_importance":
        assert len(rows) == 12 and abs(sum(r.importance for r in rows) - 1) < 1e-6
