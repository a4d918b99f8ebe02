from datetime import datetime, timedelta

from featurepipe.sources.roles import Roles

TXN_SCHEMA = (
    "txn_id bigint, customer_id bigint, merchant_id bigint, amount double, ts timestamp_ntz, "
    "is_fraud int, device_type string, event_type string"
)


def ts(s: str) -> datetime:
    return datetime.fromisoformat(s)


def txn_frame(spark, rows):
    return spark.createDataFrame(rows, TXN_SCHEMA)


def roles_of(spark, txn_rows, merchants=None, profiles=None):
    merchants = merchants if merchants is not None else [(1, 0.9, "NATION_1"), (2, 0.1, "NATION_2")]
    profiles = profiles if profiles is not None else [(c, 600, 100, 1000.0) for c in range(1, 20)]
    return Roles(
        txn_frame(spark, txn_rows),
        spark.createDataFrame(merchants, "merchant_id bigint, risk_score double, category string"),
        spark.createDataFrame(profiles, "customer_id bigint, credit_score int, account_age_days int, annual_income double"),
    )


def plan_text(df, mode: str = "formatted") -> str:
    """The physical plan as ``explain`` prints it."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def rows_by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


__all__ = ["ts", "txn_frame", "roles_of", "rows_by", "plan_text", "timedelta"]
