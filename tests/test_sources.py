from helpers import ts
from pyspark.sql import functions as F

from featurepipe.sources import roles, tables

SF = "/root/testdata/sf0.001"


def test_text_to_ntz_moves_column_last_and_nulls_bad_text(spark):
    df = spark.createDataFrame([(1, "2024-01-02 03:04:05.123456", "a"), (2, "not a time", "b"), (3, "2024-02-29 00:00:00", "c")],
                               "id bigint, ts string, tag string")
    out = tables.text_to_ntz(df, "ts")
    assert out.columns == ["id", "tag", "ts"] and dict(out.dtypes)["ts"] == "timestamp_ntz"
    got = {r.id: r.ts for r in out.collect()}
    assert got == {1: ts("2024-01-02 03:04:05.123456"), 2: None, 3: ts("2024-02-29 00:00:00")}
    fmt = tables.text_to_ntz(spark.createDataFrame([("02/01/2024 10:00",)], "ts string"), "ts", "dd/MM/yyyy HH:mm")
    assert fmt.first().ts == ts("2024-01-02 10:00:00")


def test_role_mappings(spark):
    r = roles.roles(spark, SF)
    txn = r.transactions
    assert set(txn.columns) >= {"txn_id", "customer_id", "merchant_id", "amount", "ts", "is_fraud", "device_type"}
    assert {x.device_type for x in txn.select("device_type").distinct().collect()} == set(roles.DEVICE_TYPES)
    frauds = txn.where("is_fraud = 1").select(F.countDistinct("event_type")).first()[0]
    assert frauds == 1
    m = r.merchants.agg(F.min("risk_score"), F.max("risk_score")).first()
    assert 0.0 <= m[0] <= m[1] <= 1.0
    p = r.profiles.agg(F.min("credit_score"), F.max("credit_score")).first()
    assert 300 <= p[0] <= p[1] <= 850
    li = roles.roles(spark, SF, "lineitem").transactions
    assert li.count() == li.select("txn_id").distinct().count()


def test_spread_only_where_set(spark):
    plain = tables.read_table(spark, SF, "events", spread_by="event_id")
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(tables.SPREAD_CONF, "7")
    try:
        df = tables.read_table(spark, SF, "events", spread_by="event_id")
        assert df.rdd.getNumPartitions() == 7 and plain.count() == df.count()
    finally:
        spark.conf.unset(tables.SPREAD_CONF)
