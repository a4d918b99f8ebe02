from helpers import roles_of, rows_by, ts

from featurepipe.operators import views


def test_customer_view_edge_cases(spark):
    rows = [
        # customer 1: one row -> null std; hour 23 -> late night
        (1, 1, 1, 10.0, ts("2024-01-06 23:10:00"), 1, "mobile", "x"),
        # customer 2: same day-of-year in two years merges; hours 5, 6, 22
        (2, 2, 1, 5.0, ts("2023-03-01 05:00:00"), 0, "mobile", "x"),
        (3, 2, 2, 7.0, ts("2023-03-01 06:00:00"), 0, "mobile", "x"),
        (4, 2, None, 9.0, ts("2024-02-29 22:59:00"), 1, "mobile", "x"),  # 2024-02-29 is day 60 as 2023-03-01
        # customer 99 has no profile: dropped by the inner join
        (5, 99, 1, 1.0, ts("2024-01-01 12:00:00"), 0, "mobile", "x"),
    ]
    out = rows_by(views.customer_risk_view(roles_of(spark, rows)), "customer_id")
    assert set(out) == {1, 2}
    c1, c2 = out[1], out[2]
    assert c1["stddev_txn_amount"] is None and c1["total_txn_count"] == 1
    assert c1["late_night_txn_ratio"] == 1.0 and c1["historical_fraud_count"] == 1
    assert c2["active_days"] == 1  # 2023-03-01 and 2024-02-29 share day-of-year 60
    assert c2["unique_merchants"] == 2  # null merchant not counted
    assert abs(c2["late_night_txn_ratio"] - 1 / 3) < 1e-12  # 05:00 night, 06:00 and 22:59 day
    assert c2["feature_ts"] == ts("2024-02-29 22:59:00")
    cal = rows_by(views.customer_risk_view(roles_of(spark, rows), day_of_year=False), "customer_id")
    assert cal[2]["active_days"] == 2


def test_distinct_counts_equal_view(spark):
    rows = [(i, i % 3, (i * 7) % 5 if i % 4 else None, float(i), ts("2024-01-01 00:00:00").replace(day=1 + i % 20), 0, "m", "x") for i in range(60)]
    r = roles_of(spark, rows)
    a = rows_by(views.customer_aggregates(r.transactions), "customer_id")
    b = rows_by(views.distinct_counts(r.transactions), "customer_id")
    for k in a:
        assert a[k]["unique_merchants"] == b[k]["unique_merchants"]
        assert a[k]["active_days"] == b[k]["active_days"]


def test_transaction_view_flags(spark):
    rows = [
        (1, 1, 1, 10.0, ts("2024-01-06 05:00:00"), 0, "mobile", "x"),  # Saturday, night
        (2, 1, 3, 30.0, ts("2024-01-07 22:30:00"), 0, "mobile", "x"),  # Sunday, no merchant match, day
        (3, 1, 2, 20.0, ts("2024-01-08 23:00:00"), 0, "mobile", "x"),  # Monday, night
        (4, 2, 1, 0.0, ts("2024-01-08 06:00:00"), 0, "mobile", "x"),  # mean amount 0 -> ratio null
    ]
    out = rows_by(views.transaction_context_view(roles_of(spark, rows)), "txn_id")
    assert [out[i]["is_weekend"] for i in (1, 2, 3)] == [1, 1, 0]
    assert [out[i]["is_late_night"] for i in (1, 2, 3, 4)] == [1, 0, 1, 0]
    assert out[1]["is_high_risk_merchant"] == 1 and out[3]["is_high_risk_merchant"] == 0
    assert out[2]["merchant_risk_score"] is None and out[2]["is_high_risk_merchant"] == 0
    assert out[2]["merchant_category"] is None
    assert abs(out[1]["amount_to_avg_ratio"] - 0.5) < 1e-12
    assert out[4]["amount_to_avg_ratio"] is None


def test_group_mean_join_equals_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    rows = [(i, i % 4, 1, float(i * i % 17), ts("2024-01-01 00:00:00"), 0, "m", "x") for i in range(40)]
    txn = roles_of(spark, rows).transactions
    a = rows_by(views.with_group_mean(txn), "txn_id")
    b = rows_by(txn.withColumn("w", F.avg("amount").over(Window.partitionBy("customer_id"))), "txn_id")
    assert all(abs(a[k]["cust_avg_amount"] - b[k]["w"]) < 1e-9 for k in a)


def test_feature_view_materialise(spark, tmp_path):
    rows = [(1, 1, 1, 10.0, ts("2024-01-06 23:10:00"), 1, "mobile", "x")]
    r = roles_of(spark, rows)
    back = views.CUSTOMER_RISK_FEATURES.materialise(spark, r, str(tmp_path))
    assert back.count() == 1 and views.CUSTOMER_RISK_FEATURES.address == "CUSTOMER_RISK_FEATURES__V1"
    assert back.columns == views.CUSTOMER_VIEW_COLUMNS


def test_approx_distinct_option(spark):
    rows = [(i, i % 3, i % 7, float(i), ts("2024-01-01 00:00:00").replace(day=1 + i % 20), 0, "m", "x") for i in range(200)]
    r = roles_of(spark, rows)
    exact = rows_by(views.customer_aggregates(r.transactions), "customer_id")
    approx = rows_by(views.customer_aggregates(r.transactions, approx_rsd=0.01), "customer_id")
    for k in exact:
        assert abs(approx[k]["unique_merchants"] - exact[k]["unique_merchants"]) <= 1
        assert abs(approx[k]["active_days"] - exact[k]["active_days"]) <= 1
        assert approx[k]["total_txn_count"] == exact[k]["total_txn_count"]
