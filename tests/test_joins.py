"""Heavy-hitter join: the same rows as a plain join, and a key with half of the rows spread over the tasks."""

from pyspark.sql import functions as F

from featurepipe.functions.joins import hot_keys, join_hot


def _sides(spark, n=20_000):
    key = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 3000).cast("bigint")
    left = spark.range(0, n, 1, 4).select(F.col("id").alias("row"), key.alias("k"))
    return left, left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


def test_join_hot_equals_the_plain_join(spark):
    left, right = _sides(spark)
    want = {(r.row, r.k, r.n) for r in left.join(right, "k", "left").collect()}
    for parts in (1, 4, 32):
        got = join_hot(left, right, "k", parts=parts).collect()
        assert len(got) == 20_000 and {(r.row, r.k, r.n) for r in got} == want
    assert join_hot(left.limit(0), right, "k").collect() == []


def test_the_hot_key_is_found_and_spread_over_tasks(spark):
    left, right = _sides(spark)
    assert [r._hot for r in hot_keys(left, "k", 32).collect()] == [7]
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled") if spark.conf.get(k, None) is not None}
    try:
        for k, v in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.shuffle.partitions", "32"), ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
            spark.conf.set(k, v)

        def most(df):
            return max(r.rows for r in df.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.count(F.lit(1)).alias("rows"), F.max("n")).collect())

        assert most(left.join(right, "k", "left")) >= 10_000  # one task has the hot key
        assert most(join_hot(left, right, "k")) < 2.5 * 20_000 / 32
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for k, v in kept.items():
            spark.conf.set(k, v)
