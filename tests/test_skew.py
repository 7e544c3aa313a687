"""A key holding a third of all rows: joins are split by AQE's skew handling
and aggregations reduce it map-side; results stay whole."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from quire.operators import sales

HOT_BOOK = 7


def hot_rows(n):
    return sum(1 for i in range(n) if i % 3 == 0 or i % 500 == HOT_BOOK)


@contextmanager
def confs(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    try:
        for k, v in kv.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def skewed_lines(spark, n):
    ids = spark.range(n, numPartitions=8)
    return ids.select(
        (F.col("id") % 997).alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(HOT_BOOK)).otherwise(F.col("id") % 500).alias("book_id"),
        F.lit(1).cast("long").alias("qty"), F.lit(2).cast("decimal(10,2)").alias("price"))


def books(spark):
    return spark.range(500).select(F.col("id").alias("book_id"),
                                   F.concat(F.lit("t"), F.col("id").cast("string")).alias("title"),
                                   F.lit("a").alias("author"))


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


def test_hot_key_join_is_split(spark):
    n = 60000
    with confs(spark, **SKEW_CONF):
        df = sales.order_lines(skewed_lines(spark, n), books(spark))
        rows = df.collect()                     # runs this Dataset's own adaptive plan
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "skew=true" in plan
        assert len(rows) == n                                    # nothing dropped
        assert df.filter(F.col("book_id") == HOT_BOOK).count() == hot_rows(n)


def test_hot_key_aggregation_is_combined_map_side(spark):
    n = 60000
    with confs(spark, **SKEW_CONF):
        top = sales.popular_products(skewed_lines(spark, n), books(spark), 1).first()
        assert (top.book_id, top.qty) == (HOT_BOOK, hot_rows(n))
        plan = sales.popular_products(skewed_lines(spark, n), books(spark), 1) \
            ._jdf.queryExecution().executedPlan().toString()
        assert "partial_sum" in plan
