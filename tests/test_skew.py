"""A customer holding a third of all orders: the left outer join to customers
is split by AQE's skew handling, and the result is unchanged."""

import pytest
from pyspark.sql import functions as F

from stratum.plans import gold
from stratum.sources import retail

from sf_dirs import SF_MID

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_customer_join_is_split(spark, skew_conf):
    orders = retail.orders(spark, SF_MID)
    hot = orders.withColumn(   # every third order moves to customer 1
        "customer_id", F.when(F.col("order_id") % 3 == 0, F.lit(1)).otherwise(F.col("customer_id")))
    items = retail.order_items(spark, SF_MID)
    customers = retail.customers(spark, SF_MID)
    df = gold.fact_sales(hot, items, customers)
    rows = df.collect()
    plan = _final_plan(df)
    assert "isFinalPlan=true" in plan
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan, plan[:3000]

    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        plain = gold.fact_sales(hot, items, customers).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert sorted(map(tuple, rows), key=lambda t: t[0]) == sorted(map(tuple, plain), key=lambda t: t[0])
    assert len(rows) == orders.count()


def test_hot_product_join_is_split(spark, skew_conf):
    items = retail.order_items(spark, SF_MID)
    hot = items.withColumn(    # every third item becomes product 1
        "product_id", F.when(F.col("order_id") % 3 == 0, F.lit(1)).otherwise(F.col("product_id")))
    products = retail.products(spark, SF_MID)
    reviews = retail.order_reviews(spark, SF_MID)
    df = gold.fact_product_performance(hot, products, reviews)
    n = len(df.collect())
    plan = _final_plan(df)
    assert "SortMergeJoin(skew=true)" in plan
    assert n == items.count()
