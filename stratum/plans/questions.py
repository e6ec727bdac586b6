"""Questions the Gold tables answer (consumer queries over the facts).

Plain DataFrame aggregates: each groupBy is a partial + final hash
aggregate, so a hot group (one state holding a third of all orders) is summed
on the map side and reaches the final stage as one row per input partition.
Top-k questions use ``orderBy(...).limit(k)``, which Spark plans as a
per-partition top-k plus a final merge (no full sort). Money is summed as
``decimal(38,4)`` so totals do not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(38,4)"


def _money_sum(col: str):
    return F.sum(F.col(col).cast(MONEY))


def avg_order_value_by_state(fact_sales: DataFrame) -> DataFrame:
    """Mean order value per customer state (orders without items skipped)."""
    return (fact_sales.groupBy("customer_state")
            .agg(F.count("total_order_value").alias("valued_orders"),
                 _money_sum("total_order_value").alias("_total"))
            .select("customer_state", "valued_orders",
                    F.round(F.try_divide(F.col("_total").cast("double"), F.col("valued_orders")), 4)
                    .alias("avg_order_value")))


def sales_by_status(fact_sales: DataFrame) -> DataFrame:
    """Order count and sales value per order status."""
    return (fact_sales.groupBy("order_status")
            .agg(F.count(F.lit(1)).alias("orders"),
                 _money_sum("total_order_value").cast("double").alias("sales_value")))


def delivery_time_summary(fact_sales: DataFrame) -> DataFrame:
    """Mean, min and max delivery days over delivered orders."""
    return fact_sales.agg(
        F.count("delivery_time_days").alias("delivered_orders"),
        F.round(F.avg("delivery_time_days"), 6).alias("avg_delivery_days"),
        F.min("delivery_time_days").alias("min_delivery_days"),
        F.max("delivery_time_days").alias("max_delivery_days"),
    )


def top_sellers_by_revenue(fact_seller: DataFrame, k: int = 10) -> DataFrame:
    """C4: the k sellers with the highest revenue (ties by seller id)."""
    return (fact_seller.select("seller_id", "sum_revenue")
            .orderBy(F.col("sum_revenue").desc_nulls_last(), F.col("seller_id").asc())
            .limit(k))


def seller_scores(fact_seller: DataFrame) -> DataFrame:
    """Mean review score per seller."""
    return fact_seller.select("seller_id", "avg_review_score")


def most_late_sellers(fact_seller: DataFrame, k: int = 10) -> DataFrame:
    """The k sellers with the most late deliveries (ties by seller id)."""
    return (fact_seller.select("seller_id", "count_overdue_delivery")
            .orderBy(F.col("count_overdue_delivery").desc_nulls_last(), F.col("seller_id").asc())
            .limit(k))


def categories_by_volume(fact_product: DataFrame) -> DataFrame:
    """Items sold and distinct orders per product category."""
    return (fact_product.groupBy("product_category_name")
            .agg(F.count(F.lit(1)).alias("items_sold"),
                 F.count_distinct("order_id").alias("orders")))


def freight_by_weight(fact_product: DataFrame) -> DataFrame:
    """Freight per product weight: item count and mean freight."""
    return (fact_product.groupBy("product_weight_g")
            .agg(F.count(F.lit(1)).alias("items"),
                 F.round(F.avg("freight_value"), 4).alias("avg_freight_value")))


def weight_freight_correlation(fact_product: DataFrame) -> DataFrame:
    """Pearson correlation of each size measure with freight."""
    return fact_product.agg(*[
        F.round(F.corr(c, "freight_value"), 6).alias(f"corr_{c.removeprefix('product_')}")
        for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
    ])


def categories_by_revenue(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Item revenue per category (the product fact carries no price, so
    this reads the items). Items are summed per product first, so the join
    to products sees one row per product."""
    per_product = (order_items.groupBy("product_id")
                   .agg(_money_sum("price").alias("_revenue"), F.count(F.lit(1)).alias("_items")))
    return (per_product.join(products.select("product_id", "product_category_name"),
                             "product_id", "left")
            .groupBy("product_category_name")
            .agg(F.sum("_revenue").cast("double").alias("revenue"),
                 F.sum("_items").alias("items_sold")))


def worst_rated_products(fact_product: DataFrame, k: int = 10) -> DataFrame:
    """The k products with the lowest mean score over their reviewed
    items (ties by product id)."""
    return (fact_product.filter(F.col("product_id").isNotNull())
            .groupBy("product_id")
            .agg(F.round(F.avg("avg_review_score"), 6).alias("avg_score"),
                 F.count("avg_review_score").alias("reviewed_items"))
            .filter(F.col("avg_score").isNotNull())
            .orderBy(F.col("avg_score").asc(), F.col("product_id").asc())
            .limit(k))


def payments_by_state(fact_payment: DataFrame) -> DataFrame:
    """Orders, money paid and mean installments per customer state."""
    return (fact_payment.groupBy("customer_state")
            .agg(F.count(F.lit(1)).alias("orders"),
                 _money_sum("total_payment_value").cast("double").alias("total_paid"),
                 F.round(F.avg("max_installments"), 6).alias("avg_max_installments")))


def payment_method_mix(fact_payment: DataFrame) -> DataFrame:
    """C11: orders and money per primary payment method."""
    return (fact_payment.groupBy("primary_payment_type")
            .agg(F.count(F.lit(1)).alias("orders"),
                 _money_sum("total_payment_value").cast("double").alias("total_paid"),
                 F.sum(F.when(F.col("total_methods_distincts_payments") > 1, 1).otherwise(0))
                 .alias("multi_method_orders")))
