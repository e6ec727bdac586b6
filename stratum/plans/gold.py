"""Gold layer: dimensions, the calendar, and the four facts.

Each fact takes Silver-shaped DataFrames and returns one lazy DataFrame, so
Catalyst sees the whole plan (column pruning and not-null filters reach the
scans). Shape rules followed throughout, for scale:

* aggregate before joining, so each join's build side has one row per key and
  a hot key is folded by the map-side partial aggregate instead of landing in
  one join task;
* joins carry no broadcast hint: the size-checked broadcast threshold and AQE
  pick broadcast for a small side and sort-merge otherwise;
* fact rows keep the grain the fact defines; nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.expressions import (calendar_columns, days_between,
                                           late_flag, line_total)
from stratum.operators.ranking import with_pick_key
from stratum.operators.refine import select_columns
from stratum.specs import load_spec

# ---------------------------------------------------------------- dimensions


def dimension(silver: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Configured column subset of a Silver table (metadata columns dropped)."""
    return select_columns(silver, columns)


def dim_dates(spark: SparkSession, start, end=None, ahead_days: int = 90) -> DataFrame:
    """One row per calendar day from ``start`` to ``end``, both inclusive.

    ``start``/``end`` are dates, ISO strings or Columns; ``end`` defaults to
    ``current_date() + ahead_days``. A calendar has one row per day, so its
    size is bounded by the date range, not by the data.
    """
    lo = F.lit(start) if not isinstance(start, Column) else start
    if end is None:
        hi = F.current_date() + F.make_interval(days=F.lit(ahead_days))
    else:
        hi = F.lit(end) if not isinstance(end, Column) else end
    # Without a zone, as a zone's clock changes would move or drop days.
    lo, hi = (F.date_trunc("day", b.cast("timestamp_ntz")).cast("timestamp_ntz") for b in (lo, hi))
    days = spark.range(1).select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*calendar_columns("d")).orderBy("date_id")


def dim_dates_from(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """Calendar over bounds computed by Spark (one-row DataFrame)."""
    days = bounds.select(F.explode(F.sequence(F.col(start_col).cast("date"),
                                              F.col(end_col).cast("date"),
                                              F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*calendar_columns("d")).orderBy("date_id")


def calendar_bounds(orders: DataFrame, ahead_days: int = 90) -> DataFrame:
    """One-row bounds for the calendar over the data: January 1st of the first
    purchase year through the last purchase + ``ahead_days``."""
    return orders.agg(
        F.trunc(F.min("order_purchase_timestamp").cast("date"), "year").alias("start"),
        F.date_add(F.max("order_purchase_timestamp").cast("date"), ahead_days).alias("end"),
    )


def gold_columns(name: str) -> tuple[str, ...] | None:
    """Column list of a Gold dimension spec."""
    return load_spec(name, "gold").columns


# --------------------------------------------------------------------- facts


def fact_sales(orders: DataFrame, order_items: DataFrame, customers: DataFrame) -> DataFrame:
    """Order grain: value of the order's items, customer state, and days from
    purchase to delivery. Orders without items keep a NULL value."""
    totals = (order_items
              .groupBy("order_id")
              .agg(F.sum(line_total("price", "freight_value")).alias("total_order_value")))
    o = orders.select(
        "order_id", "customer_id", "order_status",
        days_between("order_delivered_customer_date", "order_purchase_timestamp")
        .alias("delivery_time_days"),
    )
    states = customers.select("customer_id", "customer_state")
    return (o.join(totals, "order_id", "left")
             .join(states, "customer_id", "left")
             .select("order_id", "customer_id", "order_status", "total_order_value",
                     "customer_state", "delivery_time_days"))


def order_late_and_score(orders: DataFrame, order_reviews: DataFrame) -> DataFrame:
    """Per order present in ``orders``: late count (0/1) and mean review score.

    Both inputs are grouped by ``order_id``, so the join between them reuses
    that partitioning. The score hangs off the *order* row: an item whose order
    is missing gets neither a late count nor a score.
    """
    late = (orders.groupBy("order_id")
            .agg(F.count(late_flag("order_delivered_customer_date",
                                   "order_estimated_delivery_date")).alias("count_overdue_delivery")))
    scores = (order_reviews.groupBy("order_id")
              .agg(F.avg("review_score").alias("avg_review_score")))
    return late.join(scores, "order_id", "left")


def fact_seller_performance(sellers: DataFrame, order_items: DataFrame, orders: DataFrame,
                            order_reviews: DataFrame, ordered: bool = True) -> DataFrame:
    """Seller grain: revenue, late deliveries and mean order score.

    Late count and score are at order-item grain: an order with three items of
    a seller counts three times. Items are aggregated per seller *before* the
    join to ``sellers``, so a seller holding a large share of the items is
    summed on the map side rather than joined row by row; sellers without items
    keep NULL measures.
    """
    per_order = order_late_and_score(orders, order_reviews)
    per_seller = (order_items.select("order_id", "seller_id", "price")
                  .join(per_order, "order_id", "left")
                  .groupBy("seller_id")
                  .agg(F.sum("price").alias("sum_revenue"),
                       F.sum("count_overdue_delivery").alias("count_overdue_delivery"),
                       F.avg("avg_review_score").alias("avg_review_score")))
    out = (sellers.select("seller_id").join(per_seller, "seller_id", "left")
           .select("seller_id", "sum_revenue", "count_overdue_delivery", "avg_review_score"))
    return out.orderBy(F.col("count_overdue_delivery").desc_nulls_last(), "seller_id") if ordered else out


def fact_product_performance(order_items: DataFrame, products: DataFrame,
                             order_reviews: DataFrame) -> DataFrame:
    """Order-item grain: product attributes, freight and the order's mean score.
    ``product_id`` comes from the product side, NULL for an unknown product."""
    p = products.select(
        F.col("product_id").alias("_pid"), "product_category_name", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm")
    scores = (order_reviews.groupBy("order_id")
              .agg(F.avg("review_score").alias("avg_review_score")))
    items = order_items.select("order_id", "product_id", "freight_value")
    return (items.join(p, items["product_id"] == p["_pid"], "left")
                 .join(scores, "order_id", "left")
                 .select(F.col("_pid").alias("product_id"), "product_category_name",
                         "product_weight_g", "product_length_cm", "product_height_cm",
                         "product_width_cm", "order_id", "freight_value", "avg_review_score"))


def payment_totals(order_payments: DataFrame) -> DataFrame:
    """Per order: total paid, distinct methods, most installments, and the
    method of the largest payment (ties: lowest sequence number, then the larger
    name), from one scan.

    Payments are folded by order and method first, into states of fixed width
    only, so Spark hashes them before the first exchange; the order's row is then
    picked from one row per method."""
    keyed = with_pick_key(order_payments.select("order_id", "payment_type", "payment_installments", "payment_value",
                                                "payment_sequential"), "payment_value", "payment_sequential", "largest")
    by_method = (keyed.groupBy("order_id", "payment_type")
                 .agg(F.sum("payment_value").alias("paid"),
                      F.max("payment_installments").alias("installments"),
                      F.max("largest").alias("largest")))
    return (by_method.groupBy("order_id")
            .agg(F.sum("paid").alias("total_payment_value"),
                 F.count("payment_type").alias("total_methods_distincts_payments"),
                 F.max("installments").alias("max_installments"),
                 F.max_by("payment_type", F.struct("largest", "payment_type")).alias("primary_payment_type")))


def fact_payment_summary(order_payments: DataFrame, orders: DataFrame, customers: DataFrame,
                         ordered: bool = True) -> DataFrame:
    """Order-with-payments grain, with the customer's state."""
    o = orders.select("order_id", "customer_id")
    states = customers.select("customer_id", "customer_state")
    out = (payment_totals(order_payments)
           .join(o, "order_id", "left")
           .join(states, "customer_id", "left")
           .select("order_id", "total_payment_value", "total_methods_distincts_payments",
                   "max_installments", "primary_payment_type", "customer_state"))
    return payment_order(out) if ordered else out


def payment_order(payments: DataFrame) -> DataFrame:
    """The payment fact's order; the order id last, so that equal rows can be split."""
    return payments.orderBy(F.col("total_payment_value").desc_nulls_last(),
                            F.col("total_methods_distincts_payments").desc_nulls_last(),
                            F.col("customer_state").asc_nulls_first(), "order_id")

