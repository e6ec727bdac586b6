"""The seven e-commerce tables as views over the driver's TPC-H-like parquet.

Each function reads only the parquet columns it needs (Catalyst prunes the
scan) and returns the Silver column names, so the Gold plans run unchanged on
these views or on real Silver tables. Key types stay as in the source
(bigint), which keeps join keys fixed-width.

| table          | from                                                     |
| -------------- | -------------------------------------------------------- |
| order_items    | lineitem, newest row per (order, line)                   |
| order_payments | lineitem, every row                                      |
| orders         | orders + first/last ship date of its lines               |
| customers      | customer + nation name as state                          |
| sellers        | supplier + nation name as state                          |
| products       | part                                                     |
| order_reviews  | events; two events per order id, score by event type     |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.refine import latest_per_key

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations")

# Days from purchase to the promised delivery date, and the
# review score given to each event type ("error" has no score).
ESTIMATED_DELIVERY_DAYS = 60
REVIEW_SCORES = {"purchase": 5, "click": 4, "view": 3, "signup": 2}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_items_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem as an order item; (order_id, order_item_id) repeats."""
    return order_items_from(table(spark, sf_dir, "lineitem"))


def order_items_from(li: DataFrame) -> DataFrame:
    return li.selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS order_item_id",
        "l_partkey AS product_id",
        "l_suppkey AS seller_id",
        "l_shipdate AS shipping_limit_date",
        "l_extendedprice AS price",
        "l_extendedprice * l_tax AS freight_value",
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest version of each (order_id, order_item_id): latest ship date,
    then higher price, product, seller and freight (a total order)."""
    raw = order_items_raw(spark, sf_dir)
    order = [F.col(c).desc_nulls_last() for c in
             ("shipping_limit_date", "price", "product_id", "seller_id", "freight_value")]
    return latest_per_key(raw, ["order_id", "order_item_id"], order)


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS payment_sequential",
        "l_returnflag AS payment_type",
        "CAST(floor(l_quantity) AS INT) AS payment_installments",
        "l_extendedprice AS payment_value",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with carrier/customer delivery dates from their lines' ship dates
    (NULL while the order is pending) and a promised date 60 days out."""
    ships = (table(spark, sf_dir, "lineitem")
             .groupBy(F.col("l_orderkey").alias("order_id"))
             .agg(F.min("l_shipdate").alias("_first_ship"),
                  F.max("l_shipdate").alias("_last_ship")))
    return (
        table(spark, sf_dir, "orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "o_orderstatus AS order_status",
            "o_orderdate AS order_purchase_timestamp",
        )
        .join(ships, "order_id", "left")
        .selectExpr(
            "order_id", "customer_id", "order_status", "order_purchase_timestamp",
            "order_purchase_timestamp AS order_approved_at",
            "CASE WHEN order_status <> 'P' THEN _first_ship END AS order_delivered_carrier_date",
            "CASE WHEN order_status <> 'P' THEN _last_ship END AS order_delivered_customer_date",
            f"order_purchase_timestamp + INTERVAL {ESTIMATED_DELIVERY_DAYS} DAYS"
            " AS order_estimated_delivery_date",
        )
    )


def _with_nation(df: DataFrame, spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").selectExpr(
        f"n_nationkey AS {key}", "n_name AS _nation_name")
    return df.join(nation, key, "left")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_nation(table(spark, sf_dir, "customer"), spark, sf_dir, "c_nationkey").selectExpr(
        "c_custkey AS customer_id",
        "c_name AS customer_unique_id",
        "c_nationkey AS customer_zip_code_prefix",
        "c_mktsegment AS customer_city",
        "_nation_name AS customer_state",
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_nation(table(spark, sf_dir, "supplier"), spark, sf_dir, "s_nationkey").selectExpr(
        "s_suppkey AS seller_id",
        "CAST(s_nationkey AS STRING) AS seller_zip_code_prefix",
        "s_name AS seller_city",
        "_nation_name AS seller_state",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id",
        "p_type AS product_category_name",
        "length(p_name) AS product_name_lenght",
        "length(p_type) AS product_description_lenght",
        "CAST(p_partkey % 5 + 1 AS INT) AS product_photos_qty",
        "p_size AS product_weight_g",
        "CAST(p_partkey % 50 + 10 AS INT) AS product_length_cm",
        "CAST(p_partkey % 30 + 5 AS INT) AS product_height_cm",
        "CAST(p_partkey % 20 + 5 AS INT) AS product_width_cm",
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = " ".join(f"WHEN '{kind}' THEN {value}" for kind, value in REVIEW_SCORES.items())
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS review_id",
        "event_id div 2 AS order_id",
        f"CASE event_type {cases} END AS review_score",
        "event_type AS review_comment_title",
        "props AS review_comment_message",
        "ts AS review_creation_date",
        "ts AS review_answer_timestamp",
    )


def landing_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """What lands as CSV for each dataset: the raw rows (order items keep
    their repeated keys; Silver deduplicates them), in Silver column order."""
    from stratum.specs import load_spec
    frames = {
        "order_items": order_items_raw(spark, sf_dir),
        "order_payments": order_payments(spark, sf_dir),
        "orders": orders(spark, sf_dir),
        "customers": customers(spark, sf_dir),
        "sellers": sellers(spark, sf_dir),
        "products": products(spark, sf_dir),
        "order_reviews": order_reviews(spark, sf_dir),
    }
    return {n: df.select(*load_spec(n, "silver").column_names) for n, df in frames.items()}
