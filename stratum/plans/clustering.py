"""Silver tables bucketed by the key that the facts join and aggregate on.

Four facts read orders, items, payments and reviews, and each of them exchanges
these tables by order id again. Written once as tables bucketed by it, each bucket
one sorted file, every aggregate and join on the order id reads its side of a bucket
where it is: no exchange between scan and join, however many facts follow. A
Silver table itself is a base and its changes, whose union has no bucketing, so the
copies live for one build and are removed after it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from stratum.sources import storage

#: Silver tables that are joined by order id.
ORDER_KEY = "order_id"
BY_ORDER = ("orders", "order_items", "order_payments", "order_reviews")


@contextmanager
def clustered(spark: SparkSession, frames: Mapping[str, DataFrame], root: str, key: str = ORDER_KEY,
              buckets: int | None = None) -> Iterator[dict[str, DataFrame]]:
    """Bucketed copies of the frames under ``root`` while the block runs. ``buckets``:
    by default the session's shuffle partitions, as the exchanges would have."""
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"clustered_{uuid.uuid4().hex[:12]}"
    path = f"{root}/_{name}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    try:
        out = {}
        for table, rows in frames.items():
            # Rows move by the hash that buckets go by, so each task writes one bucket.
            (rows.repartition(n, key).write.bucketBy(n, key).sortBy(key).format("parquet")
             .option("path", f"{path}/{table}").saveAsTable(f"{name}.{table}"))
            out[table] = spark.table(f"{name}.{table}")
        yield out
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")
        storage.remove(spark, path)
