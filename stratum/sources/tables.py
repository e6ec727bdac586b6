"""Table reads: a table that is replaced as a whole, and the rows appended to a
Bronze table, by its name in the catalog or by its path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from stratum.sources import storage
from stratum.sources.files import ANY_AGE


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The live content of a table written by ``storage.write_snapshot``."""
    live = storage.live_snapshot(spark, path)
    if live is None:
        raise ValueError(f"no complete table at {path}")
    return spark.read.parquet(live)


def bronze_exists(spark: SparkSession, path: str) -> bool:
    return bool(storage.batches(spark, path))


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the committed batches of the Bronze table at ``path``."""
    done = storage.batches(spark, path)
    if not done:
        raise ValueError(f"no complete table at {path}")
    return spark.read.parquet(*done)


def read_bronze_stream(spark: SparkSession, table: str, max_files_per_trigger: int,
                       schema: StructType | None = None) -> DataFrame:
    """Stream of the rows appended to a Bronze table (a catalog name, or a path)
    since the reader's checkpoint. A batch's files come into sight one by one, each
    once and for good, when the batch has been written in full."""
    stream = spark.readStream.option("maxFilesPerTrigger", str(max_files_per_trigger)).option("maxFileAge", ANY_AGE)
    if "/" not in table:
        return stream.table(table).drop(storage.BATCH)
    return stream.schema(schema or read_bronze(spark, table).schema).parquet(table).drop(storage.BATCH)
