"""A task attempt that dies is retried, and only committed attempts leave
files: the table holds every row exactly once."""

import os

from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from stratum.operators.upsert import KeyedTable, upsert
from stratum.sources.storage import write_snapshot


@F.udf(LongType())
def _fails_first_attempt(x):
    """Test-only fault injection: the first attempt of partition 0 dies."""
    tc = TaskContext.get()
    if tc.partitionId() == 0 and tc.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return x


def _data_files(path):
    return [f for _, _, files in os.walk(path) for f in files
            if f.endswith(".parquet") and not f.startswith(".")]


def test_batch_write_survives_a_failed_task(spark, lake):
    ref = f"{lake.root}/gold/faulty"
    df = spark.range(0, 4000, 1, 4).select(_fails_first_attempt("id").alias("id"))
    out = spark.read.parquet(write_snapshot(df, ref))
    assert out.count() == 4000 and out.distinct().count() == 4000
    assert len(_data_files(ref)) == 4          # no leftover of the failed attempt


def test_upsert_survives_a_failed_task(spark, lake):
    ref = f"{lake.root}/silver/faulty"
    base = spark.range(0, 2000, 1, 4).selectExpr("cast(id as string) k", "id v")
    upsert(base, ref, ["k"])
    batch = (spark.range(1000, 3000, 1, 4).select(_fails_first_attempt("id").alias("id"))
             .selectExpr("cast(id as string) k", "id * 10 v"))
    upsert(batch, ref, ["k"])
    got = {r.k: r.v for r in KeyedTable(spark, ref).read().collect()}
    assert len(got) == 3000
    assert got["5"] == 5 and got["1500"] == 15000 and got["2999"] == 29990
