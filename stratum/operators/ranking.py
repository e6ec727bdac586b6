"""Top-1-per-group picks.

``primary_value`` answers "which category carries the largest value in each
group" as an ordinary aggregate: ``max_by`` over an ordering struct. Spark
computes it partially on the map side, so the shuffle carries one row per
group and input partition, whatever the skew; the window form needs a sort
of every row of the group. The struct's state is not of fixed width, for which
Spark sorts the rows; ``with_pick_key`` is that order as one number, which rows are
folded by in a hash aggregate first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.expressions import with_order_number
from stratum.operators.refine import latest_per_key


def primary_value(pick: str, value: str, sequence: str) -> Column:
    """``pick`` of the row with the largest ``value`` (NULL values last); ties
    go to the smallest ``sequence``, then the largest ``pick``.

    Struct comparison puts a NULL field below every value, which gives the
    NULL-last rule of a descending sort.
    """
    return F.max_by(F.col(pick),
                    F.struct(F.col(value), -F.col(sequence).cast("long"), F.col(pick)))


def with_pick_key(df: DataFrame, value: str, sequence: str, name: str) -> DataFrame:
    """Adds one number that is largest for the largest ``value`` (NULL last) and, of
    equal ones, the smallest ``sequence`` (an int, NULL last): a decimal, which a
    hash aggregate can hold the maximum of."""
    place = F.coalesce(F.lit(1 << 31) - F.col(sequence).cast("int").cast("long"), F.lit(0))
    high = F.col(name).cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)")
    return with_order_number(df, value, name).withColumn(name, high + place.cast("decimal(11,0)"))


def with_positions(ordered: DataFrame, path: str, position: str = "position") -> DataFrame:
    """The rows of a globally sorted DataFrame with their place in it, from 1.

    The sorted rows are written to ``path`` with their partition and place in it;
    the sizes of the partitions (one row each) give every partition's offset. No
    window over all rows, so no task sees them all."""
    spark = ordered.sparkSession
    at = F.monotonically_increasing_id()
    ordered.withColumns({"_part": F.shiftright(at, 33), "_place": at.bitwiseAND((1 << 33) - 1)}).write.parquet(path)
    rows = spark.read.parquet(path)
    offsets, total = [], 0
    for part, n in sorted(rows.groupBy("_part").count().collect()):
        offsets.append((part, total))
        total += n
    starts = spark.createDataFrame(offsets, "_part bigint, _start bigint")
    return (rows.join(starts, "_part").withColumn(position, F.col("_start") + F.col("_place") + 1)
            .drop("_part", "_place", "_start"))


def primary_value_by_window(df: DataFrame, group: Sequence[str], pick: str,
                            value: str, sequence: str, alias: str) -> DataFrame:
    """Same answer as ``primary_value`` via ``row_number`` (the independent
    formulation used to cross-check it)."""
    order = [F.col(value).desc_nulls_last(), F.col(sequence).asc_nulls_last(), F.col(pick).desc_nulls_last()]
    return latest_per_key(df.select(*group, pick, value, sequence), group, order) \
        .select(*group, F.col(pick).alias(alias))
