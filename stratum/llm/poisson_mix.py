"""Mixing sources to target weights by Poisson replication, DataFrame functions only.

Every source gets a mean repetition rate: its target share of the output over
its share of the input. Every row's count is a Poisson variate of that rate: a
uniform number seeded by the row's hash, looked up in the source's cumulative
distribution. The row is exploded by its count, and all copies are shuffled by a
second hash. Same rows and seed, same result, on any number of executors.

A row's hash is that of all its columns and of its number among the rows that equal
it in all of them, so rows without a key, or with one key, are drawn one by one.
Repeated rows are found by a hash of all columns and numbered from 1, by the
partition that they were stored in, so a row repeated without end is in no one
task. Where no row is repeated, every number is 1.

Rates above ``LARGEST_RATE`` are drawn as a sum of independent parts with at most
that rate each (a sum of Poisson variates is one), so exp(-rate) never vanishes.

Defined results: a null source is a source of its own; a source without a given
target weight, or with weight 0, gets rate 0 and none of its rows; columns are hashed as
text, null as empty text; an empty table stays empty. Columns of the input pass
through unchanged; a column of this operator is not added if the input has its name.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import settle

#: A rate up to this is inverted at once; P(count > LARGEST_COUNT) is then under 1e-16.
LARGEST_RATE = 16.0
LARGEST_COUNT = 64
#: Sources, or repeated rows, up to this number are joined by broadcast; beyond, by a shuffle.
BROADCAST_SOURCES = 10_000

RATE, COPIES, COPY, ORDER = "_mix_rate", "_mix_copies", "_mix_copy", "_mix_order"


def joined(*parts: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def unit(digest: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def with_distribution(rates: DataFrame) -> DataFrame:
    """Adds to each rate the number of its parts and the cumulative distribution
    of one part, P(X <= 0) to P(X <= LARGEST_COUNT - 1), its terms added one by one."""
    parts = F.greatest(F.ceil(F.col("rate") / LARGEST_RATE).cast("int"), F.lit(1))
    part = F.col("rate") / F.col("parts")

    def step(state: Column, k: Column) -> Column:
        term = state["term"] * part / k
        return F.struct(term.alias("term"), (state["sum"] + term).alias("sum"),
                        F.concat(state["all"], F.array(state["sum"] + term)).alias("all"))

    first = F.exp(-part)
    start = F.struct(first.alias("term"), first.alias("sum"), F.array(first).alias("all"))
    return rates.withColumn("parts", parts).withColumn(
        "cdf", F.aggregate(F.sequence(F.lit(1), F.lit(LARGEST_COUNT - 1)), start, step, lambda s: s["all"]))


def poisson_count(rate: Column, parts: Column, cdf: Column, *seed: Column) -> Column:
    """A Poisson variate: for each part the number of values of its distribution
    that are not above a number hashed from ``seed``."""
    def one(i: Column) -> Column:
        u = unit(F.md5(joined(*seed, i)))
        return F.aggregate(cdf, F.lit(0), lambda n, p: n + (p <= u).cast("int"))

    drawn = F.when(parts == 1, one(F.lit(1))).otherwise(
        F.aggregate(F.transform(F.sequence(F.lit(1), parts), one), F.lit(0), lambda a, b: a + b))
    return F.when(rate > 0, drawn).otherwise(F.lit(0))


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """(row, ``name``): each row as a struct, and its number among the rows equal to it."""
    columns = [F.to_json(f"`{f.name}`") if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`") for f in docs.schema]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.xxhash64(*columns).alias("h1"), F.hash(*columns).alias("h2"))
    groups = settle(rows.groupBy("h1", "h2").count().where("count > 1").drop("count"), "repeated")
    known = groups.count()
    if not known:
        return rows.select("row", F.lit(1).cast("bigint").alias(name))
    if known <= BROADCAST_SOURCES:
        groups = F.broadcast(groups)
    again = settle(rows.join(groups, ["h1", "h2"], "left_semi").withColumn("part", F.spark_partition_id()), "repeats")
    by_part = again.groupBy("h1", "h2", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("h1", "h2").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("h1", "h2", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("h1", "h2", "part").orderBy(F.lit(1)))
    placed = again.withColumn("place", place).join(offsets, ["h1", "h2", "part"])
    return (rows.join(groups, ["h1", "h2"], "left_anti").select("row", F.lit(1).cast("bigint").alias(name))
            .unionByName(placed.select("row", (F.col("before") + F.col("place")).cast("bigint").alias(name))))


def target_rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None,
                 temperature: float = 0.5, size: float = 1.0, source_col: str = "source") -> DataFrame:
    """(source, rate): with ``weights``, shares in their proportion; without, in
    that of the source's row count to the power ``temperature``. The expected
    output has ``size`` times the rows of the input. One row per source."""
    counts = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(float(temperature)))
    else:
        if any(not math.isfinite(w) or w < 0 for w in weights.values()):
            raise ValueError("target weights must be finite and not negative")
        pairs = [F.lit(x) for k, w in weights.items() if k is not None for x in (k, float(w))]
        of_null = F.lit(float(weights.get(None, 0.0)))
        given = F.create_map(*pairs)[F.col("source")] if pairs else F.lit(None).cast("double")
        weight = F.when(F.col("source").isNull(), of_null).otherwise(F.coalesce(given, F.lit(0.0)))
    weighted = counts.withColumn("w", weight)
    rows, total = weighted.agg(F.sum("n"), F.sum("w")).first()
    if not total:
        return weighted.select("source", F.lit(0.0).alias("rate"))
    return weighted.select("source", (F.lit(float(size)) * F.col("w") / total * float(rows) / F.col("n")).alias("rate"))


def replicate(docs: DataFrame, weights: Mapping[str | None, float] | None = None,
              temperature: float = 0.5, size: float = 1.0, seed: str = "mix",
              source_col: str = "source", shuffle: bool = True) -> DataFrame:
    """``docs`` with every row repeated by its count, in a global random order.

    Adds the rate, the number of copies, the copy's number (from 1) and the
    shuffling key. Rates are joined by broadcast while there are at most
    BROADCAST_SOURCES of them (counted first), else by a shuffle join, whose hot
    sources adaptive execution splits. Texts are shuffled once, to the range of the
    key that they belong to: the key is a uniform hash, so ranges need no sample.
    """
    spark = docs.sparkSession
    rates = target_rates(docs, weights, temperature, size, source_col)
    few = rates.limit(BROADCAST_SOURCES + 1).collect()
    if len(few) <= BROADCAST_SOURCES:
        rates = F.broadcast(with_distribution(spark.createDataFrame(few, "source string, rate double")))
    else:
        rates = with_distribution(rates)
    rows = numbered(docs, "tie").withColumn("of", F.col(f"row.`{source_col}`").cast("string"))
    rated = rows.join(rates, rows["of"].eqNullSafe(rates["source"]))
    whole = F.md5(joined(*[F.col(f"row.`{c}`") for c in docs.columns]).cast("binary"))
    hashed = rated.withColumn("hash", joined(whole, F.col("tie")))
    drawn = hashed.select("row", "rate", "hash", poisson_count(
        F.col("rate"), F.col("parts"), F.col("cdf"), F.lit(seed), F.col("hash")).alias("copies"))
    # Outer, so that no filter on the count is inferred and computed a second time.
    each = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies")))
    copies = drawn.withColumn("copy", F.explode_outer(each)).where("copy IS NOT NULL")
    copies = copies.withColumn("order", F.md5(joined(F.lit(f"{seed}-order"), F.col("hash"), F.col("copy"))))
    if shuffle:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        copies = copies.repartitionById(parts, F.floor(unit(F.col("order")) * parts).cast("int")).sortWithinPartitions("order")
    taken = {c.lower() for c in docs.columns}
    added = [F.col(c).alias(name) for c, name in (("rate", RATE), ("copies", COPIES), ("copy", COPY), ("order", ORDER))
             if name not in taken]
    return copies.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns], *added)
