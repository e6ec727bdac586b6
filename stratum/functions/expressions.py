"""Column expressions shared by the Gold plans. All are built-in Spark
functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def days_between(end, start) -> Column:
    """Calendar-day boundaries crossed from ``start`` to ``end`` (not 24 h
    periods); NULL if either side is NULL."""
    return F.datediff(_c(end).cast("date"), _c(start).cast("date"))


def late_flag(delivered, promised) -> Column:
    """1 when delivered after the promised time, else NULL (so ``count`` counts
    late rows only; a NULL on either side is not late)."""
    return F.when(_c(delivered) > _c(promised), F.lit(1))


def line_total(price, freight) -> Column:
    """Item value; NULL when either part is NULL, so a sum skips that item."""
    return _c(price) + _c(freight)


def calendar_columns(day) -> list[Column]:
    """Calendar attributes of a date; day_of_week counts Sunday as 1."""
    d = _c(day)
    return [
        d.cast("date").alias("date_id"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.dayofweek(d).alias("day_of_week"),
    ]


def with_order_number(df: DataFrame, value: str, name: str) -> DataFrame:
    """Adds a 64-bit integer that orders as the double ``value`` does (Spark's order:
    NULL first, NaN above all, -0 equal to 0), one to one: the bits of its IEEE form,
    from exponent and mantissa by exact arithmetic, negated below 0. Unlike a struct,
    it can be the state of a hash aggregate. In steps, each used more than once by
    the next, so that Spark computes each one once."""
    v, size, near, lead, exponent = (F.col(f"_{name}_{k}") for k in ("v", "size", "near", "lead", "exponent"))
    steps = [("v", F.col(value).cast("double")), ("size", F.abs(v)),
             ("near", F.least(F.greatest(F.floor(F.log2(size)), F.lit(-1022)), F.lit(1023)).cast("int")),
             ("lead", size * F.pow(F.lit(2.0), -near)),        # log2 can miss a power of two by one
             ("exponent", F.greatest(near + F.when(lead >= 2, 1).when(lead < 1, -1).otherwise(0), F.lit(-1022))),
             ("bits", F.when(F.isnan(v), F.lit((2047 << 52) + 1)).when(size == float("inf"), F.lit(2047 << 52))
              .when(size == 0, F.lit(0))
              .otherwise((exponent + 1022).cast("long") * F.lit(1 << 52)
                         + (size * F.pow(F.lit(2.0), -exponent) * float(1 << 52)).cast("long")))]
    out = df
    for step, made in steps:
        out = out.withColumn(f"_{name}_{step}", made)
    bits = F.col(f"_{name}_bits")
    return (out.withColumn(name, F.coalesce(F.when(v < 0, -bits).otherwise(bits), F.lit(-(1 << 63) + 1)))
            .drop(*[f"_{name}_{step}" for step, _ in steps]))
