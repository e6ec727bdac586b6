"""Row-level refinement: provenance, typed projection, required-column filter,
audit columns, and newest-row-per-key.

Every function is ``DataFrame -> DataFrame`` and works the same on a batch and
on a streaming DataFrame (except ``latest_per_key``, which needs a batch: use
it inside ``foreachBatch``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.specs import (INGEST_TS, PROCESSED_TS, RUN_ID, SOURCE_FILE,
                           SilverSpec, is_metadata)


def add_provenance(df: DataFrame, ingest_ts) -> DataFrame:
    """Run timestamp and source file (unless the reader has set it) of each landed
    row; file sources only."""
    source = {} if SOURCE_FILE in df.columns else {SOURCE_FILE: F.col("_metadata.file_path")}
    return df.withColumns({INGEST_TS: F.lit(ingest_ts).cast("timestamp"), **source})


def typed_projection(df: DataFrame, spec: SilverSpec) -> DataFrame:
    """Declared columns in declared order, cast to their declared type, then
    every ``_``-prefixed column of the input unchanged.

    ``on_cast_error='fail'`` uses a plain cast (ANSI mode raises on a malformed
    value); ``'null'`` uses ``try_cast`` so a malformed value becomes NULL.
    """
    lenient = spec.on_cast_error == "null"
    typed = [
        (F.col(c.name).try_cast(c.type) if lenient else F.col(c.name).cast(c.type)).alias(c.name)
        for c in spec.columns
    ]
    meta = [F.col(c) for c in df.columns if is_metadata(c)]
    return df.select(*typed, *meta)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop rows where any required column is NULL (applied after the cast)."""
    conds = [F.col(c).isNotNull() for c in columns]
    if not conds:
        return df
    return df.filter(reduce(lambda a, b: a & b, conds))


def add_audit(df: DataFrame, run_id: str) -> DataFrame:
    return df.withColumns({
        PROCESSED_TS: F.current_timestamp(),
        RUN_ID: F.lit(run_id),
    })


def refine(df: DataFrame, spec: SilverSpec, run_id: str) -> DataFrame:
    """Stateless part of the Silver step: typed projection, required filter,
    audit columns."""
    return add_audit(require_columns(typed_projection(df, spec), spec.required), run_id)


def select_columns(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Configured column list; ``None`` means every non-metadata column."""
    if columns is None:
        columns = [c for c in df.columns if not is_metadata(c)]
    return df.select(*columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   rank_col: str = "_rn") -> DataFrame:
    """Keep the first row of each key under ``order``.

    ``row_number() == 1`` lets Spark plan a partial top-1 per key *before* the
    shuffle (WindowGroupLimit), so a key holding a large share of the rows
    sends at most one row per input partition through the exchange.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) == 1)
              .drop(rank_col))


def version_order(df: DataFrame, keys: Sequence[str], version_column: str) -> list[Column]:
    """A total order for picking the newest row of a key.

    Version column descending (NULL last), then the source file descending (of
    two files of one run the later name wins, whatever their values), then every
    other business column, then the remaining metadata columns. Rows that tie on
    all of these are equal in every business column.
    """
    first = [version_column] + [c for c in (SOURCE_FILE,) if c in df.columns and c != version_column]
    rest = [c for c in df.columns if c not in keys and c not in first]
    return [F.col(c).desc_nulls_last() for c in first + sorted(rest, key=is_metadata)]


def batch_order(df: DataFrame, spec: SilverSpec) -> list[Column]:
    """The order in which a refined batch keeps one row per primary key."""
    return version_order(df, spec.keys, spec.version)
