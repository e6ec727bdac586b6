"""Silver: typed, filtered, deduplicated, upserted by key.

Bronze appends (stream) -> typed projection -> required-column filter ->
audit columns -> per micro-batch: newest row per key -> keyed upsert.

The per-key dedup needs a batch (a row_number window is not allowed on a
stream), hence ``foreachBatch``. Across batches the upsert makes the later
batch win; within a batch the newest ``_ingest_ts`` wins, then the later file.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from stratum.operators.refine import batch_order, refine
from stratum.operators.upsert import KeyedTable
from stratum.session import Lake
from stratum.sources.tables import read_bronze, read_bronze_stream
from stratum.specs import SilverSpec, load_spec
from stratum.streaming.sinks import foreach_batch_stream


def _spec(dataset: str | SilverSpec, conf: Path | str | None) -> SilverSpec:
    return load_spec(dataset, "silver", conf) if isinstance(dataset, str) else dataset


def upsert_batch(spec: SilverSpec, path: str) -> Callable[[DataFrame, str], None]:
    """The micro-batch function: skip empty batches, dedup, upsert."""

    def process(batch: DataFrame, origin: str) -> None:
        if not batch.isEmpty():
            KeyedTable(batch.sparkSession, path).upsert(
                batch, spec.keys, origin, batch_order(batch, spec),
                spec.version if spec.version_guard else None, spec.evolve)

    return process


def refine_stream(spark: SparkSession, dataset: str | SilverSpec, lake: Lake, run_id: str | None = None,
                  max_files_per_trigger: int | None = None, conf: Path | str | None = None) -> str:
    """Refine the Bronze rows appended since the last run; returns the table's path."""
    spec, run_id = _spec(dataset, conf), run_id or str(uuid.uuid4())
    rows = read_bronze_stream(spark, lake.publish_batches(spark, spec.source), max_files_per_trigger or spec.max_files_per_trigger)
    path = lake.path(spec.target)
    foreach_batch_stream(refine(rows, spec, run_id), lake.checkpoint(spec.target), upsert_batch(spec, path))
    _publish(spark, spec, lake)
    return path


def rebuild(spark: SparkSession, dataset: str | SilverSpec, lake: Lake, run_id: str | None = None,
            conf: Path | str | None = None) -> str:
    """Recompute the Silver table from all of Bronze (batch) and replace it, for
    example after a change of its rules. The old content is live until the new
    one is complete. The stream's checkpoint is kept: later runs upsert only
    newer Bronze rows."""
    spec = _spec(dataset, conf)
    rows = refine(read_bronze(spark, lake.path(spec.source)), spec, run_id or str(uuid.uuid4()))
    path = lake.path(spec.target)
    table = KeyedTable(spark, path)
    if not table.exists():
        table.create(rows.schema, spec.keys, spec.version if spec.version_guard else None)
    table.replace(rows, batch_order(rows, spec))
    _publish(spark, spec, lake)
    return path


def compact(spark: SparkSession, dataset: str | SilverSpec, lake: Lake, conf: Path | str | None = None) -> None:
    """Fold the table's changes into a new base now."""
    spec = _spec(dataset, conf)
    KeyedTable(spark, lake.path(spec.target)).compact()
    _publish(spark, spec, lake)


def _publish(spark: SparkSession, spec: SilverSpec, lake: Lake) -> None:
    table = KeyedTable(spark, lake.path(spec.target))
    if lake.databases is not None and table.exists():
        lake.publish(spark, spec.target, table.query())


def read_silver(spark: SparkSession, dataset: str | SilverSpec, lake: Lake,
                conf: Path | str | None = None) -> DataFrame:
    return KeyedTable(spark, lake.path(_spec(dataset, conf).target)).read()
