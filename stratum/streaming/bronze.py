"""Bronze: incremental ingest of landing files into an append-only table.

file stream (names of new files) -> per micro-batch: rows by header name, all
text -> provenance columns -> one batch directory of the Bronze table. Rows land
as they came; typing is Silver's job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from stratum.operators.refine import add_provenance
from stratum.session import Lake
from stratum.sources.files import literal, read_file_stream, read_files, read_files_by_name
from stratum.specs import SOURCE_FILE, BronzeSpec, load_spec
from stratum.streaming.sinks import append_stream


def landed_rows(spark: SparkSession, paths: Sequence[str], spec: BronzeSpec, ingest_ts: dt.datetime) -> DataFrame:
    """The rows of landed files, with provenance."""
    if spec.by_name:
        rows = read_files_by_name(spark, paths, spec.options, spec.columns, spec.rescued, SOURCE_FILE)
    else:
        rows = read_files(spark, [literal(p) for p in paths], spec.file_format, spec.options, spec.landing_schema)
    return add_provenance(rows, ingest_ts)


def ingest(spark: SparkSession, dataset: str | BronzeSpec, lake: Lake,
           landing: str | None = None, ingest_ts: dt.datetime | None = None,
           max_files_per_trigger: int | None = None, conf: Path | str | None = None) -> str:
    """Append the files that arrived since the last run; returns the table's path.

    ``ingest_ts`` is one timestamp for the whole run (all rows of a run share
    it, which makes it the version column of Silver).
    """
    spec = load_spec(dataset, "bronze", conf) if isinstance(dataset, str) else dataset
    files = read_file_stream(spark, landing or lake.landing(spec.name),
                             max_files_per_trigger or spec.max_files_per_trigger,
                             None if max_files_per_trigger else spec.max_bytes_per_trigger, spec.max_file_age,
                             lake.archive(spec.name) if spec.archive else None)
    path, when = lake.path(spec.target), ingest_ts or dt.datetime.now(dt.timezone.utc)
    append_stream(files, path, lake.checkpoint(spec.target), lambda paths: landed_rows(spark, paths, spec, when))
    lake.publish_batches(spark, spec.target)
    return path
