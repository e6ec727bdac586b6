"""Shared helpers: reading a table, settling an intermediate result in the
shared folder, and Arrow batch functions with a declared output schema."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stratum.session import ensure_checkpoint_dir


_SENT: set[str] = set()


def on_workers(spark: SparkSession) -> None:
    """Make this package importable in the Python tasks of the session's
    application, wherever the driver was started: its modules are added to the
    application once, as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _SENT:
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="stratum-modules-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/{package.name}.zip", "w") as archive:
        for module in sorted(package.rglob("*.py")):
            archive.write(module, module.relative_to(package.parent))
    sc.addPyFile(f"{folder}/{package.name}.zip")
    _SENT.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{label}-{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Write ``df`` to the shared folder (in a folder for each value of ``by``) and
    read it back: cuts the lineage with files every executor can read, so a lost
    executor costs no recomputation."""
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*by).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def residue(column: str, modulus: int) -> Column:
    """crc32 of the column as text, modulo ``modulus`` (null counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(modulus))


def field(df: DataFrame, column: str) -> str:
    """The column's type as DDL, for output schemas that carry it through."""
    return df.schema[column].dataType.simpleString()


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(T._parse_datatype_string(ddl))


#: Bytes of a record batch that a task works at a time; a longer row is one slice.
SLICE_BYTES = 2 << 20


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about SLICE_BYTES, so that a task's memory follows
    neither the session's batch size nor the length of its texts."""
    step = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]],
                ddl: str) -> DataFrame:
    """``mapInArrow`` whose per-task state is built once: ``make()`` returns a
    function from a record batch to columns (name -> list or array)."""
    on_workers(df.sparkSession)
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for part in slices(batch):
                yield record_batch(step(part), schema)

    return df.mapInArrow(run, ddl)


def record_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type)
              for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
