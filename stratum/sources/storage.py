"""Files of a table on whatever file system its path names, through Hadoop's
file system API (the one Spark itself writes with): list, size, remove.

A directory counts as written once Spark's committer has put ``_SUCCESS`` into
it; a write that died leaves none, is never read, and is overwritten by its
repetition. That marker is the only commit point used here.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Entries of a directory; none if it is not there."""
    fs, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    fs, where = _at(spark, path)
    return fs.getContentSummary(where).getLength() if fs.exists(where) else 0


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced as a whole; complete once this returns."""
    fs, where = _at(spark, path)
    with_data = fs.create(where, True)
    with_data.write(bytearray(text.encode("utf-8")))
    with_data.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def set_time(spark: SparkSession, path: str, when: dt.datetime) -> None:
    """Date a file."""
    fs, where = _at(spark, path)
    fs.setTimes(where, int(when.timestamp() * 1000), -1)


def committed(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/_SUCCESS")


def numbered(spark: SparkSession, path: str, label: str) -> list[int]:
    """Numbers of the committed directories ``<label>=<n>`` of ``path``, ascending."""
    found = (re.fullmatch(f"{label}=(\\d+)", n) for n in names(spark, path))
    return sorted(int(m[1]) for m in found if m and committed(spark, f"{path}/{m[0]}"))


def move(spark: SparkSession, file: str, folder: str) -> None:
    """Move a file into a folder, which is made if it is not there."""
    fs, where = _at(spark, file)
    into = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs.mkdirs(into)
    if not fs.rename(where, into):
        raise OSError(f"{file} could not be moved to {folder}")


BATCH = "batch"


def batches(spark: SparkSession, path: str) -> list[str]:
    """Paths of the committed batch directories of an append-only table, in one listing."""
    fs, where = _at(spark, path)
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where, f"{BATCH}=*/_SUCCESS"))
    return sorted(s.getPath().getParent().toString() for s in found or ())


def append_batch(df: DataFrame, path: str, name: str) -> None:
    """Append one batch to a table, once: the rows are written aside, and their
    files moved into the batch's directory, the marker last. The repetition of a
    batch that died goes on where it stopped, and of a finished one does nothing;
    so a file that a stream has seen is part of the table for good."""
    spark, aside, target = df.sparkSession, f"{path}/_staging/{name}", f"{path}/{BATCH}={name}"
    if committed(spark, target):
        return
    if not committed(spark, aside):
        df.write.mode("overwrite").parquet(aside)
    for file in sorted(names(spark, aside), key=lambda f: f == "_SUCCESS"):
        move(spark, f"{aside}/{file}", target)
    remove(spark, aside)


SNAPSHOT = "snapshot"


def live_snapshot(spark: SparkSession, path: str) -> str | None:
    """The newest complete snapshot of a table that is replaced as a whole."""
    done = numbered(spark, path, SNAPSHOT)
    return f"{path}/{SNAPSHOT}={done[-1]}" if done else None


def write_snapshot(df: DataFrame, path: str, file_format: str = "parquet") -> str:
    """Replace a table: a new directory becomes the live one when its write is
    committed; until then, and if it fails, readers see the one before. That one
    stays for readers that have begun; older ones are removed."""
    spark = df.sparkSession
    done = numbered(spark, path, SNAPSHOT)
    new = f"{path}/{SNAPSHOT}={done[-1] + 1 if done else 1}"
    df.write.mode("overwrite").format(file_format).save(new)
    for old in done[:-1]:
        remove(spark, f"{path}/{SNAPSHOT}={old}")
    return new


@contextmanager
def set_aside(df: DataFrame, path: str) -> Iterator[DataFrame]:
    """The rows as written to a folder of their own beside ``path``, which is removed
    at the end: one statement's result for the next one to read."""
    spark, aside = df.sparkSession, f"{path}_{uuid.uuid4().hex[:12]}"
    try:
        df.write.parquet(aside)
        yield spark.read.parquet(aside)
    finally:
        remove(spark, aside)
