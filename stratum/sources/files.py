"""Incremental file source, landed files by header name, and the landing writer.

The file stream remembers in its checkpoint which files it has processed, so a
rerun takes only files that arrived since (a run with no new file adds nothing).
It names the files of a micro-batch; they are then read with the declared schema.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The landing CSV dialect used for every dataset.
CSV_DIALECT = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "mode": "PERMISSIVE",
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}

TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"

#: Longer than any file's age. Spark's own default skips, without a word, a file
#: more than seven days older than the newest one seen.
ANY_AGE = "36500d"

#: Bytes of one landing file, about. A multi-line CSV file is read by one task.
LANDING_FILE_BYTES = 64 << 20
TEXT_BYTES = 16


#: Fields beyond the header's that are kept one by one; a longer line is also kept whole.
SURPLUS = 8
_LINE = "_line"


def read_file_stream(spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None,
                     max_file_age: str | None = None, archive: str | None = None) -> DataFrame:
    """Stream of the (path) of files landing under ``path`` (a directory or glob),
    a micro-batch at most so many files or bytes (Spark takes one limit; bytes, if
    given). Files of any age are taken unless ``max_file_age`` (Spark's option)
    narrows it: older ones are then skipped. Processed files move to ``archive``,
    if given, so that the folder to list does not grow."""
    limit = {"maxBytesPerTrigger": str(max_bytes)} if max_bytes else {"maxFilesPerTrigger": str(max_files)} if max_files else {}
    clean = {"cleanSource": "archive", "sourceArchiveDir": archive} if archive else {}
    # Spark's columns of whole files; only the path is read.
    return (spark.readStream.format("binaryFile")
            .schema("path string, modificationTime timestamp, length bigint, content binary")
            .options(maxFileAge=max_file_age or ANY_AGE, **limit, **clean).load(path).select("path"))


def read_files(spark: SparkSession, path: str | Sequence[str], file_format: str,
               options: Mapping[str, str], schema: T.StructType) -> DataFrame:
    """Batch read with the declared schema, CSV fields by their place."""
    return spark.read.format(file_format).schema(schema).options(**dict(options)).load(path)


def literal(path: str) -> str:
    """The path with the characters escaped that a reader would expand."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def read_files_by_name(spark: SparkSession, paths: Sequence[str], options: Mapping[str, str], columns: Sequence[str],
                       rescued: str | None, provenance: str) -> DataFrame:
    """CSV files with the declared columns, found by name in each file's header,
    and the file's path as ``provenance``.

    A declared column that a header lacks is NULL. What fits no declared column is
    kept as a JSON object in ``rescued``: fields of other header names (or of a
    name's second place) under the name, fields beyond the header under ``_c<place>``
    (from 0), and the whole line of a row with fewer fields than its header, or with
    more than ``SURPLUS`` beyond it, under ``_line``. A row that fits has NULL there.

    Files with the same header are read together; the first lines are found by a
    pass of the text reader (a header is one line, in UTF-8)."""
    parts = [_with_header(spark, header, same, options, columns, rescued, provenance)
             for header, same in _headers(spark, paths)]
    if not parts:
        names = [*columns, *([rescued] if rescued else []), provenance]
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))
    return reduce(DataFrame.unionByName, parts)


def _headers(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, list[str]]]:
    """(header line, paths of the files that begin with it), one row per file; none for empty files."""
    lines = (spark.read.text([literal(p) for p in paths])
             .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                     F.monotonically_increasing_id().alias("at"))
             .where("start = 0 AND trim(value) <> ''").groupBy("path").agg(F.min_by("value", "at").alias("header")))
    found: dict[str, list[str]] = {}
    for r in sorted(lines.collect()):
        found.setdefault(r.header, []).append(unquote(r.path))
    return sorted(found.items())


def _with_header(spark: SparkSession, header: str, paths: Sequence[str], options: Mapping[str, str],
                 columns: Sequence[str], rescued: str | None, provenance: str) -> DataFrame:
    options = {**options, "enforceSchema": "true", "columnNameOfCorruptRecord": _LINE}
    quote, escape = options.get("quote", '"'), options.get("escape", "\\")
    names = next(csv.reader([header.lstrip("\ufeff")], delimiter=options.get("sep", ","), quotechar=quote,
                            doublequote=escape == quote, escapechar=None if escape == quote else escape))
    names = [n.strip() for n in names]
    fields = [f"f{i}" for i in range(len(names))]
    schema = T.StructType([T.StructField(f, T.StringType()) for f in (*fields, _LINE)])
    rows = read_files(spark, [literal(p) for p in paths], "csv", options, schema)
    place = {n: i for i, n in reversed(list(enumerate(names))) if n in columns}
    declared = [(F.col(fields[place[c]]) if c in place else F.lit(None).cast("string")).alias(c) for c in columns]
    source = F.col("_metadata.file_path").alias(provenance)
    if not rescued:
        return rows.select(*declared, source)
    other = [(names[i], F.col(f)) for i, f in enumerate(fields) if place.get(names[i]) != i]
    wide = len(names) + SURPLUS
    taken: dict[str, int] = {}
    parsed = F.from_csv(F.col(_LINE), ", ".join(f"w{i} string" for i in range(wide)),
                        {k: v for k, v in options.items() if k in ("sep", "quote", "escape", "ignoreLeadingWhiteSpace",
                                                                   "ignoreTrailingWhiteSpace")})
    beyond = [(f"_c{i}", F.col(f"_wide.w{i}")) for i in range(len(names), wide)]
    long = reduce(lambda a, b: a | b, [v.isNotNull() for _, v in beyond])
    whole = F.when(F.col(_LINE).isNotNull() & (~long | beyond[-1][1].isNotNull()), F.col(_LINE))
    # Rows that fit, nearly all, are done with a null check.
    of_line = F.when(F.col(_LINE).isNotNull(), _entries([*beyond, (_LINE, whole)], taken))
    kept = F.concat(_entries(other, taken), F.coalesce(of_line, _entries([], taken))) if other else of_line
    misfit = F.when(F.size("_kept") > 0, F.to_json(F.map_from_entries("_kept")))
    return (rows.withColumn(provenance, source).withColumn("_wide", F.when(F.col(_LINE).isNotNull(), parsed))
            .withColumn("_kept", kept).select(*declared, misfit.alias(rescued), provenance))


def _entries(pairs: Sequence[tuple[str, Column]], taken: dict[str, int]) -> Column:
    """The pairs that have a value; a name's second place is numbered."""
    out = []
    for name, value in pairs:
        taken[name] = taken.get(name, 0) + 1
        key = name if taken[name] == 1 else f"{name}#{taken[name]}"
        out.append(F.struct(F.lit(key).alias("key"), value.alias("value")))
    if not out:
        return F.array().cast("array<struct<key:string,value:string>>")
    return F.filter(F.array(*out), lambda e: e["value"].isNotNull())


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text: how a landing CSV carries values before Silver types
    them. Dates and timestamps in one layout, with the fraction of a second if any."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(c, TIMESTAMP_TEXT).alias(f.name))
        else:
            cols.append(c.cast("string").alias(f.name))
    return df.select(*cols)


def write_landing(df: DataFrame, path: str, options: Mapping[str, str] | None = None,
                  file_bytes: int = LANDING_FILE_BYTES) -> None:
    """Write a DataFrame as landing CSV files (a new drop into ``path``).

    Appends, so earlier drops stay. Files are bounded by bytes (about ``TEXT_BYTES`` a
    column and row), so the ingest stays parallel without
    millions of small files.
    """
    text = as_text(df)
    row_bytes = TEXT_BYTES * max(1, len(text.columns))
    opts = {k: v for k, v in (options or CSV_DIALECT).items()
            if k in ("header", "sep", "quote", "escape", "encoding", "compression")}
    (text.write.mode("append").options(**opts)
     .option("maxRecordsPerFile", str(max(1, file_bytes // row_bytes))).csv(path))
