"""Keyed upsert (type-1 slowly changing dimension) on plain parquet.

Contract: after ``upsert(batch, table)`` every key of ``batch`` has the batch's
row, every other key keeps its row, and running it again with the same origin
changes nothing (so a replayed micro-batch is harmless).

Layout of a table's directory::

    _layout/snapshot=<n>                   keys, columns and version column (one line of JSON)
    base=<s>[/_bucket=<b>]                 one row per key: all changes up to number s
    _bases/<s>.json                        that base's number of buckets, and the origins folded into it
    changes/_seq=<n>/_origin=<o>           rows of one upsert, one per key

An upsert writes its own change directory and nothing else, so its cost is that
of the batch. Readers take, for each key, the row of the latest change, and the
base's for keys without one. When the changes have grown to a share of the base,
``compact`` writes a new base beside the old one, cut by a hash of the key into
buckets of about ``bucket_bytes`` (larger ones where these would be more than
``MOST_BUCKETS`` small ones). Whatever concerns some keys only (replaced rows
of a read, stored values of a batch) is joined with the buckets of these keys alone.

A directory without Spark's ``_SUCCESS`` marker does not exist for readers, so a
crash at any point leaves the state before the write. An origin gets its number
by the write that commits, above all numbers taken until then: the replay of a
write that died is the latest change, whatever was written or folded in between.
The replay of a committed origin keeps its number: it writes beside its first try
(``_origin=<o>~<k>``, the last committed try counts), or nothing once it is folded.

One writer per table at a time; any number of readers. Directories that a new
base replaces are removed by the compaction after it.
"""

from __future__ import annotations

import json
import math
import re
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.refine import latest_per_key
from stratum.sources import storage

SEQ, ORIGIN, BUCKET = "_seq", "_origin", "_bucket"
#: Changes are folded into the base at this share of its bytes, or this number.
COMPACT_SHARE, MOST_CHANGES = 0.5, 32
#: Bytes of one bucket of a base, about.
BUCKET_BYTES = 128 << 20
#: A base has more buckets than this only if they hold ``BUCKET_BYTES``: each costs a
#: task and a directory, which must not grow with the table where buckets are small.
MOST_BUCKETS = 1_024


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _bucket(keys: Sequence[str], buckets: int) -> str:
    return f"CAST(pmod(xxhash64({', '.join(map(_quoted, keys))}), {buckets}) AS INT)"


def _cuts(size: int, part: int) -> int:
    """The power of two that cuts so many bytes into parts of ``part`` at most, about."""
    return 1 << max(0, math.ceil(math.log2(max(1, size) / part)))


def _among(what: str, buckets: Iterable[int] | None) -> str:
    if buckets is None:
        return "true"
    return f"{what} IN ({', '.join(map(str, sorted(buckets)))})" if buckets else "false"


@dataclass(frozen=True)
class Layout:
    """What every directory of the table agrees on."""
    keys: tuple[str, ...]
    schema: T.StructType
    version: str | None = None

    def to_json(self) -> str:
        return json.dumps({"keys": self.keys, "version": self.version, "schema": self.schema.jsonValue()})

    @staticmethod
    def of_json(text: str) -> "Layout":
        raw = json.loads(text)
        return Layout(tuple(raw["keys"]), T.StructType.fromJson(raw["schema"]), raw["version"])


@dataclass(frozen=True)
class State:
    """The live directories: the base's number (0: none), path, buckets and
    folded origins, and the committed changes after it as (number, path)."""
    base_seq: int
    base: str | None
    changes: tuple[tuple[int, str], ...]
    buckets: int = 1
    folded: frozenset[str] = frozenset()


class KeyedTable:
    """A keyed table under ``path`` (a shared folder)."""

    def __init__(self, spark: SparkSession, path: str, bucket_bytes: int = BUCKET_BYTES):
        self.spark, self.path, self.bucket_bytes = spark, path.rstrip("/"), bucket_bytes

    # ------------------------------------------------------------- reading

    def layout(self) -> Layout | None:
        live = storage.live_snapshot(self.spark, f"{self.path}/_layout")
        return Layout.of_json(self.spark.read.text(live).first().value) if live else None

    def exists(self) -> bool:
        return self.layout() is not None

    def _all_changes(self) -> list[tuple[int, str, str]]:
        """(number, origin, path) of every try of a change, committed or not."""
        out = []
        for name in storage.names(self.spark, f"{self.path}/changes"):
            seq = re.fullmatch(f"{SEQ}=(\\d+)", name)
            for below in storage.names(self.spark, f"{self.path}/changes/{name}") if seq else ():
                origin = re.fullmatch(f"{ORIGIN}=([^~]*)(?:~(\\d+))?", below)
                if origin:
                    out.append((int(seq[1]), int(origin[2] or 0), origin[1], f"{self.path}/changes/{name}/{below}"))
        return [(n, origin, path) for n, _, origin, path in sorted(out)]

    def _committed_changes(self) -> dict[int, tuple[str, str]]:
        """Number -> (origin, path) of its last committed try."""
        return {n: (o, p) for n, o, p in self._all_changes() if storage.committed(self.spark, p)}

    def state(self) -> State:
        bases = storage.numbered(self.spark, self.path, "base")
        seq = bases[-1] if bases else 0
        about = json.loads(storage.read_text(self.spark, f"{self.path}/_bases/{seq}.json") or "{}")
        changes = tuple((n, p) for n, (_, p) in self._committed_changes().items() if n > seq)
        return State(seq, f"{self.path}/base={seq}" if bases else None, changes,
                     about.get("buckets", 1), frozenset(about.get("origins", ())))

    def query(self, state: State | None = None, within: Sequence[int] | None = None) -> str:
        """The table's rows as SQL over its live directories; ``within``: those of
        some buckets of the base only.

        With a base and changes, only the changes are ordered by key, and only the
        base's buckets that hold a changed key are anti-joined with them."""
        layout, state = self._existing(), state or self.state()
        columns = ", ".join(_quoted(f.name) for f in layout.schema)
        keys = ", ".join(map(_quoted, layout.keys))
        same = " AND ".join(f"b.{_quoted(k)} <=> n.{_quoted(k)}" for k in layout.keys)
        cut = state.base is not None and state.buckets > 1
        bucket = _bucket(layout.keys, state.buckets)
        inside = _among(bucket, within) if cut else "true"
        parts = [f"SELECT {columns}, {n} AS {SEQ} FROM parquet.`{p}` WHERE {inside}" for n, p in state.changes]
        if not parts:
            if state.base:
                return f"SELECT {columns} FROM parquet.`{state.base}` WHERE {_among(BUCKET, within) if cut else 'true'}"
            typed = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {_quoted(f.name)}" for f in layout.schema)
            return f"SELECT {typed} WHERE false"
        if state.base is None and len(parts) == 1:
            return f"SELECT {columns} FROM ({parts[0]})"
        changes = " UNION ALL ".join(parts)
        newest = (f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {SEQ} DESC) AS _rn "
                  f"FROM ({changes})) WHERE _rn = 1")
        if state.base is None:
            return newest
        replaced = f"NOT EXISTS (SELECT 1 FROM ({newest}) n WHERE {same})"
        if not cut:
            return f"SELECT {columns} FROM parquet.`{state.base}` b WHERE {replaced} UNION ALL {newest}"
        changed = {r[0] for r in self.spark.sql(f"SELECT DISTINCT {bucket} FROM ({changes})").collect()}
        every = set(range(state.buckets)) if within is None else set(within)
        return (f"SELECT {columns} FROM parquet.`{state.base}` WHERE {_among(BUCKET, every - changed)} UNION ALL "
                f"SELECT {columns} FROM parquet.`{state.base}` b WHERE {_among(BUCKET, every & changed)} AND {replaced} "
                f"UNION ALL {newest}")

    def read(self) -> DataFrame:
        return self.spark.sql(self.query())

    # ------------------------------------------------------------- writing

    def _existing(self) -> Layout:
        layout = self.layout()
        if layout is None:
            raise ValueError(f"no keyed table at {self.path}")
        return layout

    def _write_layout(self, layout: Layout) -> None:
        line = self.spark.createDataFrame([(layout.to_json(),)], "value string").coalesce(1)
        storage.write_snapshot(line, f"{self.path}/_layout", "text")

    def create(self, schema: T.StructType, keys: Sequence[str], version_column: str | None = None) -> Layout:
        """Record the layout; it precedes any data. A path that holds something
        else is refused."""
        if storage.names(self.spark, self.path) not in ([], ["_layout"]):
            raise ValueError(f"{self.path} holds files but no table layout; it is not replaced")
        missing = set(keys) - set(schema.names)
        if missing or not keys:
            raise ValueError(f"keys {sorted(missing)} are not columns of the table" if missing else "a table needs keys")
        plain = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        self._write_layout(Layout(tuple(keys), plain, version_column))
        return self._existing()

    def reconciled(self, batch: DataFrame, layout: Layout, evolve: bool) -> tuple[DataFrame, Layout]:
        """The batch with the table's columns. A column that the batch lacks keeps
        its stored value; one that the table lacks is refused, or added with
        ``evolve``; a changed type is refused."""
        stored = {f.name: f.dataType for f in layout.schema}
        new = [f for f in batch.schema if f.name not in stored]
        changed = [f"{f.name}: {stored[f.name].simpleString()} is now {f.dataType.simpleString()}"
                   for f in batch.schema if f.name in stored and f.dataType != stored[f.name]]
        lost_keys = [k for k in layout.keys if k not in batch.columns]
        if changed or lost_keys or new and not evolve:
            raise ValueError(f"{self.path}: the batch does not fit the table: "
                             + "; ".join([*changed, *[f"key {k} is missing" for k in lost_keys],
                                          *[f"column {f.name} is unknown" for f in new if not evolve]]))
        if new:
            layout = self._add_columns(layout, new)
        missing = [f.name for f in layout.schema if f.name not in batch.columns]
        if missing:
            batch = self._beside_stored(batch, layout, missing)
            batch = batch.withColumns({c: F.col(f"_stored_{c}") for c in missing})
        return batch.select(*layout.schema.names), layout

    def _beside_stored(self, batch: DataFrame, layout: Layout, columns: Sequence[str]) -> DataFrame:
        """The batch with columns ``_stored_<name>`` of the rows stored under its
        keys, read from these keys' buckets alone."""
        state = self.state()
        within = None
        if state.base and state.buckets > 1:
            within = [r[0] for r in batch.select(F.expr(_bucket(layout.keys, state.buckets))).distinct().collect()]
        stored = self.spark.sql(self.query(state, within))
        stored = stored.select(*[F.col(c).alias(f"_stored_{c}") for c in (*layout.keys, *columns)])
        same = [F.col(k).eqNullSafe(F.col(f"_stored_{k}")) for k in layout.keys]
        return batch.join(stored, same, "left")

    def _not_older(self, batch: DataFrame, layout: Layout) -> DataFrame:
        """The rows that are no older than the stored row of their key."""
        version = F.col(layout.version)
        was = F.col(f"_stored_{layout.version}")
        rows = self._beside_stored(batch, layout, [layout.version])
        return rows.where(was.isNull() | F.coalesce(version >= was, F.lit(False))).select(*batch.columns)

    def _add_columns(self, layout: Layout, new: list[T.StructField]) -> Layout:
        """Rewrite the rows with the new columns (null) before the layout says
        so: all live directories always have all columns."""
        wider = replace(layout, schema=T.StructType([*layout.schema, *[T.StructField(f.name, f.dataType) for f in new]]))
        rows = self.read().withColumns({f.name: F.lit(None).cast(f.dataType) for f in new})
        self._write_base(rows, self.state().base_seq, self._next_seq())
        self._write_layout(wider)
        return wider

    def _next_seq(self) -> int:
        bases = storage.numbered(self.spark, self.path, "base")
        return max([0, *bases[-1:], *[n for n, _, _ in self._all_changes()]]) + 1

    def upsert(self, batch: DataFrame, keys: Sequence[str], origin: str | None = None,
               order: Sequence[Column] | None = None, version_column: str | None = None,
               evolve: bool = False) -> None:
        """Insert new keys and replace existing ones with the batch's rows.

        ``origin`` names the batch: the same origin again replaces what it
        wrote, at its place in the order of changes. Rows of one key in the batch are folded by ``order`` (default: the
        largest values win). With a version column, given when the table is
        created, a row never replaces one with a newer version."""
        layout = self.layout() or self.create(batch.schema, keys, version_column)
        if tuple(keys) != layout.keys or version_column != layout.version:
            raise ValueError(f"{self.path} was created with keys {list(layout.keys)} and version column "
                             f"{layout.version}, not {list(keys)} and {version_column}")
        rows, layout = self.reconciled(batch, layout, evolve)
        rest = [c for c in layout.schema.names if c not in layout.keys]
        if order is None:
            first = [layout.version] if layout.version else []
            order = [F.col(c).desc_nulls_last() for c in first + [c for c in rest if c not in first]]
        rows = latest_per_key(rows, layout.keys, order or [F.lit(1)])
        if layout.version and self.state() != State(0, None, ()):
            rows = self._not_older(rows, layout)
        target = self.directory_for(re.sub(r"[^A-Za-z0-9.-]", "-", origin or uuid.uuid4().hex))
        if target is None:
            return
        rows.write.mode("overwrite").parquet(target)
        if self.due():
            self.compact()

    def directory_for(self, origin: str) -> str | None:
        """Where an upsert of this origin goes; None if it is part of the base."""
        tries = [(n, p) for n, o, p in self._all_changes() if o == origin]
        committed = {n for n, p in tries if storage.committed(self.spark, p)}
        state = self.state()
        if origin in state.folded or any(n <= state.base_seq for n in committed):
            return None
        if committed:
            n = max(committed)
            return f"{self.path}/changes/{SEQ}={n}/{ORIGIN}={origin}~{sum(m == n for m, _ in tries)}"
        target = f"{self.path}/changes/{SEQ}={self._next_seq()}/{ORIGIN}={origin}"
        for _, torn in tries:
            storage.remove(self.spark, torn)
        return target

    def due(self, share: float = COMPACT_SHARE, most: int = MOST_CHANGES) -> bool:
        """Whether the changes have grown enough to be folded. The first change of
        a table serves as its base until then."""
        state = self.state()
        paths = [p for _, p in state.changes]
        base, later = (state.base, paths) if state.base else (paths[:1][0] if paths else None, paths[1:])
        if not later:
            return False
        return len(later) >= most or sum(storage.size(self.spark, p) for p in later) > share * storage.size(self.spark, base)

    def compact(self) -> None:
        """Fold the changes into a new base; the old one is live until it is
        complete. Files get Spark's advisory partition size, whatever the table's."""
        state = self.state()
        if state.changes:
            self._write_base(self.spark.sql(self.query(state)), state.base_seq, state.changes[-1][0])

    def replace(self, rows: DataFrame, order: Sequence[Column]) -> None:
        """New content for the whole table (recovery by recomputation)."""
        layout = self._existing()
        rows, layout = self.reconciled(rows, layout, False)
        self._write_base(latest_per_key(rows, layout.keys, order), self.state().base_seq, self._next_seq())

    def _write_base(self, rows: DataFrame, before: int, seq: int) -> None:
        """A new base: what it folds is noted before its marker makes it live."""
        state, target = self.state(), f"{self.path}/base={seq}"
        size = sum(storage.size(self.spark, p) for p in [*([state.base] if state.base else []), *[p for _, p in state.changes]])
        buckets = min(_cuts(size, self.bucket_bytes), max(MOST_BUCKETS, _cuts(size, BUCKET_BYTES)))
        folded = state.folded | {o for n, (o, _) in self._committed_changes().items() if n <= seq}
        storage.write_text(self.spark, f"{self.path}/_bases/{seq}.json",
                           json.dumps({"buckets": buckets, "origins": sorted(folded)}))
        if buckets == 1:
            rows.hint("rebalance").write.mode("overwrite").parquet(target)
        else:
            cut = rows.withColumn(BUCKET, F.expr(_bucket(self._existing().keys, buckets)))
            cut.repartitionById(buckets, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(target)
        # What the base before this one had replaced is out of every reader's sight.
        for n in storage.numbered(self.spark, self.path, "base"):
            if n < before:
                storage.remove(self.spark, f"{self.path}/base={n}")
                storage.remove(self.spark, f"{self.path}/_bases/{n}.json")
        for n, _, path in self._all_changes():
            if n <= before:
                storage.remove(self.spark, path.rpartition("/")[0])


def upsert(batch: DataFrame, path: str, keys: Sequence[str], **options) -> None:
    """``KeyedTable.upsert`` on the table at ``path``."""
    KeyedTable(batch.sparkSession, path).upsert(batch, keys, **options)
