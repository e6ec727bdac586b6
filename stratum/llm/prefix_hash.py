"""Document fingerprints from prefix polynomial hashes.

The prefix array S[i] = sum of c[j] * B^j for j < i, modulo the prime 2^31 - 1,
under two bases, compares any two spans in constant time: spans at i and j of
length n are equal (but for chance of about 2^-62) when
(S[i+n] - S[i]) * B^j = (S[j+n] - S[j]) * B^i. The longest common extension of
two positions follows by binary search over n.

A fingerprint keeps the prefix array at places that the content chooses: where
the hash of the ``WINDOW`` code points before a place is a multiple of ``EVERY``,
and at the end. So it grows with the text, and an edit moves no places but those
next to it. The spans between neighbouring places of one fingerprint are looked up
in the other, and runs of spans are extended by binary search over the kept array;
the share of the longer text that the common spans cover is the likeness. Each
span is used once. An edit costs the spans that it touches, of about ``EVERY``
code points each, wherever it is.

Defined results: null text is the empty text; equal texts have equal
fingerprints and likeness 1; two empty texts are equal. Documents follow each
other by ascending key, null keys first, rows of one key by the MD5 of their text;
a lone row follows itself. Other columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import arrow_schema, field, on_workers, record_batch

PRIME = (1 << 31) - 1
BASES = (1_000_003, 777_767_777)
#: Code points whose hash chooses a place, and the mean distance of places.
WINDOW, EVERY = 8, 32
#: Rows of one range of keys; a range is read by one task as a stream.
RANGE_ROWS = 4_096
#: Pairs a task compares before it hands a batch on.
OUT_ROWS = 256


def _mod(x: np.ndarray) -> np.ndarray:
    """Modulo the Mersenne prime, for values below 2^62."""
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
    return np.where(x == PRIME, np.uint64(0), x)


class Powers:
    """Powers of each base and of its inverse, grown by doubling as longer texts come."""

    def __init__(self):
        steps = [*BASES, *[pow(base, PRIME - 2, PRIME) for base in BASES]]
        self.steps, self.tables = steps, [np.ones(1, np.uint64) for _ in steps]

    def upto(self, n: int) -> list[np.ndarray]:
        """The powers 0 to n - 1 (at least): of the bases, then of their inverses."""
        for k, step in enumerate(self.steps):
            while len(self.tables[k]) < n:
                have = self.tables[k]
                self.tables[k] = np.concatenate([have, _mod(have * np.uint64(pow(step, len(have), PRIME)))])
        return self.tables


class Sums:
    """A prefix array, or some places of one: ``at`` are the places (ascending,
    from 0 to the end), ``sums`` the array's values there under each base. Indices
    count places; the whole array has every place."""

    def __init__(self, at: np.ndarray, sums: list[np.ndarray], powers: Powers):
        self.at, self.sums, self.n, self.powers = at, sums, len(at) - 1, powers

    def span(self, i: int, j: int, shift: int) -> tuple[int, ...]:
        """Hash of the text between places i and j, moved on by ``shift`` code points."""
        powers = self.powers.upto(shift + 1)
        return tuple((int(s[j]) - int(s[i])) % PRIME * int(p[shift]) % PRIME for s, p in zip(self.sums, powers))

    def equal(self, i: int, other: "Sums", j: int, n: int) -> bool:
        """Whether n places on from i here and from j there the texts are equal."""
        here, there = int(self.at[i]), int(other.at[j])
        return (self.at[i + n] - here == other.at[j + n] - there
                and self.span(i, i + n, there) == other.span(j, j + n, here))

    def extension(self, i: int, other: "Sums", j: int, most: int | None = None) -> int:
        """Length of the longest common extension (at most ``most``) of place i
        here and j there."""
        low, high = 0, min(self.n - i, other.n - j) if most is None else most
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.equal(i, other, j, middle) else (low, middle - 1)
        return low

    def spans(self) -> list[int]:
        """Of the span after each place but the last: both hashes, as if it were at
        the start, in one number."""
        starts, whole = self.at[:-1], np.zeros(self.n, np.uint64)
        inverse = self.powers.upto(int(self.at[-1]) + 1)[len(BASES):]
        for k, (s, inv) in enumerate(zip(self.sums, inverse)):
            moved = _mod(s[1:] + np.uint64(PRIME) - s[:-1])
            whole |= _mod(moved * inv[starts]) << np.uint64(31 * k)
        return whole.tolist()


class PrefixHashes(Sums):
    """Prefix arrays of one text (code points)."""

    def __init__(self, text: str, powers: Powers):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        sums = []
        for power in powers.upto(len(points) + 1)[:len(BASES)]:
            terms = _mod(points * power[:len(points)])
            sums.append(np.concatenate([np.zeros(1, np.uint64), _mod(np.cumsum(terms))]))
        super().__init__(np.arange(len(points) + 1), sums, powers)

    def places(self) -> np.ndarray:
        """0, the places that the content chooses, and the end. A window at i has the
        hash v * B^i; v is a multiple of EVERY where it follows the window's text alone."""
        s = self.sums[0]
        moved = _mod(s[WINDOW:] + np.uint64(PRIME) - s[:-WINDOW]) if self.n >= WINDOW else s[:0]
        values = _mod(moved * self.powers.upto(len(moved))[len(BASES)][:len(moved)])
        chosen = np.flatnonzero(values % np.uint64(EVERY) == 0) + WINDOW
        return np.unique(np.concatenate([[0], chosen, [self.n]]))

    def kept(self) -> Sums:
        """The array at its places."""
        at = self.places()
        return Sums(at, [s[at] for s in self.sums], self.powers)


def fingerprint(kept: Sums) -> str:
    """The places but the first, each with the array's values, as base64 of
    little-endian 32-bit numbers."""
    rows = np.stack([kept.at.astype(np.uint64), *kept.sums], 1)[1:]
    return base64.b64encode((rows if kept.at[-1] else rows[:0]).astype("<u4").tobytes()).decode()


def read_fingerprint(text: str, powers: Powers) -> Sums:
    rows = np.frombuffer(base64.b64decode(text), "<u4").reshape(-1, 1 + len(BASES)).astype(np.uint64)
    rows = np.concatenate([np.zeros((1, rows.shape[1]), np.uint64), rows])
    return Sums(rows[:, 0].astype(np.int64), [rows[:, 1 + k] for k in range(len(BASES))], powers)


def likeness(one: Sums, two: Sums) -> float:
    """Of two texts' kept arrays, as their fingerprints have them: the share of the
    longer text that their common spans cover, each span of either used once."""
    longer = int(max(one.at[-1], two.at[-1]))
    if not longer:
        return 1.0
    ours, theirs = one.spans(), two.spans()
    common = set(ours).intersection(theirs)
    if not common:
        return 0.0
    where: dict[int, list[int]] = {}
    for j in range(two.n - 1, -1, -1):
        if theirs[j] in common:
            where.setdefault(theirs[j], []).append(j)         # the first unused one is the last of its list
    free = bytearray(b"\1" * two.n + b"\0")
    i = covered = 0
    while i < one.n:
        unused = where.get(ours[i], ())
        while unused and not free[unused[-1]]:
            unused.pop()
        if not unused:
            i += 1
            continue
        j = unused.pop()
        run = max(1, one.extension(i, two, j, min(one.n - i, free.index(0, j) - j)))
        covered += int(one.at[i + run] - one.at[i])
        free[j:j + run] = bytes(run)
        i += run
    return covered / longer


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of the next."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _place(key, tie: str) -> tuple:
    """A row's place in the order: null keys first."""
    return (0, tie) if key is None else (1, key, tie)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per document: fingerprints of its text and of its edited text,
    and the likenesses to the edited and to the next document.

    Keys and digests of the texts alone are range-partitioned first; the least of
    every range are the only thing the driver sees (one per ``range_rows`` rows, at
    most four times the shuffle partitions); rows without a key, or with one key,
    are many ranges. Texts then move once, to the range of their
    key; the first row of a range is also sent to the range before it, so every
    task has the successor of its last row and reads its range as a stream.
    """
    spark, key = docs.sparkSession, field(docs, id_col)
    on_workers(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.md5(text).alias("tie"))
    order = [F.col("id").asc_nulls_first(), F.col("tie").asc()]
    parts = max(1, min(-(-rows.count() // range_rows), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    least = F.min(F.struct(F.col("id").isNotNull().alias("keyed"), "id", "tie")).alias("first")
    firsts = sorted(_place(r.first.id, r.first.tie) for r in rows.select("id", "tie").repartitionByRange(parts, *order)
                    .groupBy(F.spark_partition_id()).agg(least).collect())
    parts = max(1, len(firsts))
    bounds = firsts[1:]                    # range k holds bounds[k-1] <= row < bounds[k]
    heads = {first: k for k, first in enumerate(bounds)}
    if firsts:
        heads[firsts[0]] = parts - 1       # the last row is followed by the first
    sent = spark.sparkContext.broadcast((bounds, heads))

    ddl = f"part int, tail boolean, id {key}, text string, tie string"
    schema = arrow_schema(ddl)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, before = sent.value
        for batch in batches:
            places = [_place(i, tie) for i, tie in zip(batch.column("id").to_pylist(), batch.column("tie").to_pylist())]
            part = [bisect.bisect_right(edges, p) for p in places]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([False] * len(part)),
                                              *batch.columns], schema=schema)
            at = [k for k, p in enumerate(places) if p in before]
            if at:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([before[places[k]] for k in at], pa.int32()), pa.array([True] * len(at)),
                     *batch.take(pa.array(at)).columns], schema=schema)

    ordered = (rows.mapInArrow(place, ddl).repartitionById(parts, F.col("part"))
               .sortWithinPartitions("part", "tail", *order).drop("tie"))

    out_ddl = (f"id {key}, n_chars bigint, edited_sha256 string, fingerprint string, "
               "edited_fingerprint string, near_edited double, near_next double")
    out_schema = arrow_schema(out_ddl)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, out, held = Powers(), [], None
        for batch in batches:
            for part, tail, i, text in zip(*[c.to_pylist() for c in batch.columns]):
                mark = None if tail and not (held and held[0] == part) else PrefixHashes(text, powers).kept()
                if held and held[0] == part:
                    _, of, old, kept = held
                    changed = edited(old, text)
                    new = PrefixHashes(changed, powers).kept()
                    out.append((of, len(old), hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(),
                                fingerprint(kept), fingerprint(new), likeness(kept, new), likeness(kept, mark)))
                    if len(out) >= OUT_ROWS:
                        yield record_batch(dict(zip(out_schema.names, map(list, zip(*out)))), out_schema)
                        out = []
                held = None if tail else (part, i, text, mark)
        if out:
            yield record_batch(dict(zip(out_schema.names, map(list, zip(*out)))), out_schema)

    return ordered.mapInArrow(compare, out_ddl)


__all__ = ["PrefixHashes", "Powers", "Sums", "compare_with_next", "edited", "fingerprint", "likeness", "read_fingerprint"]
