"""Benchmark decontamination with an Aho-Corasick automaton over words.

Every run of ``WINDOW`` consecutive words of an item (all of a shorter one) is a
pattern. One automaton holds the patterns of all items; a document's folded words
run through it once, and whatever it recognises is a run of hit words, mapped
back to code points of the original text and to the items that hold the pattern.

Items reach the tasks as a broadcast of at most ``ITEM_BYTES`` of text. A larger
table is taken in blocks of that size, hits carried along with the rows from
block to block through the shared folder, so no task holds more than one block.
Long texts go through in pieces that overlap by a window.

Defined results: null or wordless texts have no words and no hits; null or
wordless items have no patterns; items with the same id are one item, a null id
counts as the empty text; repeated documents give repeated rows; empty tables
give no rows, or no hits. Other columns are ignored.
"""

from __future__ import annotations

import uuid

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import field, map_batches, settle
from stratum.llm.words import fold, item_blocks, word_bounds, word_pieces

WINDOW = 10
#: Text of the items in one automaton; its patterns take about ten nodes a word.
ITEM_BYTES = 2 << 20


class Patterns:
    """The distinct windows of a block of items: word numbers from 1, each window
    as a tuple of them, and the ids of the items that hold it."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.key, self.numbers = uuid.uuid4().hex, {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for p in word_pieces(fold(text)) for w in p]
            for at in range(max(1, len(words) - window + 1) if words else 0):
                found.setdefault(tuple(words[at:at + window]), set()).add(item)
        self.windows = list(found)
        self.items = [sorted(ids) for ids in found.values()]
        self.longest = max(map(len, self.windows), default=0)

    def automaton(self) -> ahocorasick.Automaton:
        """Built once per Python worker and kept for its later tasks."""
        if self.key not in _BUILT:
            _BUILT.clear()
            made = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
            for n, window in enumerate(self.windows):
                made.add_word(window, n)
            made.make_automaton()
            _BUILT[self.key] = made
        return _BUILT[self.key]

    def scan(self, folded: bytes) -> tuple[int, list[tuple[int, int]], set[int]]:
        """Number of words, hits as disjoint word runs (start, end exclusive) in
        order, and the numbers of the windows that occur."""
        seen, before, spans, windows, number = 0, [], [], set(), self.numbers.get
        for words in word_pieces(folded):
            numbers = [number(w, 0) for w in words]
            if self.windows:
                base = seen - len(before)
                for end, n in self.automaton().iter(tuple(before + numbers)):
                    if end >= len(before):             # else known from the piece before
                        windows.add(n)
                        add_run(spans, base + end + 1 - len(self.windows[n]), base + end + 1)
                before = (before + numbers)[-(self.longest - 1):] if self.longest > 1 else []
            seen += len(words)
        return seen, spans, windows


_BUILT: dict[str, ahocorasick.Automaton] = {}


def add_run(runs: list[tuple[int, int]], start: int, end: int) -> None:
    """Unite a run with those that it meets; runs come by ascending end or start."""
    while runs and runs[-1][1] >= start:
        was = runs.pop()
        start, end = min(start, was[0]), max(end, was[1])
    runs.append((start, end))


def code_points(text: bytes, folded: bytes, runs: list[tuple[int, int]]) -> list[int]:
    """Starts and ends of word runs as code points of the text, flat."""
    starts, ends = word_bounds(folded)
    places = [int(x) for first, last in runs for x in (starts[first], ends[last - 1])]
    out, at, points = [], 0, 0
    for place in places:
        points += len(text[at:place].decode("utf-8", "replace"))
        out.append(points)
        at = place
    return out


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
               item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(id, n_words, n_hit, item_ids, spans): one row per document; ``spans``
    are its hit passages in code points (start, end exclusive)."""
    sc, key = docs.sparkSession.sparkContext, field(docs, id_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"),
                       F.lit(0).cast("bigint").alias("n_words"), F.array().cast("array<bigint>").alias("runs"),
                       F.array().cast("array<string>").alias("item_ids"))
    blocks = item_blocks(items, item_col, item_text_col, item_bytes)
    block = next(blocks, [])
    while True:
        following = next(blocks, None)
        patterns = Patterns([("" if r.id is None else str(r.id), (r.text or "").encode()) for r in block], window)
        sent = sc.broadcast(patterns)
        if following is None:
            break
        rows = settle(map_batches(rows, lambda sent=sent: lambda b: _scanned(b, sent.value),
                                  f"id {key}, text binary, n_words bigint, runs array<bigint>, item_ids array<string>"),
                      "leaks")
        sent.destroy()
        block = following

    return map_batches(rows, lambda: lambda b: _reported(b, sent.value),
                       f"id {key}, n_words bigint, n_hit bigint, item_ids array<string>, "
                       "spans array<struct<start:bigint,end:bigint>>")


def _scanned(batch: pa.RecordBatch, patterns: Patterns) -> dict:
    """The rows with this block's hits added to those of the blocks before."""
    texts = batch.column("text").to_pylist()
    totals, runs, ids = [], [], []
    for text, known, named in zip(texts, batch.column("runs").to_pylist(), batch.column("item_ids").to_pylist()):
        n, found, windows = patterns.scan(fold(text))
        merged: list[tuple[int, int]] = []
        for start, end in sorted(found + list(zip(known[::2], known[1::2]))):
            add_run(merged, start, end)
        totals.append(n)
        runs.append([x for run in merged for x in run])
        ids.append(sorted({*named, *[i for w in windows for i in patterns.items[w]]}))
    return {"id": batch.column("id"), "text": batch.column("text"), "n_words": totals, "runs": runs, "item_ids": ids}


def _reported(batch: pa.RecordBatch, patterns: Patterns) -> dict:
    found = _scanned(batch, patterns)
    hits, spans = [], []
    for text, flat in zip(batch.column("text").to_pylist(), found["runs"]):
        runs = list(zip(flat[::2], flat[1::2]))
        hits.append(sum(end - start for start, end in runs))
        places = code_points(text, fold(text), runs) if runs else []
        spans.append([{"start": a, "end": b} for a, b in zip(places[::2], places[1::2])])
    return {"id": found["id"], "n_words": found["n_words"], "n_hit": hits, "item_ids": found["item_ids"], "spans": spans}


def digests(found: DataFrame) -> DataFrame:
    """What ``find_leaks`` found, as counts and a digest of the sorted item ids."""
    return found.select("id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"), "spans")


__all__ = ["Patterns", "code_points", "digests", "find_leaks"]
