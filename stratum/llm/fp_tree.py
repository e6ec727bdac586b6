"""Ranked lexical search over a document FP-tree.

Documents are restricted to the terms of the items, with term frequencies, and
their vectors are ordered by falling document frequency. Sorted, vectors with
equal beginnings lie together: they share paths of a trie. A task keeps a trie of
some hundred thousand entries at a time. Every subtree knows, for each of its
terms, the largest frequency in any of its documents, and the least m (the length
norm) and document place. As a score grows with a frequency and falls with m, the
score of these maxima at that minimum bounds all documents of the subtree.

Each item walks the trie depth first, the best bound first, and leaves out
subtrees whose bound falls short of its ``top`` best so far (or only ties it with
later ids); documents of the leaves that it reaches are scored exactly. What a
task found is cut to the best of each item again by a window.

Scores are 64-bit integers: a term weighs w = floor(1000 ln((2N+2) / (2df+1))),
m = 75 + (25 n N) div L, and a document has the sum over an item's terms, repeats
included, of w * ((10^9 tf) div (1000 tf + 12 m)).

The items' terms and weights are broadcast, for at most ``ITEM_BYTES`` of item
text; a larger table is taken in blocks of that size, each against all documents.

Defined results: null or wordless texts match nothing; repeated documents are
ranked each; equal scores go by ascending id, null first; repeated equal items
count once, items of one id with different texts are ranked each; empty tables
give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratum.llm.common import arrow_schema, field, map_batches, on_workers, record_batch, settle
from stratum.llm.words import fold, item_blocks, word_pieces

TOP = 20
#: Entries (term, frequency) of one trie, and documents under which a subtree is a leaf.
TREE_ENTRIES = 1 << 19
LEAF = 64
#: Text of the items whose terms and weights are broadcast at once.
ITEM_BYTES = 8 << 20


def term_counts(text: bytes | None) -> Counter:
    counts: Counter = Counter()
    for words in word_pieces(fold(text)):
        counts.update(words)
    return counts


def restricted(docs: DataFrame, terms: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tfs): every document's number of words, and the given terms
    in it with their frequencies."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def make():
        numbers = sent.value

        def step(batch: pa.RecordBatch) -> dict:
            n, found, tfs = [], [], []
            for text in batch.column("text").to_pylist():
                counts = term_counts(text)
                n.append(counts.total())
                held = counts.keys() & numbers.keys()
                found.append([numbers[t] for t in held])
                tfs.append([counts[t] for t in held])
            return {"id": batch.column("id"), "n": n, "terms": found, "tfs": tfs}

        return step

    return map_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")), make,
                       f"id {field(docs, id_col)}, n bigint, terms array<int>, tfs array<int>")


def contribution(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Tree:
    """A trie over the sorted vectors of some documents. Node 0 is the root; a
    node is a range of documents in trie order, with children or, as a leaf, none.

    ``ids`` are the documents' ids as an Arrow array, ``ptr`` the bounds of their
    entries (rank of a term, frequency), no document without entries."""

    def __init__(self, ids: pa.Array, m: np.ndarray, ptr: np.ndarray, rank: np.ndarray, tf: np.ndarray, leaf: int = LEAF):
        docs = len(m)
        by_id = pc.array_sort_indices(ids, null_placement="at_start").to_numpy() if docs else np.zeros(0, np.int64)
        place = np.empty(docs, np.int64)
        place[by_id] = np.arange(docs)
        owner = np.repeat(np.arange(docs), np.diff(ptr))
        inner = np.lexsort((rank, owner))                      # most frequent term first
        rank, tf = rank[inner], tf[inner]
        raw, cuts = rank.astype(">u4").tobytes(), (4 * ptr).tolist()
        keys = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        order = sorted(range(docs), key=lambda d: (keys[d], place[d]))
        self.keys = [keys[d] for d in order]
        order = np.array(order, np.int64)
        self.ids, self.place = ids.take(pa.array(order)).to_pylist(), place[order]
        sizes = np.diff(ptr)[order]
        self.ptr = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(ptr[:-1][order] - self.ptr[:-1], sizes) + np.arange(len(rank))
        self.rank, tf = rank[at], tf[at]
        self.worth = contribution(tf, np.repeat(m[order], sizes))
        self.id_of_place = dict(zip(self.place.tolist(), self.ids))
        self._split(docs, leaf)
        self._bound(tf, m[order])

    def _split(self, docs: int, leaf: int) -> None:
        """Ranges and children of all nodes, parents before children."""
        self.low, self.high, self.children = [], [], []

        def node(low: int, high: int) -> int:
            self.low.append(low)
            self.high.append(high)
            self.children.append([])
            return len(self.low) - 1

        todo = [node(0, docs)]
        while todo:
            k = todo.pop()
            low, high = self.low[k], self.high[k]
            if high - low <= leaf:
                continue
            first, last = self.keys[low], self.keys[high - 1]
            depth = _shared(first, last)
            if depth == len(last):                             # equal vectors
                self.children[k] = [node(a, min(a + leaf, high)) for a in range(low, high, leaf)]
                continue
            # Runs that go on with one term; those that end here come first.
            step = np.array([int.from_bytes(key[depth:depth + 4], "big") if len(key) > depth else -1
                             for key in self.keys[low:high]])
            edges = [low, *(np.flatnonzero(np.diff(step)) + low + 1).tolist(), high]
            start = low
            for a, b in zip(edges, edges[1:]):
                if b - a > leaf:
                    if a > start:
                        self.children[k].append(node(start, a))
                    self.children[k].append(node(a, b))
                    todo.append(self.children[k][-1])
                    start = b
                elif b - start > leaf:                         # small neighbours are one leaf
                    self.children[k].append(node(start, a))
                    start = a
            if start < high:
                self.children[k].append(node(start, high))

    def _bound(self, tf: np.ndarray, m: np.ndarray) -> None:
        """For each node the least m and place, and for each of its terms the
        largest frequency, as that term's contribution to the bound."""
        nodes = len(self.low)
        self.least = np.zeros(nodes, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = [None] * nodes
        norms = np.zeros(nodes, np.int64)
        for k in reversed(range(nodes)):
            below = self.children[k]
            if below:
                held[k] = _maxima(np.concatenate([held[c][0] for c in below]), np.concatenate([held[c][1] for c in below]))
                norms[k], self.least[k] = norms[below].min(), self.least[below].min()
            elif self.high[k] > self.low[k]:
                low, high = self.low[k], self.high[k]
                a, b = self.ptr[low], self.ptr[high]
                held[k] = _maxima(self.rank[a:b], tf[a:b])
                norms[k], self.least[k] = m[low:high].min(), self.place[low:high].min()
            else:
                held[k] = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        owner = np.repeat(np.arange(nodes), [len(h[0]) for h in held])
        rank = np.concatenate([h[0] for h in held])
        worth = contribution(np.concatenate([h[1] for h in held]), norms[owner])
        by_rank = np.argsort(rank, kind="stable")              # by term: an item reads only its own
        self.node_rank, self.node, self.node_worth = rank[by_rank], owner[by_rank], worth[by_rank]

    def bounds(self, ranks: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Per node, no document's score for the weighted terms is above this."""
        first = np.searchsorted(self.node_rank, ranks)
        counts = np.searchsorted(self.node_rank, ranks, "right") - first
        at = np.repeat(first - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        out = np.zeros(len(self.low), np.int64)
        np.add.at(out, self.node[at], np.repeat(weights, counts) * self.node_worth[at])
        return out

    def search(self, ranks: np.ndarray, weights: np.ndarray, dense: np.ndarray, best: list, top: int = TOP) -> int:
        """Puts the item's best documents into ``best``, a sorted list of
        (-score, id is not null, id) of at most ``top`` entries that may hold those
        of other trees; returns the number of documents scored. ``dense`` is zero
        for all ranks, and so again afterwards."""
        if not self.ids:
            return 0
        bounds, scored = self.bounds(ranks, weights), 0
        dense[ranks] = weights
        todo = [0]
        while todo:
            k = todo.pop()
            if bounds[k] <= 0 or len(best) == top and not self._may_enter(k, int(bounds[k]), best[-1]):
                continue
            if self.children[k]:
                todo.extend(sorted(self.children[k], key=bounds.__getitem__))
                continue
            low, high = self.low[k], self.high[k]
            a, b = self.ptr[low], self.ptr[high]
            scores = np.add.reduceat(dense[self.rank[a:b]] * self.worth[a:b], self.ptr[low:high] - a)
            scored += high - low
            floor = -best[-1][0] if len(best) == top else 1
            fit = np.flatnonzero(scores >= max(floor, 1))
            fit = fit[np.lexsort((self.place[low + fit], -scores[fit]))][:top]
            if len(fit):
                best.extend((-int(scores[d]), self.ids[low + d] is not None, self.ids[low + d]) for d in fit.tolist())
                best.sort(key=lambda x: x if x[1] else x[:2])
                del best[top:]
        dense[ranks] = 0
        return scored

    def _may_enter(self, k: int, bound: int, worst: tuple) -> bool:
        if bound != -worst[0]:
            return bound > -worst[0]
        first = self.id_of_place[int(self.least[k])]
        return worst[1] and (first is None or first < worst[2])


def _shared(a: bytes, b: bytes) -> int:
    """Bytes of whole ranks that two keys begin with alike."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = np.frombuffer(a[:n], np.uint8) != np.frombuffer(b[:n], np.uint8)
    return int(differ.argmax()) // 4 * 4


def _maxima(rank: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ranks, ascending, with their largest frequency."""
    order = np.argsort(rank, kind="stable")
    rank = rank[order]
    starts = np.flatnonzero(np.diff(rank, prepend=-1))
    return rank[starts], np.maximum.reduceat(tf[order], starts)


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", top: int = TOP,
           item_bytes: int = ITEM_BYTES, tree_entries: int = TREE_ENTRIES) -> DataFrame:
    """(item_id, rank, id, score): each item's ``top`` best documents."""
    out = [settle(_search_block(docs, block, items, id_col, text_col, item_col, top, tree_entries), "ranked")
           for block in item_blocks(items, item_col, item_text_col, item_bytes)]
    if not out:
        return docs.sparkSession.createDataFrame([], f"item_id {field(items, item_col)}, rank int, "
                                                     f"id {field(docs, id_col)}, score bigint")
    return reduce(DataFrame.unionByName, out)


def _search_block(docs: DataFrame, block: list, items: DataFrame, id_col: str, text_col: str, item_col: str,
                  top: int, tree_entries: int) -> DataFrame:
    spark = docs.sparkSession
    counts = [term_counts((r.text or "").encode()) for r in block]
    terms = {t: k for k, t in enumerate(sorted(set().union(*counts)))}
    vectors = settle(restricted(docs, terms, id_col, text_col), "vectors")
    n_docs, n_words = vectors.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(terms), np.int64)
    for number, held in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[number] = held
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df]
    order = sorted(range(len(terms)), key=lambda t: (-df[t], t))
    rank_of = np.full(len(terms), -1, np.int64)                # terms without weight add nothing
    ranked = [t for t in order if df[t] and weight[t]]
    rank_of[ranked] = np.arange(len(ranked))
    queries = []
    for held in counts:
        pairs = sorted((int(rank_of[terms[t]]), q * weight[terms[t]]) for t, q in held.items() if rank_of[terms[t]] >= 0)
        queries.append((np.array([r for r, _ in pairs], np.int64), np.array([w for _, w in pairs], np.int64)))
    sent = spark.sparkContext.broadcast((rank_of, queries, n_docs, n_words))
    on_workers(spark)
    ddl = f"item int, id {field(docs, id_col)}, score bigint"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, asked, of_docs, of_words = sent.value
        best: list[list] = [[] for _ in asked]
        dense = np.zeros(int(ranks.max(initial=-1)) + 1, np.int64)
        for part in _parts(batches, tree_entries):
            tree = _tree(part, ranks, of_docs, of_words)
            for (own, weights), found in zip(asked, best):
                if len(own):
                    tree.search(own, weights, dense, found, top)
        for k, found in enumerate(best):
            if found:
                yield record_batch({"item": [k] * len(found), "id": [i for _, _, i in found],
                                    "score": [-s for s, _, _ in found]}, schema)

    by_rank = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    found = (vectors.where(F.size("terms") > 0).mapInArrow(run, ddl)
             .withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= top))
    names = spark.createDataFrame([(k, r.id) for k, r in enumerate(block)], f"item int, item_id {field(items, item_col)}")
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "id", "score")


def _parts(batches: Iterator[pa.RecordBatch], entries: int) -> Iterator[pa.RecordBatch]:
    """The rows in tables of about so many entries (at least one row)."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy())
        start, done = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, done + entries - size, "right")))
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1]) - done
            start, done = stop, int(ends[stop - 1])
            if size >= entries or start < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _tree(part: pa.Table, rank_of: np.ndarray, n_docs: int, n_words: int) -> Tree:
    terms, tfs = (part.column(c).combine_chunks() for c in ("terms", "tfs"))
    ids = part.column("id").combine_chunks()
    ptr = terms.offsets.to_numpy().astype(np.int64)
    rank = rank_of[terms.values.to_numpy()[ptr[0]:ptr[-1]]]
    tf = tfs.values.to_numpy()[ptr[0]:ptr[-1]].astype(np.int64)
    owner, kept = np.repeat(np.arange(len(ids)), np.diff(ptr)), rank >= 0
    sizes = np.bincount(owner[kept], minlength=len(ids))
    some = np.flatnonzero(sizes)
    m = 75 + 25 * part.column("n").to_numpy().astype(np.int64) * n_docs // max(1, n_words)
    return Tree(ids.take(pa.array(some)), m[some], np.concatenate([[0], np.cumsum(sizes[some])]), rank[kept], tf[kept])


__all__ = ["Tree", "contribution", "restricted", "search", "term_counts"]
