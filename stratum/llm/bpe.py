"""Byte-level BPE encoding and decoding with overlapping chunks.

Pre-tokenisation is memoryless: a match of the pattern depends only on the text
from its start on (it looks ahead, never back). So two runs that both have a
pre-token boundary at one position agree from there on. A long text is cut into
chunks that overlap; every chunk is pre-tokenised on its own, in any task; the
stitch keeps a chunk's boundaries up to the first one it shares with the next
chunk inside their overlap and goes on with the next chunk's. Where they do not
meet inside the overlap, the stretch is pre-tokenised again from the last sure
boundary. The pieces between boundaries are then merged by rank.

Defined results: null text encodes like the empty text (no ids); every text is
processed whole; repeated rows give repeated results; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import field, map_batches

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
#: A task's memory of pieces already merged is emptied at this size.
CACHE_PIECES = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: adjacent parts with the lowest rank merge first, the
    leftmost of equals before the others, until no adjacent pair is a token."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    return _merge_short(piece, ranks) if len(piece) <= 64 else _merge_long(piece, ranks)


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts = [piece[i:i + 1] for i in range(len(piece))]
    none = len(ranks) + 1
    costs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while costs:
        best = min(costs)
        if best == none:
            break
        i = costs.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del costs[i]
        if i < len(costs):
            costs[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            costs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same order of merges with a heap over a linked list: n log n."""
    n = len(piece)
    end = list(range(1, n + 1))           # end[i]: where the part starting at i ends; 0: merged away
    before = list(range(-1, n))
    heap: list[tuple[int, int, int]] = []

    def push(i: int) -> None:
        j = end[i]
        if j < n:
            rank = ranks.get(piece[i:end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n - 1):
        push(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue                       # one of the two parts has changed since
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class Codec:
    """Encodes and decodes whole texts; keeps the pieces it has merged."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.known: dict[str, bytes] = {}

    def boundaries(self, text: str) -> list[int]:
        """Ends of the pre-tokens of ``text``."""
        return [m.end() for m in self.pattern.finditer(text)]

    def encode_pieces(self, pieces: Sequence[str]) -> bytes:
        """Ids of the pieces as little-endian unsigned 32-bit integers."""
        known, out = self.known, []
        if len(known) > CACHE_PIECES:
            known.clear()
        for piece in pieces:
            ids = known.get(piece)
            if ids is None:
                ids = np.array(merge_piece(piece.encode("utf-8", "replace"), self.ranks),
                               "<u4").tobytes()
                known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        return self.encode_pieces(self.pattern.findall(text))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def stitch(chunks: Sequence[tuple[int, str, Sequence[int]]], codec: Codec) -> list[int]:
    """Boundaries of the whole text from ``(start, chunk text, ends inside the
    chunk)`` in order; chunks overlap or at least touch."""
    sure: list[int] = []                   # ends of true pre-tokens so far
    start, text, ends = chunks[0]
    at: list[int] | None = [start + e for e in ends]
    for next_start, next_text, next_ends in chunks[1:]:
        theirs = [next_start + e for e in next_ends]
        # The last two pre-tokens of a chunk may end otherwise in the whole text.
        trusted = at[:-2] if at else []
        mine = {e for e in trusted if e >= next_start}
        meet = next((e for e in theirs if e in mine), None)
        if meet is None and next_start in trusted:
            meet = next_start
        if meet is None:
            # No shared boundary: go on from the last sure one through the next chunk.
            last = trusted[-1] if trusted else start
            text = text[last - start:] + next_text[start + len(text) - next_start:]
            sure += trusted
            start = last
            # Inside one long run there is nothing to find yet: wait for its end.
            at = [last + e for e in codec.boundaries(text)] if len(next_ends) > 2 else None
            continue
        sure += [e for e in trusted if e <= meet]
        start, text, at = next_start, next_text, [e for e in theirs if e > meet]
        text, start = text[meet - start:], meet
    return sure + ([start + e for e in codec.boundaries(text)] if at is None else at)


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str,
                     id_col: str = "doc_id", text_col: str = "text",
                     chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """One row per document: the id column, ``ids`` (binary, little-endian
    unsigned 32-bit) and ``decoded`` (binary, from the ids alone).

    Texts up to ``chunk_chars`` are one chunk and never move. Longer ones are
    spread as overlapping chunks, pre-tokenised wherever they land, and met
    again by row to be stitched and encoded: a group is one document. The
    vocabulary is broadcast; its size is that of the file.
    """
    if not 0 < overlap < chunk_chars:
        raise ValueError("the overlap must be positive and shorter than a chunk")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((ranks, pattern))
    id_ddl = field(docs, id_col)
    rows = docs.select(F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    result = f"id {id_ddl}, ids binary, decoded binary"

    def whole():
        codec = Codec(*shared.value)

        def step(batch: pa.RecordBatch) -> dict:
            ids = [codec.encode(t) for t in batch["text"].to_pylist()]
            return {"id": batch["id"], "ids": ids, "decoded": [codec.decode(x) for x in ids]}
        return step

    short = map_batches(rows.where(F.length("text") <= chunk_chars), whole, result)

    long = (rows.where(F.length("text") > chunk_chars)
            .withColumn("row", F.monotonically_increasing_id())
            .withColumn("start", F.explode(F.sequence(
                F.lit(0), F.length("text") - 1, F.lit(chunk_chars - overlap))))
            .select("id", "row", "start",
                    F.substring("text", F.col("start") + 1, F.lit(chunk_chars)).alias("text"))
            .repartition("row", "start"))

    def pre_tokenise():
        codec = Codec(*shared.value)

        def step(batch: pa.RecordBatch) -> dict:
            ends = [np.array(codec.boundaries(t), "<u4").tobytes() for t in batch["text"].to_pylist()]
            return {**{c: batch[c] for c in ("id", "row", "start", "text")}, "ends": ends}
        return step

    cut = map_batches(long, pre_tokenise,
                      f"id {id_ddl}, row bigint, start int, text string, ends binary")

    made: dict[str, Codec] = {}

    def join(group: pa.Table) -> pa.Table:
        codec = made.setdefault("codec", made.get("codec") or Codec(*shared.value))
        group = group.sort_by("start")
        starts, texts = group["start"].to_pylist(), group["text"].to_pylist()
        ends = [np.frombuffer(e, "<u4").tolist() for e in group["ends"].to_pylist()]
        text = "".join(t[:b - a] for a, b, t in zip(starts, starts[1:], texts)) + texts[-1]
        cuts = stitch(list(zip(starts, texts, ends)), codec)
        ids = codec.encode_pieces([text[a:b] for a, b in zip([0, *cuts], cuts)])
        return pa.table({"id": group["id"].slice(0, 1), "ids": pa.array([ids], pa.binary()),
                         "decoded": pa.array([codec.decode(ids)], pa.binary())})

    return short.unionAll(cut.groupBy("row").applyInArrow(join, result))


def digests(encoded: DataFrame) -> DataFrame:
    """Counts and digests of ``encode_documents``' result."""
    return encoded.select("id", F.expr("cast(octet_length(ids) / 4 as bigint)").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


__all__ = ["Codec", "digests", "encode_documents", "merge_piece", "read_ranks", "stitch"]
