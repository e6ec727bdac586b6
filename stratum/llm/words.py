"""ASCII-folded words of UTF-8 texts, and item tables taken in bounded blocks.

A word is a maximal run of bytes that are ASCII digits, ASCII letters (A-Z
lower-cased) or above 0x7F, so of ASCII alphanumerics and all other code points
from U+0080 on. Folding keeps every byte's place: the offsets of a folded text
are those of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_FOLD = bytes(b if b in _KEPT else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))

#: Bytes of a text whose words are held as objects at a time.
PIECE = 1 << 20


def fold(text: bytes | None) -> bytes:
    """The text with separators as blanks; null is the empty text."""
    return (text or b"").translate(_FOLD)


def word_pieces(folded: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """All words in order, in lists from about ``piece`` bytes each."""
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + piece)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def word_bounds(folded: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of every word: starts, and ends (exclusive)."""
    inside = np.frombuffer(folded, np.uint8) != 0x20
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    return edge[::2], edge[1::2]


def item_blocks(items: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[list]:
    """The distinct (id, text) rows as lists of about ``limit`` bytes of text at
    most, dealt by hash (one list always holds a whole item); none if empty."""
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).distinct()
    size, count = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    blocks = min(count, 1 + size // limit)
    part = F.pmod(F.xxhash64(F.col("id").cast("string"), "text"), F.lit(blocks or 1))
    for k in range(blocks):
        block = rows.where(part == k).collect() if blocks > 1 else rows.collect()
        if block:
            yield sorted(block, key=lambda r: (str(r.id), r.text or ""))
