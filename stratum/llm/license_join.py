"""License scan as an exact set-similarity join of text blocks and templates.

A template is a license notice, a block any run of as many words of a document
as the notice has (the whole text, if it is shorter); line breaks and comment
marks separate words and do not count. A block matches a template if it contains
at least ``THRESHOLD`` of the template's distinct words. The join is exact:
template words are put in one global order, rarest first, by the number of
documents that hold them; a text with a block that meets the threshold must share
one of the template's first ``size - required + 1`` words (prefix filter), have
at least ``required`` words (length filter), and from a shared word on both must
have enough words left (positional filter). In surviving texts every block that
holds one of these prefix words is counted in full; others cannot match.

Blocks that match are united where they overlap and belong to one template. Notices
of one family differ by a word or two, so of matches that overlap by half of the
shorter one that with the greater containment, then the longer, then the first by
label is reported.

Defined results: null text is the empty text (no words, no labels, score 0);
every text is read whole; a document may have many labels; repeated rows give
repeated results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter, defaultdict
from collections.abc import Mapping
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import arrow_schema, field, map_batches, on_workers, record_batch

# Phrases of the base rule and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

THRESHOLD = 0.9

#: Licence notices and bodies by label; several may share one.
TEMPLATES = (
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero "
             "general public license as published by the free software foundation"),
    ("apache", "licensed under the apache license version 2.0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
               "on an as is basis without warranties or conditions of any kind either express or implied"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
              "accompanying documentation covered by this license the software to use reproduce display distribute execute and "
              "transmit the software and to prepare derivative works of the software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following "
            "disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
            "following disclaimer in the documentation and or other materials provided with the distribution"),
    ("cc-by", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("cc-by", "licensed under cc by 4.0"),
    ("cc-by-nc", "licensed under cc by nc 4.0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4.0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4.0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4.0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or "
            "her rights to the work worldwide under copyright law including all related and neighboring rights to the extent "
            "allowed by law"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("gpl", "this work is licensed under the gnu general public license version"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
            "provided that the above copyright notice and this permission notice appear in all copies"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
             "public license"),
    ("lgpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
             "public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the software without restriction including without limitation the rights to use copy modify merge publish distribute "
            "sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2.0"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
                  "compile sell or distribute this software either in source code form or as a compiled binary for any purpose "
                  "commercial or non commercial and by any means"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter "
             "it and redistribute it freely"),
)

# ASCII letters in lower case, digits and every byte above 127 stay; all else separates.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 10 if b == 10 else 32
              for b in range(256))
_PHRASE_WORDS = tuple((label, tuple(phrase.encode().split())) for phrase, label in PHRASES.items())
_PHRASE_HINT = re.compile(b"|".join(b"[ \n]+".join(map(re.escape, words)) for _, words in _PHRASE_WORDS))


def fold(text: str) -> bytes:
    """Lower-cased words of the text, each separator a space, lines kept."""
    return text.encode("utf-8", "replace").translate(_FOLD)


class Base(NamedTuple):
    n_words: int
    starts: list[int]
    labels: set[str]


def base_matches(folded: bytes) -> Base:
    """Places, by word number, where a phrase's words stand consecutively."""
    words = folded.split()
    if not _PHRASE_HINT.search(folded):
        return Base(len(words), [], set())
    starts, labels = [], set()
    for label, phrase in _PHRASE_WORDS:
        n, at = len(phrase), -1
        while True:
            try:
                at = words.index(phrase[0], at + 1)
            except ValueError:
                break
            if tuple(words[at:at + n]) == phrase:
                starts.append(at)
                labels.add(label)
    return Base(len(words), starts, labels)


class Block(NamedTuple):
    label: str
    start: int              # words, from 0
    end: int                # exclusive
    containment: float


def _around(hits: list[int], reach: int) -> list[tuple[int, int]]:
    """Ascending places widened by ``reach`` to both sides, united where they meet."""
    out: list[tuple[int, int]] = []
    for i in hits:
        if out and out[-1][1] >= i - reach - 1:
            out[-1] = (out[-1][0], i + reach)
        else:
            out.append((max(0, i - reach), i + reach))
    return out


def reported(blocks: list[Block]) -> list[Block]:
    """The blocks without those that share half their words, or half of its, with a
    better one; by place."""
    out: list[Block] = []
    for b in sorted(blocks, key=lambda b: (-b.containment, b.start - b.end, b.label, b.start)):
        if not any(2 * (min(b.end, o.end) - max(b.start, o.start)) >= min(b.end - b.start, o.end - o.start) for o in out):
            out.append(b)
    return sorted(out, key=lambda b: (b.start, b.end, b.label))


class Matcher:
    """The templates in the global order, indexed by their prefix words."""

    def __init__(self, templates, frequency: Mapping[bytes, int], threshold: float):
        self.order = lambda w: (frequency.get(w, 0), w)
        self.templates, self.lengths, self.index = [], [], defaultdict(list)
        self.words: set[bytes] = set()
        for label, notice in templates:
            words = sorted(set(fold(notice).split()), key=self.order)
            required = math.ceil(threshold * len(words) - 1e-9)
            if not required:
                continue
            for place, word in enumerate(words[:len(words) - required + 1]):
                self.index[word].append((len(self.templates), place))
            self.templates.append((label, words, frozenset(words), required))
            self.lengths.append(len(fold(notice).split()))
            self.words.update(words)

    def _survivors(self, block: set[bytes]):
        """Number and shared words of the templates that the block contains."""
        if block.isdisjoint(self.index):
            return
        held = sorted(block & self.words, key=self.order)
        done = set()
        for place, word in enumerate(held):
            for number, at in self.index.get(word, ()):
                _, words, template, required = self.templates[number]
                if number in done or len(block) < required:
                    continue
                done.add(number)           # the first shared word decides: none before it is shared
                if 1 + min(len(words) - at - 1, len(held) - place - 1) < required:
                    continue
                shared = len(template & block)
                if shared >= required:
                    yield number, shared

    def match(self, block: set[bytes]) -> dict[str, float]:
        """Labels whose template the block contains, with the containment."""
        return self._best(self._survivors(block))

    def blocks(self, words: list[bytes]) -> list["Block"]:
        """All matching blocks of a text, those of one template that overlap united."""
        # The whole word set holds those of all blocks: a template that it does not contain is in none.
        numbers = {number for number, _ in self._survivors(set(words))}
        if not numbers:
            return []
        at = [(i, word) for i, word in enumerate(words) if word in self.words]
        prefix: dict[int, list[int]] = defaultdict(list)
        for i, word in at:
            for number, _ in self.index.get(word, ()):
                if number in numbers:
                    prefix[number].append(i)
        out = []
        for number, hits in prefix.items():
            _, _, template, required = self.templates[number]
            length = self.lengths[number]
            for low, high in _around(hits, length - 1):
                a, b = bisect.bisect_left(at, (low,)), bisect.bisect_left(at, (high + 1,))
                places = [x for x in at[a:b] if x[1] in template]
                if len(places) >= required:
                    out += self._windows(number, places)
        return out

    def _windows(self, number: int, places: list[tuple[int, bytes]]):
        """The matching blocks among these places of the template's words: first and
        last word (exclusive) of united blocks, with the most that one of them holds."""
        label, words, _, required = self.templates[number]
        held, kept, first, length = Counter(), 0, 0, self.lengths[number]
        found: list[Block] = []
        for i, word in places:
            held[word] += 1
            kept += held[word] == 1
            while places[first][0] <= i - length:
                gone = places[first][1]
                held[gone] -= 1
                kept -= held[gone] == 0
                first += 1
            if kept >= required:
                block = Block(label, places[first][0], i + 1, kept / len(words))
                if found and found[-1].end > block.start:
                    block = Block(label, found[-1].start, block.end, max(found.pop().containment, block.containment))
                found.append(block)
        return found

    def match_text(self, words: list[bytes]) -> dict[str, float]:
        """Labels with a matching block in the text, with the best containment."""
        out: dict[str, float] = {}
        for block in self.blocks(words):
            out[block.label] = max(out.get(block.label, 0.0), block.containment)
        return out

    def _best(self, found) -> dict[str, float]:
        out: dict[str, float] = {}
        for number, shared in found:
            label, words, _, required = self.templates[number]
            if shared >= required:
                out[label] = max(out.get(label, 0.0), shared / len(words))
        return out


def word_frequencies(docs: DataFrame, vocabulary: set[bytes], text_col: str) -> Counter:
    """Documents that hold each template word: one row per word
    and task is shuffled, one per template word reaches the driver."""
    on_workers(docs.sparkSession)
    schema = arrow_schema("word binary, n bigint")

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update(vocabulary.intersection(fold(text or "").split()))
        if held:
            yield record_batch({"word": list(held), "n": list(held.values())}, schema)

    counted = docs.select(text_col).mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n"))
    return Counter({bytes(w): n for w, n in counted.collect()})


def find_licenses(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the base measures and ``matches`` (label, places by
    word number and containment of each reported block). Two maps over all documents; the templates,
    given by the caller, are the small side and go to every task."""
    plain = Matcher(templates, {}, threshold)
    frequency = word_frequencies(docs, plain.words, text_col)
    ddl = (f"id {field(docs, id_col)}, n_words bigint, starts array<bigint>, phrases array<string>, "
           "matches array<struct<label:string,start:bigint,end:bigint,containment:double>>")

    def make():
        matcher = Matcher(templates, frequency, threshold)

        def step(batch: pa.RecordBatch) -> dict:
            out = {"id": batch["id"], "n_words": [], "starts": [], "phrases": [], "matches": []}
            for text in batch["text"].to_pylist():
                folded = fold(text or "")
                base, found = base_matches(folded), reported(matcher.blocks(folded.split()))
                out["n_words"].append(base.n_words)
                out["starts"].append(sorted(base.starts))
                out["phrases"].append(sorted(base.labels))
                out["matches"].append([b._asdict() for b in found])
            return out
        return step

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_batches(rows, make, ddl)


def digests(found: DataFrame) -> DataFrame:
    """``score``: 1 for a document with a base phrase, else its best containment."""
    method = F.transform("matches", lambda m: m["label"])
    best = F.array_max(F.transform("matches", lambda m: m["containment"]))
    return found.select(
        "id", "n_words", F.size("starts").cast("bigint").alias("n_base"),
        F.array_min("starts").alias("first_word"), F.array_max("starts").alias("last_word"),
        F.array_join("phrases", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("phrases", method))), ",").alias("labels"),
        F.when(F.size("starts") > 0, F.lit(1.0)).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"))


__all__ = ["Block", "Matcher", "TEMPLATES", "base_matches", "digests", "find_licenses", "fold", "reported"]
