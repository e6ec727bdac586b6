"""Quality rules by distribution divergence.

Every document's histograms of character classes and of its language's common
words are compared with the references of that language by Jensen-Shannon
distance (the square root of the divergence, base 2: 0 to 1). The references
are learned from all documents of the table. A distance counts only from a
least length on, since short texts stray by chance.

A language has references of its own if it has ``LEAST_DOCUMENTS`` documents and
the share ``OWN_SHARE`` of all words (so there are at most 1 / OWN_SHARE of them,
whatever the column holds). Documents of others are compared with all documents
together, by character classes alone and with all letters as one class: a
language of a few documents would be its own reference.

Common words are those that make up at least ``COMMON_SHARE`` of a language's
words. They are found exactly without shuffling a vocabulary. Tasks count words
in chunks of text and hand on those that reach half that share in a chunk; what a
word has in all other chunks is less than half the share of these. The words that
can reach the share by this bound have at least half of it already, so there are at
most 2 / COMMON_SHARE of them a language; a second pass counts only these.

Defined results: null text has no words and fails the base rule; a null language
is a language like others; where no document has a word nothing is compared;
an empty table gives no rows. Repeated rows give repeated results; other columns
are ignored; texts are read whole.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import arrow_schema, field, map_batches, on_workers, record_batch, settle

# Fixed values of the base rule.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, WINDOW, MOST_REPEATED_PERCENT = 10, 5, 20
SPACES = " \t\n\x0b\x0c\r"

COMMON_SHARE = 0.001
#: A language with fewer documents, or less of all words, has no references of its own.
LEAST_DOCUMENTS, OWN_SHARE = 10, 0.001
#: Text whose words a task counts before it hands on the common ones.
CHUNK_BYTES = 16 << 20
CLASSES = ("lower", "upper", "digit", "space", "symbol", "punctuation", "accented", "other")
#: Least code points and words from which a distance counts.
LEAST_CHARS, LEAST_COMMON_WORDS = 200, 50
#: Largest distances of a document that is kept.
MOST_CLASS_DISTANCE, MOST_WORD_DISTANCE = 0.30, 0.50

_WORD = re.compile(f"[^{SPACES}]+")
_NULL_LANG = "\x00"
#: Classes with all letters as one, for documents of languages without references.
_LETTERS = [CLASSES.index(c) for c in ("lower", "upper", "accented")]


def merged(counts: np.ndarray) -> np.ndarray:
    return np.append(np.delete(counts, _LETTERS), counts[_LETTERS].sum())


def class_table() -> np.ndarray:
    """The class number of every code point."""
    out = np.full(0x110000, CLASSES.index("other"), np.uint8)
    for i in range(0x3000):
        c = chr(i)
        if i >= 128:
            out[i] = CLASSES.index("accented") if c.isalpha() else out[i]
        elif c in SYMBOLS:
            out[i] = CLASSES.index("symbol")
        elif c in SPACES:
            out[i] = CLASSES.index("space")
        elif c.isalpha():
            out[i] = CLASSES.index("lower" if c.islower() else "upper")
        elif c.isdigit():
            out[i] = CLASSES.index("digit")
        elif c.isprintable():
            out[i] = CLASSES.index("punctuation")
    return out


def class_counts(text: str, classes: np.ndarray) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.bincount(classes[points], minlength=len(CLASSES))


def words_of(text: str) -> list[str]:
    """Maximal runs of code points other than ASCII white space."""
    # str.split() would also split at other white space.
    return text.split() if text.isascii() and not _ODD_SPACE.search(text) else _WORD.findall(text)


_ODD_SPACE = re.compile("[\x1c-\x1f]")


def base_measures(text: str, words: list[str]) -> dict[str, int]:
    lines, seen, repeated_lines = text.split("\n"), set(), 0
    for line in lines:
        if line.strip(SPACES):
            repeated_lines += line in seen
            seen.add(line)
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": sum(map(text.count, SYMBOLS)),
            "n_dup_lines": repeated_lines, "n_repeat_words": repeated_words(words)}


def repeated_words(words: list[str]) -> int:
    """Words inside windows of WINDOW words that occur twice or more."""
    if len(words) <= WINDOW:
        return 0
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    n, window = len(number), ids[:len(ids) - WINDOW + 1]
    for i in range(1, WINDOW):
        # Pairs get dense numbers again, so products never overflow.
        window = np.unique(window * n + ids[i:len(ids) - WINDOW + 1 + i], return_inverse=True)[1]
    starts = np.flatnonzero(np.bincount(window)[window] > 1)
    if not len(starts):
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def base_failed(m: dict[str, int]) -> bool:
    return m["n_words"] < LEAST_WORDS or 100 * m["n_repeat_words"] > MOST_REPEATED_PERCENT * m["n_words"]


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Of two histograms of counts; 0 if either is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(x > 0, x * np.log2(x / m), 0.0).sum() for x in (p, q)]
    return float(np.sqrt(max(0.0, sum(parts) / 2)))


class References:
    """Character-class counts of all documents, and per language with references
    those and the counts of the common words, the count of all others in the last
    place."""

    def __init__(self, pooled: np.ndarray, classes: dict[str, np.ndarray], words: dict[str, dict[str, int]],
                 totals: dict[str, int]):
        self.pooled, self.classes, self.place, self.words = merged(pooled), classes, {}, {}
        for lang, total in totals.items():
            common = words.get(lang, {})
            self.place[lang] = {w: i for i, w in enumerate(sorted(common))}
            counts = [common[w] for w in sorted(common)]
            self.words[lang] = np.array([*counts, total - sum(counts)], float)

    def distances(self, lang: str, counts: np.ndarray, words: list[str]) -> tuple[float, float]:
        if lang not in self.classes:
            return js_distance(merged(counts), self.pooled), 0.0
        of_class = js_distance(counts, self.classes[lang])
        place = self.place[lang]
        if not place or not words:
            return of_class, 0.0
        found = Counter(filter(place.__contains__, map(str.lower, words)))
        own = np.zeros(len(place) + 1)
        for w, n in found.items():
            own[place[w]] = n
        own[-1] = len(words) - own.sum()
        return of_class, js_distance(own, self.words[lang])


def learn_references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                     chunk_bytes: int = CHUNK_BYTES) -> References:
    """Two passes over all documents. What reaches the driver is bounded by the
    shares: the counts of languages with references, and their candidate words."""
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit(_NULL_LANG)).alias("lang"))
    on_workers(docs.sparkSession)
    ddl = "lang string, kind int, word string, n bigint, seen bigint"
    schema = arrow_schema(ddl)

    def emit(rows: list[tuple[str, int, str, int, int]]) -> pa.RecordBatch:
        return record_batch(dict(zip(schema.names, map(list, zip(*rows)))), schema)

    def survey(batches):
        """A chunk's counts by language: characters by class (kind 0 and up), words
        (-1), documents (-3), and words that are common in the chunk (-2, ``seen``
        being all words)."""
        classes = class_table()
        chars, counted, texts, size = defaultdict(lambda: np.zeros(len(CLASSES), np.int64)), defaultdict(Counter), Counter(), 0

        def chunk() -> list[tuple[str, int, str, int, int]]:
            out = []
            for lang, counts in chars.items():
                total = counted[lang].total()
                out += [(lang, k, "", int(n), 0) for k, n in enumerate(counts)]
                out += [(lang, -1, "", total, 0), (lang, -3, "", texts[lang], 0)]
                out += [(lang, -2, w, n, total) for w, n in counted[lang].items() if n >= COMMON_SHARE / 2 * total]
            chars.clear(), counted.clear(), texts.clear()
            return out

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                chars[lang] += class_counts(text, classes)
                counted[lang].update(map(str.lower, words_of(text)))
                texts[lang] += 1
                size += len(text)
                if size >= chunk_bytes:
                    yield emit(chunk())
                    size = 0
        if texts:
            yield emit(chunk())

    first = settle(rows.mapInArrow(survey, ddl).groupBy("lang", "kind", "word")
                   .agg(F.sum("n").alias("n"), F.sum("seen").alias("seen")), "survey")
    pooled = np.zeros(len(CLASSES))
    for kind, n in first.where("kind >= 0").groupBy("kind").agg(F.sum("n")).collect():
        pooled[kind] = n
    words = first.where("kind = -1").select("lang", F.col("n").alias("total"))
    everything = words.agg(F.sum("total")).first()[0] or 0
    large = first.where((F.col("kind") == -3) & (F.col("n") >= LEAST_DOCUMENTS)).select("lang")
    totals = {r.lang: r.total for r in words.where((F.col("total") > 0) & (F.col("total") >= OWN_SHARE * everything))
              .join(large, "lang").collect()}
    own = docs.sparkSession.createDataFrame(list(totals.items()), "lang string, total bigint")
    classes: dict[str, np.ndarray] = {}
    for lang, kind, n in first.where("kind >= 0").join(F.broadcast(own), "lang").select("lang", "kind", "n").collect():
        classes.setdefault(lang, np.zeros(len(CLASSES)))[kind] = n
    most = F.col("n") + COMMON_SHARE / 2 * (F.col("total") - F.col("seen"))
    candidates: dict[str, set[str]] = defaultdict(set)
    for lang, word in (first.where("kind = -2").join(F.broadcast(own), "lang")
                       .where(most >= COMMON_SHARE * (1 - 1e-9) * F.col("total")).select("lang", "word").collect()):
        candidates[lang].add(word)
    shared = docs.sparkSession.sparkContext.broadcast(dict(candidates))

    def count(batches):
        known, out = shared.value, defaultdict(Counter)
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang in known:
                    out[lang].update(filter(known[lang].__contains__, map(str.lower, words_of(text))))
        if out:
            yield emit([(lang, -2, w, n, 0) for lang, found in out.items() for w, n in found.items()])

    second = rows.mapInArrow(count, ddl).groupBy("lang", "word").agg(F.sum("n").alias("n")).collect() if candidates else []
    common: dict[str, dict[str, int]] = defaultdict(dict)
    for lang, word, n in second:
        if n >= COMMON_SHARE * totals[lang]:
            common[lang][word] = n
    return References(pooled, classes, common, totals)


def judge(docs: DataFrame, references: References, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", most_class: float = MOST_CLASS_DISTANCE,
          most_word: float = MOST_WORD_DISTANCE) -> DataFrame:
    """The base measures, both distances and the verdict of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(references)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    ddl = (f"id {field(docs, id_col)}, " + ", ".join(f"{n} bigint" for n in names)
           + ", base_failed boolean, kept boolean, class_distance double, word_distance double")

    def make():
        classes, refs = class_table(), shared.value

        def verdict(text: str, lang: str) -> tuple:
            words = words_of(text)
            m = base_measures(text, words)
            counts = class_counts(text, classes)
            of_class, of_word = refs.distances(lang, counts, words)
            failed = base_failed(m)
            strays = (len(text) >= LEAST_CHARS and of_class > most_class
                      or len(words) >= LEAST_COMMON_WORDS and of_word > most_word)
            return (*[m[n] for n in names], failed, not failed and not strays, of_class, of_word)

        def step(batch: pa.RecordBatch) -> dict:
            out = list(zip(*[verdict(t, lang) for t, lang in
                             zip(batch["text"].to_pylist(), batch["lang"].to_pylist())]))
            return {"id": batch["id"], **dict(zip((*names, "base_failed", "kept", "class_distance",
                                                   "word_distance"), map(list, out)))}
        return step

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit(_NULL_LANG)).alias("lang"))
    return map_batches(rows, make, ddl)
