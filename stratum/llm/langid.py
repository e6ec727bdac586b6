"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by follow-the-regularised-leader with elastic-net
penalties, then calibrated by a temperature.

Features are letter n-grams of 1 to ``MAX_N`` code points (letters lower-cased,
every other run of characters is one space), hashed into ``BUCKETS``. Document
frequencies come from all training documents. The classifier is fitted on at
most ``fit_rows`` of them, spread evenly over the languages by a hash of the
key; one in five of these sets the temperature instead of the weights.

Defined results: a text that is null or has no letter gets ``und`` and score 0;
so does every text when no labelled training document exists. With one learned
language every other text gets it with score 1. Ties go to the first language in
sorted order. Repeated rows give repeated results; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import arrow_schema, field, map_batches, on_workers, record_batch, slices

BUCKETS = 1 << 15
MAX_N = 3
#: Documented bound of the labelled sample that the classifier is fitted on.
FIT_ROWS = 4_000
#: A label column with more values than this is refused: it holds no languages.
MOST_LABELS = 1_000
UNDETERMINED = "und"
#: Code points hashed at a time; a longer text is counted piece by piece.
PIECE = 1 << 18

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x100000001B3)


class Featuriser:
    """Counts of hashed letter n-grams of a text."""

    def __init__(self):
        self.letter = np.array([chr(i).isalpha() for i in range(0x110000)], bool)

    def counts(self, text: str | None) -> np.ndarray | None:
        """Counts by bucket, or None if the text has no letter."""
        if not text:
            return None
        total, carry = None, np.empty(0, np.uint64)
        for at in range(0, len(text), PIECE):
            points = np.frombuffer(text[at:at + PIECE].lower().encode("utf-32-le", "surrogatepass"), "<u4")
            letter = self.letter[points]
            if letter.any():
                points = np.where(letter, points, 32).astype(np.uint64)
                keep = np.ones(len(points), bool)
                keep[1:] = letter[1:] | letter[:-1]
                points = points[keep]
                total = np.zeros(BUCKETS, np.int64) if total is None else total
                # A piece goes on with the last letters of the one before it.
                self._add(np.concatenate([carry, points]) if len(carry) else points, len(carry), total)
                carry = points[-(MAX_N - 1):]
        return total

    @staticmethod
    def _add(points: np.ndarray, done: int, total: np.ndarray) -> None:
        hashed = points.copy()
        for n in range(1, MAX_N + 1):
            if n > 1:
                hashed = hashed[:-1] * _STEP + points[n - 1:]
            if not len(hashed):
                return
            mixed = (hashed + np.uint64(n)) * _ODD
            mixed ^= mixed >> np.uint64(29)
            mixed *= _ODD
            index = (mixed >> np.uint64(64 - 15)).astype(np.int64)
            fresh = index[max(0, done - n + 1):] if done else index
            total += np.bincount(fresh, minlength=BUCKETS)

    def weighted(self, counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and unit-length TF-IDF weights, with logarithmic counts."""
        at = np.flatnonzero(counts)
        value = (1.0 + np.log(counts[at])) * idf[at]
        return at, value / np.sqrt(value @ value)


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    idf: np.ndarray           # BUCKETS
    weights: np.ndarray       # BUCKETS x labels, sparse by the L1 penalty
    bias: np.ndarray
    temperature: float

    def predict(self, at: np.ndarray, value: np.ndarray) -> tuple[str, float]:
        p = softmax((value @ self.weights[at] + self.bias) / self.temperature)
        best = int(np.argmax(p))
        return self.labels[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(samples: list[tuple[np.ndarray, np.ndarray, int]], n_labels: int, *, alpha: float = 0.5,
             beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, epochs: int = 2,
             seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Per-coordinate FTRL-proximal with L1 and L2 penalties; the bias is the
    last row and is not penalised by L1."""
    z = np.zeros((BUCKETS + 1, n_labels))
    squares = np.zeros_like(z)
    penalty = np.full((BUCKETS + 1, 1), l1)
    penalty[BUCKETS] = 0.0

    def leader(rows: np.ndarray) -> np.ndarray:
        zr = z[rows]
        shrunk = np.sign(zr) * np.maximum(np.abs(zr) - penalty[rows], 0.0)
        return -shrunk / ((beta + np.sqrt(squares[rows])) / alpha + l2)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(samples)):
            at, value, label = samples[i]
            rows, x = np.append(at, BUCKETS), np.append(value, 1.0)
            w = leader(rows)
            miss = softmax(x @ w)
            miss[label] -= 1.0
            gradient = x[:, None] * miss
            before = squares[rows]
            after = before + gradient * gradient
            z[rows] += gradient - (np.sqrt(after) - np.sqrt(before)) / alpha * w
            squares[rows] = after
    all_rows = leader(np.arange(BUCKETS + 1))
    return all_rows[:BUCKETS], all_rows[BUCKETS]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least negative log likelihood (golden section)."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))
        return float(-np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-300)).mean())

    low, high, ratio = -4.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each bucket, over all rows of ``text``; and how many
    rows have a letter. One row per bucket and task is shuffled."""
    on_workers(texts.sparkSession)
    schema = arrow_schema("bucket int, n bigint")

    def run(batches):
        make, held, rows = Featuriser(), np.zeros(BUCKETS + 1, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts = make.counts(text)
                if counts is not None:
                    held[:BUCKETS] += counts > 0
                    rows += 1
        held[BUCKETS] = rows
        at = np.flatnonzero(held)
        if len(at):
            yield record_batch({"bucket": at.astype(np.int32), "n": held[at]}, schema)

    summed = texts.mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(BUCKETS + 1, np.int64)
    for bucket, n in summed.collect():     # at most BUCKETS + 1 rows
        total[bucket] = n
    return total[:BUCKETS], int(total[BUCKETS])


def train(labelled: DataFrame, key: Column, text_col: str = "text", label_col: str = "lang",
          fit_rows: int = FIT_ROWS) -> Model | None:
    """A model from rows with a label (null labels are left out); None if there
    are none. ``key`` orders the fitting sample (its hash) and nothing else."""
    rows = labelled.where(F.col(label_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label"),
        F.xxhash64(key).alias("draw"))
    sizes = {r[0]: r[1] for r in rows.groupBy("label").count().orderBy("label").limit(MOST_LABELS + 1).collect()}
    if len(sizes) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} values in {label_col}: not a language column")
    if not sizes:
        return None
    labels = tuple(sorted(sizes))
    held, n = document_frequencies(rows.select("text"))
    idf = np.log((1.0 + n) / (1.0 + held)) + 1.0

    # An even share of each language: keep the rows whose hash is in that share.
    share = -(-fit_rows // len(labels))
    odds = F.create_map(*[F.lit(x) for kv in ((k, min(1.0, 1.1 * share / v)) for k, v in sizes.items())
                          for x in kv])
    unit = F.pmod(F.xxhash64("draw"), F.lit(1 << 40)) / float(1 << 40)
    sample = (rows.where(unit < odds[F.col("label")]).orderBy("draw", "label").limit(fit_rows))

    def make():
        featuriser = Featuriser()

        def step(batch: pa.RecordBatch) -> dict:
            at, value = [], []
            for text in batch["text"].to_pylist():
                counts = featuriser.counts(text)
                i, v = (np.empty(0, np.int64), np.empty(0)) if counts is None else featuriser.weighted(counts, idf)
                at.append(i.astype("<u2").tobytes())
                value.append(v.astype("<f4").tobytes())
            return {"label": batch["label"], "draw": batch["draw"], "at": at, "value": value}
        return step

    drawn = [(np.frombuffer(r.at, "<u2").astype(np.int64), np.frombuffer(r.value, "<f4").astype(float),
              labels.index(r.label), r.draw)
             for r in map_batches(sample, make, "label string, draw bigint, at binary, value binary").collect()]
    drawn = [s for s in drawn if len(s[0])]
    fitted = [s[:3] for s in drawn if s[3] % 5] or [s[:3] for s in drawn]
    weights, bias = fit_ftrl(fitted, len(labels))
    kept = [s for s in drawn if not s[3] % 5]
    logits = np.array([value @ weights[at] + bias for at, value, _, _ in kept]).reshape(-1, len(labels))
    return Model(labels, idf, weights.astype(np.float32), bias,
                 fit_temperature(logits, np.array([s[2] for s in kept], int)))


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``id``, ``lang_pred``, ``score`` of every row. A map over rows; the model
    (BUCKETS x languages) is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        featuriser, fitted = Featuriser(), shared.value

        def step(batch: pa.RecordBatch) -> dict:
            out = [predict_text(fitted, featuriser, t) for t in batch["text"].to_pylist()]
            return {"id": batch["id"], "lang_pred": [x[0] for x in out], "score": [x[1] for x in out]}
        return step

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_batches(rows, make, f"id {field(docs, id_col)}, lang_pred string, score double")


def predict_text(model: Model | None, featuriser: Featuriser, text: str | None) -> tuple[str, float]:
    counts = featuriser.counts(text) if model else None
    return (UNDETERMINED, 0.0) if counts is None else model.predict(*featuriser.weighted(counts, model.idf))


def keep_identified(docs: DataFrame, model: Model | None, text_col: str = "text",
                    least_score: float = 0.3) -> DataFrame:
    """The documents whose language could be determined with a calibrated
    probability of at least ``least_score``; without a model (no training row has
    a label) those that have a letter. Columns and order within a task stay."""
    on_workers(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        featuriser, fitted = Featuriser(), shared.value
        for batch in (part for whole in batches for part in slices(whole)):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            if fitted is None:
                keep = [featuriser.counts(t) is not None for t in texts]
            else:
                found = [predict_text(fitted, featuriser, t) for t in texts]
                keep = [lang != UNDETERMINED and score >= least_score for lang, score in found]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
