import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.llm import langid, queries
from stratum.llm.common import residue


def test_held_out_accuracy(documents):
    model = queries.language_model(documents)
    held = documents.where(residue("doc_id", 5) == 0)
    got = {r.id: (r.lang_pred, r.score) for r in langid.identify(held, model).collect()}
    truth = {r.doc_id: r.lang for r in held.collect()}
    assert set(got) == set(truth)
    assert np.mean([got[i][0] == truth[i] for i in truth]) >= 0.98
    assert all(0 <= s <= 1 for _, s in got.values())
    assert 0 < (model.weights != 0).mean() < 0.9          # L1 leaves weights at zero
    assert 0.01 < model.temperature < 20


def test_prediction_uses_text_alone(documents):
    model = queries.language_model(documents)
    few = documents.limit(50).cache()
    other = few.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string"))
    key = lambda df: sorted(map(tuple, langid.identify(df, model).collect()))
    assert key(few) == key(other)


def test_labels_of_held_out_documents_teach_nothing(documents):
    changed = documents.withColumn("lang", F.when(residue("doc_id", 5) == 0, F.lit("zz")).otherwise(F.col("lang")))
    a, b = queries.language_model(documents), queries.language_model(changed)
    assert a.labels == b.labels and np.array_equal(a.weights, b.weights)


def test_long_text_in_pieces(monkeypatch):
    f = langid.Featuriser()
    text = "Le chat été, 12 der Hund " * 40
    whole = f.counts(text)
    monkeypatch.setattr(langid, "PIECE", 97)
    assert abs(f.counts(text) - whole).sum() <= 0.05 * whole.sum()


def test_odd_rows(odd_docs, no_docs):
    model = langid.train(odd_docs, F.col("doc_id"))
    rows = langid.identify(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.lang_pred in ("en", "fr", "und") for r in rows)
    und = {r.id for r in rows if r.lang_pred == "und"}
    assert {2, 3, 4, 5} <= und and {0, 1, 6, 7, 8}.isdisjoint(und)
    assert langid.train(no_docs, F.col("doc_id")) is None
    assert {r.lang_pred for r in langid.identify(odd_docs, None).collect()} == {"und"}
    assert langid.identify(no_docs, model).count() == 0
    kept = langid.keep_identified(odd_docs, model)
    assert kept.schema == odd_docs.schema and kept.where("doc_id in (2, 3, 4, 5)").count() == 0
    assert kept.where("doc_id in (0, 1)").count() == 3


def test_one_language(spark):
    docs = spark.createDataFrame([(1, "hello there", "en"), (2, "general", "en")], "doc_id bigint, text string, lang string")
    model = langid.train(docs, F.col("doc_id"))
    assert [(r.lang_pred, r.score) for r in langid.identify(docs, model).collect()] == [("en", 1.0)] * 2


def test_without_labels_documents_with_a_letter_stay(odd_docs):
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    model = langid.train(unlabelled, F.col("doc_id"))
    kept = [r.doc_id for r in langid.keep_identified(unlabelled, model).collect()]
    assert model is None and sorted(kept, key=str) == [0, 1, 1, 6, 7, 8, None]


# ------------------------------------------------ against plain definitions

MASK = (1 << 64) - 1
ODD, STEP = 0x9E3779B97F4A7C15, 0x100000001B3


def grams(text):
    """Letter n-grams of 1 to 3 code points: letters in lower case, every other run is one space."""
    out, gap = [], False
    for c in text.lower():
        if c.isalpha():
            out.append(c)
            gap = False
        elif not gap:
            out.append(" ")
            gap = True
    return [tuple(out[i:i + n]) for n in (1, 2, 3) for i in range(len(out) - n + 1)]


def bucket(gram):
    h = ord(gram[0])
    for c in gram[1:]:
        h = (h * STEP + ord(c)) & MASK
    m = (h + len(gram)) * ODD & MASK
    m = (m ^ m >> 29) * ODD & MASK
    return m >> (64 - 15)


@settings(max_examples=100, deadline=None)
@given(st.text("aBcé 1.-ßЖ\n", max_size=60))
def test_features_are_the_grams(text):
    got = langid.Featuriser().counts(text)
    if not any(c.isalpha() for c in text.lower()):
        assert got is None
        return
    want = Counter(map(bucket, grams(text)))
    assert {i: int(got[i]) for i in np.flatnonzero(got)} == dict(want)


def test_weights_are_unit_tf_idf(documents):
    some = documents.limit(60)
    held, n = langid.document_frequencies(some.select("text"))
    texts = [r.text for r in some.collect()]
    sets = [set(map(bucket, grams(t))) for t in texts if t and any(c.isalpha() for c in t)]
    df = Counter(b for s in sets for b in s)
    assert n == len(sets) and {i: int(held[i]) for i in np.flatnonzero(held)} == dict(df)
    idf = np.log((1.0 + n) / (1.0 + held)) + 1.0
    counts = Counter(map(bucket, grams(texts[0])))
    want = {b: (1 + math.log(c)) * (math.log((1 + n) / (1 + df[b])) + 1) for b, c in counts.items()}
    norm = math.sqrt(sum(v * v for v in want.values()))
    at, value = langid.Featuriser().weighted(langid.Featuriser().counts(texts[0]), idf)
    assert dict(zip(at.tolist(), value.tolist())) == pytest.approx({b: v / norm for b, v in want.items()})


def test_ftrl_coordinate_by_coordinate():
    """The proximal update, one coordinate and one label at a time."""
    rng = np.random.default_rng(3)
    samples = []
    for k in range(40):
        at = np.sort(rng.choice(12, 5, replace=False))
        samples.append((at, rng.random(5), int(at[0] % 3)))
    alpha, beta, l1, l2, epochs, seed = 0.5, 1.0, 0.6, 0.01, 3, 7
    z, q = {}, {}

    def weight(i, k):
        x = z.get((i, k), 0.0)
        free = 0.0 if i == "bias" else l1
        if abs(x) <= free:
            return 0.0
        return -(x - math.copysign(free, x)) / ((beta + math.sqrt(q.get((i, k), 0.0))) / alpha + l2)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for s in order.permutation(len(samples)):
            at, value, label = samples[s]
            x = [*zip(at.tolist(), value.tolist()), ("bias", 1.0)]
            w = {(i, k): weight(i, k) for i, _ in x for k in range(3)}
            logits = [sum(v * w[i, k] for i, v in x) for k in range(3)]
            e = [math.exp(v - max(logits)) for v in logits]
            for i, v in x:
                for k in range(3):
                    g = v * (e[k] / sum(e) - (k == label))
                    was = q.get((i, k), 0.0)
                    z[i, k] = z.get((i, k), 0.0) + g - (math.sqrt(was + g * g) - math.sqrt(was)) / alpha * w[i, k]
                    q[i, k] = was + g * g
    weights, bias = langid.fit_ftrl(samples, 3, alpha=alpha, beta=beta, l1=l1, l2=l2, epochs=epochs, seed=seed)
    assert weights[:12].ravel() == pytest.approx([weight(i, k) for i in range(12) for k in range(3)])
    assert bias == pytest.approx([weight("bias", k) for k in range(3)])
    assert not weights[12:].any() and (weights[:12] == 0).any()


def test_temperature_has_the_least_loss():
    rng = np.random.default_rng(4)
    labels = rng.integers(0, 4, 300)
    logits = rng.normal(size=(300, 4)) * 3
    logits[np.arange(300), labels] += 2.0

    def loss(t):
        p = langid.softmax(logits / t)
        return -np.log(p[np.arange(300), labels]).mean()

    found = langid.fit_temperature(logits, labels)
    grid = np.exp(np.linspace(-4, 3, 4000))
    assert found == pytest.approx(grid[np.argmin([loss(t) for t in grid])], rel=5e-3)
    assert langid.fit_temperature(logits[:0], labels[:0]) == 1.0
