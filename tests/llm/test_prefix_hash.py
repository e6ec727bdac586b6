import difflib
import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.llm import prefix_hash as P

POWERS = P.Powers()


def hashes(text):
    return P.PrefixHashes(text, POWERS)


@settings(max_examples=150, deadline=None)
@given(st.text("ab", max_size=40), st.text("ab", max_size=40), st.data())
def test_spans_and_extensions(a, b, data):
    x, y = hashes(a), hashes(b)
    i, j = data.draw(st.integers(0, len(a))), data.draw(st.integers(0, len(b)))
    n = data.draw(st.integers(0, min(len(a) - i, len(b) - j)))
    assert x.equal(i, y, j, n) == (a[i:i + n] == b[j:j + n])
    most = 0
    while i + most < len(a) and j + most < len(b) and a[i + most] == b[j + most]:
        most += 1
    assert x.extension(i, y, j) == most


def like(a, b):
    return P.likeness(*[P.read_fingerprint(mark(t), POWERS) for t in (a, b)])


def mark(text):
    return P.fingerprint(hashes(text).kept())


def chosen(text):
    """The spans between the places that the content chooses, from the text itself."""
    value = lambda w: sum((ord(c) + 1) * pow(P.BASES[0], k, P.PRIME) for k, c in enumerate(w)) % P.PRIME
    cuts = [i for i in range(P.WINDOW, len(text)) if value(text[i - P.WINDOW:i]) % P.EVERY == 0]
    return [text[i:j] for i, j in zip([0, *cuts], [*cuts, len(text)]) if j > i]


def brute_like(a, b):
    """The share of the longer text that the common spans cover."""
    if a == b:
        return 1.0
    common = Counter(chosen(a)) & Counter(chosen(b))
    return sum(len(s) * n for s, n in common.items()) / max(len(a), len(b))


@settings(max_examples=150, deadline=None)
@given(st.text("ab\U0001F600", max_size=300), st.text("ab", max_size=300), st.integers(0, 300))
def test_likeness(a, b, cut):
    assert like(a, b) == brute_like(a, b) == like(b, a)
    assert like(a, a[:cut] + b) == brute_like(a, a[:cut] + b)
    assert like(a + b, b + a) == brute_like(a + b, b + a)


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(words))


def shared(a, b):
    """Characters in matching blocks, of the longer text's: a plain measure on the texts."""
    return sum(m.size for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()) / max(len(a), len(b))


@pytest.mark.parametrize("edits", [1, 2, 5, 12])
def test_near_copies_score_their_shared_share(edits):
    """Characters changed, put in and taken out anywhere, the first and the last among them."""
    rng = random.Random(edits)
    for _ in range(4):
        text = prose(rng, 400)
        places = {0, len(text) - 1, *(rng.randrange(len(text)) for _ in range(edits - 2))} if edits > 1 else {rng.randrange(len(text))}
        copy = text
        for k, at in enumerate(sorted(places, reverse=True)):
            copy = copy[:at] + ("", "#", "##")[k % 3] + copy[at + 1:]
        got, want = like(text, copy), shared(text, copy)
        assert got <= want + 1e-12
        assert got >= want - len(places) * 6 * P.EVERY / len(text)
        assert like(text, prose(rng, 400)) < 0.05


def test_both_ends_of_a_long_text():
    rng = random.Random(1)
    text = prose(rng, 2_000)[:10_000]
    assert like(text, "#" + text[1:-1] + "#") > 0.95
    header, footer = prose(rng, 100), prose(rng, 100)
    assert like(text, header + text + footer) > 0.95 * len(text) / (len(text) + len(header + footer))
    halves = text[5_000:] + text[:5_000]                       # moved blocks are common too
    assert like(text, halves) > 0.95


def test_fingerprints_grow_with_the_text():
    rng = random.Random(2)
    for words in (50, 500, 5_000):
        text = prose(rng, words)
        places = P.read_fingerprint(mark(text), POWERS)
        assert 0.5 < places.n * P.EVERY / len(text) < 2
        i, j = places.n // 3, places.n // 2
        assert places.equal(i, hashes_at(text[int(places.at[i]):], places, i), 0, j - i)


def hashes_at(rest, places, i):
    """The kept places from i on, of a text of its own."""
    whole = hashes(rest)
    at = places.at[i:] - places.at[i]
    return P.Sums(at, [s[at] for s in whole.sums], POWERS)


def brute(rows):
    """By sorting all rows: nulls first, then key, rows of one key by the MD5 of the text."""
    rows = sorted(((i, t or "") for i, t in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()))
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        e = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), mark(t),
                    mark(e), like(t, e), like(t, after)))
    return sorted(out, key=str)


def run(docs, **kw):
    return sorted((tuple(r) for r in P.compare_with_next(docs, **kw).collect()), key=str)


def test_table(documents, texts):
    want = brute(texts.items())
    assert run(documents, range_rows=64) == want
    assert run(documents) == want
    near = [r[5] for r in want if r[1] > 500]
    assert sum(near) / len(near) > 0.4 and sum(r[6] for r in want) / len(want) < 0.1


def test_gaps_ties_and_order(spark):
    rng = random.Random(4)
    rows = [(rng.choice([-5, 3, 900, 10**12, 7]) if k % 3 else 100 * k, f"text {k} " * (k % 9)) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    assert run(docs, range_rows=16) == brute(rows)


def test_rows_without_a_key_are_many_ranges(spark):
    rows = [(None if k % 2 else 5, f"text {k} " * (k % 5)) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert run(docs, range_rows=16) == brute(rows)
    parts = P.compare_with_next(docs, range_rows=32).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 8 and max(r["count"] for r in parts) < 160


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert run(odd_docs) == brute(rows)
    assert run(odd_docs, range_rows=3) == brute(rows)
    nulls = odd_docs.where("doc_id is null")
    assert run(nulls) == brute([(r.doc_id, r.text) for r in nulls.collect()])
    assert run(no_docs) == []
    one = run(odd_docs.where("doc_id = 0"))
    assert len(one) == 1 and one[0][6] == 1.0
