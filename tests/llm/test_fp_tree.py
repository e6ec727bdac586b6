import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stratum.llm import fp_tree
from stratum.llm.words import fold, word_bounds, word_pieces

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))


def brute(docs, items, top=fp_tree.TOP):
    """(item id, rank, doc id, score) from the definition."""
    bags = [(i, Counter(words_of(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    total, size = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in set(items):
        scores = []
        for i, bag in bags:
            m = 100 - 25 + (25 * bag.total() * total) // size
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                        * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 12 * m)) for t in words_of(text) if t in bag)
            if score > 0:
                scores.append((-score, i is not None, i or 0, i))
        out += [(item, n, s[3], -s[0]) for n, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **options):
    df = fp_tree.search(spark.createDataFrame(docs, "doc_id bigint, text string"),
                        spark.createDataFrame(items, "item_id string, text string"), **options)
    assert df.columns == ["item_id", "rank", "id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


def made(n, seed=5):
    """Texts over a vocabulary of uneven frequency, with copies and near copies."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        if i % 3 == 2:
            out.append((i, out[-1][1] + (" Zulu" if i % 2 else "")))
        else:
            out.append((i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, int(rng.integers(1, 90))) if x < 400)))
    return out


@pytest.mark.parametrize("entries", [fp_tree.TREE_ENTRIES, 500])
def test_against_brute_force(spark, entries):
    docs = made(900)
    items = [(f"q{k}", " ".join(t for _, t in made(3, 100 + k))) for k in range(12)] + [("rare", "w399 w398 w1 w1"), ("none", "absent")]
    assert found(spark, docs, items, tree_entries=entries) == brute(docs, items)


def test_the_whole_table(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    got = fp_tree.search(documents, items)
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_ties_go_by_id_across_trees(spark):
    docs = [(i, "alpha beta") for i in reversed(range(500))] + [(1000, "gamma"), (None, "alpha beta"), (7, "alpha beta")]
    items = [("a", "alpha"), ("b", "BETA beta"), ("c", "gamma")]
    for entries in (64, fp_tree.TREE_ENTRIES):
        got = found(spark, docs, items, tree_entries=entries)
        assert got == brute(docs, items)
        assert [r[2] for r in sorted(got)[:4]] == [None, 0, 1, 2]


def test_items_in_blocks(spark):
    docs = made(200)
    items = [(f"q{k}", docs[k][1]) for k in range(0, 60, 4)]
    assert found(spark, docs, items, item_bytes=300) == brute(docs, items)


def test_odd_rows(spark, odd_docs):
    items = [("1", "the CAT sat"), ("1", "le chien"), ("2", None), (None, "word"), ("3", ""), ("1", "le chien"),
             ("é", "é \U0001F600 x"), ("4", "12345")]
    got = fp_tree.search(odd_docs, spark.createDataFrame([(*r, "x") for r in items], "item_id string, text string, id string"))
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_empty_tables(spark, no_docs, odd_docs):
    items = spark.createDataFrame([("1", "cat")], "item_id string, text string")
    assert fp_tree.search(no_docs, items).collect() == []
    assert fp_tree.search(odd_docs, items.limit(0)).collect() == []


def tree_of(docs, leaf):
    """A tree over the documents' words and the rank of each word."""
    bags = [Counter(words_of(t)) for _, t in docs]
    df = Counter(t for b in bags for t in b)
    rank = {t: k for k, t in enumerate(sorted(df, key=lambda t: (-df[t], t)))}
    sizes = [len(b) for b in bags]
    m = np.array([75 + b.total() for b in bags])
    flat = [(rank[t], n) for b in bags for t, n in b.items()]
    ptr = np.concatenate([[0], np.cumsum(sizes)])
    return fp_tree.Tree(pa.array([i for i, _ in docs]), m, ptr, np.array([r for r, _ in flat]),
                        np.array([n for _, n in flat]), leaf), rank, bags, m


def test_bounds_hold_and_prune():
    docs = [d for d in made(600) if words_of(d[1])]
    tree, rank, bags, m = tree_of(docs, 8)
    position = {i: k for k, (i, _) in enumerate(docs)}
    own = np.array([rank["w1"], rank["w7"], max(rank.values())])
    weights = np.array([10, 500, 2000])
    bounds = tree.bounds(own, weights)
    term = {r: t for t, r in rank.items()}
    scores = [sum(w * int(fp_tree.contribution(np.int64(bag[term[r]]), m[k])) for r, w in zip(own.tolist(), weights.tolist()))
              for k, bag in enumerate(bags)]
    for low, high, below, bound in zip(tree.low, tree.high, tree.children, bounds):
        assert max(scores[position[i]] for i in tree.ids[low:high]) <= bound
        if below:                                          # children divide their parent
            assert [tree.low[c] for c in below] == [low] + [tree.high[c] for c in below][:-1]
            assert tree.high[below[-1]] == high
    best: list = []
    dense = np.zeros(len(rank), np.int64)
    assert tree.search(own, weights, dense, best, 5) < len(docs) / 2 and not dense.any()
    assert [-s for s, _, _ in best] == sorted(scores, reverse=True)[:5]


def test_paths_are_shared():
    """A leaf's documents, but for neighbouring small subtrees, begin with the same terms."""
    docs = [(i, "a b c d e f " + w) for i, w in enumerate(["x", "y", "z"] * 40)] + [(900 + i, "a q") for i in range(40)]
    tree, *_ = tree_of(docs, 16)
    long_paths = [k for k, (a, b) in enumerate(zip(tree.low, tree.high)) if b - a == 120]
    assert len(long_paths) == 1 and len(tree.children[long_paths[0]]) == 3


def test_words():
    text = "Ab-c É9\x00ſİ_z" + " w" * 10
    assert [w.decode() for p in word_pieces(fold(text.encode()), 7) for w in p] == words_of(text)
    starts, ends = word_bounds(fold(text.encode()))
    assert [text.encode()[a:b].decode().lower() for a, b in zip(starts[:2], ends)] == ["ab", "c"]
    assert word_bounds(b"")[0].size == 0
