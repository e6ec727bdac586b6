import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from stratum.llm import divergence as D

WORD = re.compile("[^ \t\n\x0b\x0c\r]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(inside), failed)


def run(docs, **kw):
    return D.judge(docs, D.learn_references(docs), **kw).collect()


def test_base_measures_of_the_table(documents, texts):
    rows = run(documents)
    assert {r.id: tuple(r)[1:7] for r in rows} == {i: brute(t) for i, t in texts.items()}
    assert not any(r.kept and r.base_failed for r in rows)


def test_clean_documents_stay_and_junk_goes(documents, spark):
    rows = {r.id: r for r in run(documents)}
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    good = [rows[i].kept for i, q in labels.items() if q == 1 and i in rows and not rows[i].base_failed]
    assert np.mean(good) > 0.97
    junk = [rows[i].kept for i, q in labels.items() if q == 0 and i in rows]
    assert np.mean(junk) < 0.05


def test_references_count_everything(documents):
    """Common words and class counts against plain counting."""
    refs = D.learn_references(documents)
    counted, total = {}, Counter()
    for r in documents.collect():
        c = counted.setdefault(r.lang, Counter())
        words = [w.lower() for w in WORD.findall(r.text)]
        c.update(words)
        total[r.lang] += len(words)
    for lang, c in counted.items():
        want = {w: n for w, n in c.items() if n >= D.COMMON_SHARE * total[lang]}
        assert {w: int(refs.words[lang][i]) for w, i in refs.place[lang].items()} == want
        assert refs.words[lang].sum() == total[lang]
    assert sum(c.sum() for c in refs.classes.values()) == sum(len(r.text) for r in documents.collect())


def distance(p, q):
    a, b = sum(p.values()), sum(q.values())
    if not a or not b:
        return 0.0
    out = 0.0
    for k in set(p) | set(q):
        x, y = p.get(k, 0) / a, q.get(k, 0) / b
        out += sum(v / 2 * math.log2(2 * v / (x + y)) for v in (x, y) if v)
    return math.sqrt(max(0.0, out))


def class_of(c):
    if ord(c) >= 128:
        return "accented" if c.isalpha() and ord(c) < 0x3000 else "other"
    if c in "#*$%&|<>":
        return "symbol"
    if c in " \t\n\x0b\x0c\r":
        return "space"
    return ("lower" if c.islower() else "upper") if c.isalpha() else "digit" if c.isdigit() else \
        "punctuation" if c.isprintable() else "other"


def letters(histogram):
    return Counter({k: v for k, v in histogram.items() if k not in ("lower", "upper", "accented")}) + Counter(
        letter=sum(histogram[k] for k in ("lower", "upper", "accented")))


def brute_verdicts(rows):
    """(id, kept) from the definition, by plain counting."""
    words, classes, docs = {}, {}, Counter()
    for _, text, lang in rows:
        words.setdefault(lang, Counter()).update(w.lower() for w in WORD.findall(text or ""))
        classes.setdefault(lang, Counter()).update(map(class_of, text or ""))
        docs[lang] += 1
    everything, pooled = sum(w.total() for w in words.values()), letters(sum(classes.values(), Counter()))
    out = []
    for i, text, lang in rows:
        text = text or ""
        found = [w.lower() for w in WORD.findall(text)]
        total, histogram = words[lang].total(), Counter(map(class_of, text))
        of_word = 0.0
        if docs[lang] >= 10 and total and total >= 0.001 * everything:
            of_class = distance(histogram, classes[lang])
            common = {w: n for w, n in words[lang].items() if n >= 0.001 * total}
            own = Counter(w if w in common else "" for w in found)
            if common and found:
                of_word = distance(own, common | {"": total - sum(common.values())})
        else:
            of_class = distance(letters(histogram), pooled)
        strays = len(text) >= 200 and of_class > 0.30 or len(found) >= 50 and of_word > 0.50
        out.append((i, not brute(text)[5] and not strays))
    return sorted(out, key=str)


def test_verdicts_of_the_table(documents):
    rows = [(r.doc_id, r.text, r.lang) for r in documents.collect()]
    assert sorted(((r.id, r.kept) for r in run(documents)), key=str) == brute_verdicts(rows)


def test_languages_without_references(spark):
    """Junk under a language of its own does not pass as its own reference; rare languages stay."""
    rng, some = random.Random(3), [f"{a}{b}" for a in ("th", "qu", "br", "fo", "ju", "la") for b in ("e", "ick", "own", "x", "zy")]
    rows = [(k, ". ".join(" ".join(rng.choices(some, k=12)) for _ in range(12)), "en") for k in range(60)]
    rows += [(100 + k, "".join(f"{j}{k}#|<>%$ 48 9{j}15 *** &&& 77{k}1{j} " for j in range(30)), f"junk{k}") for k in range(5)]
    rows += [(200, "".join(f"слово{j} другой{j * j} текст, " for j in range(40)), "ru"), (300, None, "xx"), (301, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    refs = D.learn_references(docs)
    assert set(refs.classes) == {"en"}
    got = {r.id: r.kept for r in run(docs)}
    assert sorted(got.items(), key=str) == brute_verdicts(rows)
    assert got[200] and got[0] and not any(got[100 + k] for k in range(5))


@pytest.mark.parametrize("chunk", [1, 3_000])
def test_references_do_not_depend_on_chunks_or_batches(spark, documents, chunk):
    want = D.learn_references(documents)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(size)
    spark.conf.set(size, "5")
    try:
        got = D.learn_references(documents, chunk_bytes=chunk)
    finally:
        spark.conf.set(size, old)
    assert got.place == want.place and all((got.words[k] == want.words[k]).all() for k in want.words)
    assert (got.pooled == want.pooled).all() and all((got.classes[k] == want.classes[k]).all() for k in want.classes)


def test_words_that_reach_the_driver_are_bounded(spark, documents, monkeypatch):
    sent = []
    real = spark.sparkContext.broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, v: sent.append(v) or real(v))
    D.learn_references(documents.repartition(50), chunk_bytes=2_000)
    [candidates] = [v for v in sent if isinstance(v, dict)]
    assert 0 < max(map(len, candidates.values())) <= 2 / D.COMMON_SHARE


def test_js_distance():
    p, q = np.array([1.0, 0, 3]), np.array([0, 2.0, 2])
    a, b = p / 4, q / 4
    m = (a + b) / 2
    want = sum(x * math.log2(x / y) / 2 for v in (a, b) for x, y in zip(v, m) if x)
    assert D.js_distance(p, q) == pytest.approx(math.sqrt(want))
    assert D.js_distance(p, 5 * p) == pytest.approx(0, abs=1e-7)
    assert D.js_distance(np.array([1, 0]), np.array([0, 1])) == pytest.approx(1)
    assert D.js_distance(np.zeros(2), p[:2]) == 0


@pytest.mark.parametrize("text", ["a b c d e a b c d e", "a " * 30, "one two", "", "x y z w v u t s r q",
                                  "p q r s t u p q r s t v p q r s"])
def test_repeated_words(text):
    assert D.repeated_words(text.split()) == brute(text)[4]


def test_odd_rows(odd_docs, no_docs):
    got = sorted(((r.id, *tuple(r)[1:7]) for r in run(odd_docs)), key=str)
    assert got == sorted(((r.doc_id, *brute(r.text)) for r in odd_docs.collect()), key=str)
    assert run(no_docs) == []
    assert all(not r.kept for r in run(odd_docs) if r.n_words < 10)


def test_words_split_at_ascii_white_space_alone():
    for text in ("a\x1cb c", "a b c", "a b\u0085c", "x\x0by\x0cz"):
        assert D.words_of(text) == WORD.findall(text)
