import hashlib

import pytest

from stratum.llm import decontaminate
from stratum.llm.words import PIECE
from test_fp_tree import words_of


def brute(docs, items, window=decontaminate.WINDOW):
    """(doc id, words, hit words, item ids, contaminated) from the definition."""
    windows = {}
    for item, text in items:
        words = words_of(text)
        for at in range(max(1, len(words) - window + 1) if words else 0):
            windows.setdefault(tuple(words[at:at + window]), set()).add(item or "")
    out = []
    for i, text in docs:
        words, hit, found = words_of(text), set(), set()
        for size in {len(w) for w in windows}:
            for at in range(len(words) - size + 1):
                held = windows.get(tuple(words[at:at + size]))
                if held:
                    found |= held
                    hit |= set(range(at, at + size))
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(words), len(hit), len(found), ids, bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    return decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                    spark.createDataFrame(items, "item_id string, text string"), **options)


def digest(found):
    return sorted(map(tuple, decontaminate.digests(found).drop("spans").collect()), key=str)


TEN = "one two three four five six seven eight nine ten"
ITEMS = [("7", TEN + " eleven Twelve"), ("b", "short, ITEM"), ("10", "x " + TEN), ("é", "É! é"), ("n", None), ("e", " .. "), (None, "nil nil")]
DOCS = [(0, "start " + TEN.upper().replace(" ", "--") + " end"), (1, "short item short\nitem"), (2, "shorter item"),
        (3, TEN[:-3]), (4, None), (5, ""), (6, "é É"), (7, TEN + " eleven twelve " + TEN), (None, "nil nil nil"), (None, "nil nil nil")]


def test_against_definition(spark):
    assert digest(run(spark, DOCS, ITEMS)) == brute(DOCS, ITEMS)


def test_the_whole_table(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    got = digest(decontaminate.find_leaks(documents, items))
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [(str(r.item_id), r.text) for r in items.collect()])
    assert got == want and any(r[-1] for r in want)


@pytest.mark.parametrize("size", [1, 60])
def test_items_in_blocks(spark, size):
    """Each block has an automaton of its own; what they find is united."""
    whole, parts = run(spark, DOCS, ITEMS), run(spark, DOCS, ITEMS, item_bytes=size)
    assert sorted(whole.collect(), key=str) == sorted(parts.collect(), key=str)


def test_spans_map_to_the_text(spark):
    text = "\U0001F600 é… Short\tITEM; then é É ende"
    found = run(spark, [(1, text)], ITEMS).first()
    assert [text[s.start:s.end] for s in found.spans] == ["Short\tITEM"]     # É é, but not é É
    text = "\U0001F600 é… Short\tITEM; É  é ende"
    found = run(spark, [(1, text)], ITEMS).first()
    assert [text[s.start:s.end] for s in found.spans] == ["Short\tITEM; É  é"] and found.item_ids == ["b", "é"]


def test_windows_across_pieces():
    """A long text is scanned in pieces; occurrences over their borders are found once."""
    patterns = decontaminate.Patterns([("a", TEN.encode()), ("b", b"two three"), ("c", b"nine")])
    words = (["zz"] * (PIECE // 3 - 5) + TEN.split() + ["two", "three"]) * 3
    n, spans, windows = patterns.scan(" ".join(words).encode())
    size = len(words) // 3
    assert n == len(words) and len(windows) == 3
    assert spans == [((k + 1) * size - 12, (k + 1) * size) for k in range(3)]


def test_short_windows_inside_an_overlap():
    """Hits inside the words that two pieces share do not unite what lies between."""
    patterns = decontaminate.Patterns([("a", TEN.encode()), ("b", b"p q")])
    for shift in range(12):
        words = ["z"] * (PIECE // 2 - 9 + shift) + "p q z z p q z".split() + ["z"] * 20
        _, spans, _ = patterns.scan(" ".join(words).encode())
        assert [words[a:b] for a, b in spans] == [["p", "q"]] * 2


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([("1", "the cat sat on the mat and the dog ran away", 1), ("2", "le chat", 2)],
                                  "item_id string, text string, id int")
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert digest(decontaminate.find_leaks(odd_docs, items)) == brute(rows, [(r.item_id, r.text) for r in items.collect()])
    assert decontaminate.find_leaks(no_docs, items).collect() == []
    assert digest(decontaminate.find_leaks(odd_docs, items.limit(0))) == brute(rows, [])
