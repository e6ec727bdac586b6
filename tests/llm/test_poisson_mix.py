import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratum.llm import poisson_mix as M


def unit(*parts):
    text = "|".join("" if p is None else str(p) for p in parts)
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / (1 << 52)


def draw(rate, *seed):
    if not rate:
        return 0
    parts = max(1, math.ceil(rate / M.LARGEST_RATE))
    count, r = 0, rate / parts
    for i in range(1, parts + 1):
        u, term, total, k = unit(*seed, i), math.exp(-r), math.exp(-r), 0
        while k < M.LARGEST_COUNT and total <= u:
            k += 1
            term *= r / k
            total += term
        count += k
    return count


def brute(docs, weights=None, temperature=0.5, size=1.0):
    rows = docs.collect()
    n = Counter(r.source for r in rows)
    w = {s: c ** temperature if weights is None else weights.get(s, 0.0) for s, c in n.items()}
    total = sum(w.values())
    rate = {s: size * w[s] / total * len(rows) / n[s] if total else 0.0 for s in n}
    seen, out = Counter(), []
    for r in rows:
        seen[tuple(r)] += 1
        row = hashlib.md5("|".join("" if c is None else str(c) for c in r).encode()).hexdigest()
        out += [(r.doc_id, r.source, k) for k in range(1, draw(rate[r.source], "mix", row, seen[tuple(r)]) + 1)]
    return sorted(out, key=str)


def run(docs, **kw):
    return sorted(((r.doc_id, r.source, r[M.COPY]) for r in M.replicate(docs, **kw).collect()), key=str)


@pytest.mark.parametrize("kw", [{}, {"temperature": 0.0}, {"weights": {"src0": 3.0, "src1": 1.0}}, {"size": 40.0}])
def test_counts(documents, kw):
    assert run(documents, **kw) == brute(documents, **kw)


def test_hits_the_target(spark):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"), F.lit("x").alias("text"))
    got = {r.source: r.n for r in M.replicate(docs, temperature=0.0).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert len(got) == 8
    assert all(abs(n - 5_000) < 5 * math.sqrt(5_000) * 1.6 for n in got.values())


@pytest.mark.parametrize("text, few", [("'same'", M.BROADCAST_SOURCES), ("concat('t', id)", M.BROADCAST_SOURCES),
                                       ("cast(NULL AS string)", 0)])
def test_rows_without_a_key_are_drawn_one_by_one(spark, monkeypatch, text, few):
    """A third of the rows has a null key, a sixth one key; with equal texts they are
    equal in every column. The sources still get their shares."""
    monkeypatch.setattr(M, "BROADCAST_SOURCES", few)
    ids = F.when(F.col("id") % 6 < 2, F.lit(None).cast("long")).when(F.col("id") % 6 == 2, F.lit(7)).otherwise(F.col("id"))
    docs = spark.range(12_000).select(ids.alias("doc_id"), F.expr(text).alias("text"),
                                      F.when(F.col("id") % 4 < 3, "a").otherwise("b").alias("source"))
    out = M.replicate(docs, weights={"a": 0.3, "b": 0.7}).collect()
    n, null = Counter(r.source for r in out), Counter(r.source for r in out if r.doc_id is None)
    for source, want in (("a", 3_600), ("b", 8_400)):
        assert abs(n[source] - want) < 5 * math.sqrt(want) and abs(null[source] - want / 3) < 5 * math.sqrt(want / 3)
    assert len({r[M.ORDER] for r in out}) == len(out)          # so any of them can be split
    assert run(docs, weights={"a": 0.3, "b": 0.7}) == brute(docs, weights={"a": 0.3, "b": 0.7})
    assert run(docs.repartition(13), weights={"a": 0.3, "b": 0.7}) == run(docs, weights={"a": 0.3, "b": 0.7})


def test_names_of_the_operator_in_the_input_stay(spark):
    docs = spark.createDataFrame([(k, f"t{k}", "a", -1.5, "o", None, 3, 4) for k in range(50)],
                                 "doc_id long, text string, source string, _mix_rate double, _MIX_order string, "
                                 "tie string, copies int, row int")
    out = M.replicate(docs, size=3.0)
    assert out.columns == [*docs.columns, M.COPIES, M.COPY]
    assert {tuple(r)[:8] for r in out.collect()} <= set(map(tuple, docs.collect())) and out.count() > 100


def test_the_distribution_is_looked_up_once(documents):
    plan = M.replicate(documents)._jdf.queryExecution().optimizedPlan().toString()
    drawn = [line for line in plan.splitlines() if "mix|" in line or "aggregate(cdf" in line]
    assert len(drawn) == 1 and "rangepartitioning" not in M.replicate(documents)._jdf.queryExecution().toString()


def test_many_sources_take_the_shuffle_join(documents, monkeypatch):
    want = run(documents)
    monkeypatch.setattr(M, "BROADCAST_SOURCES", 3)
    assert run(documents) == want


def test_same_result_over_any_partitions(documents):
    order = [(r.doc_id, r[M.COPY]) for r in M.replicate(documents).collect()]
    assert order == [(r.doc_id, r[M.COPY]) for r in M.replicate(documents.repartition(13)).collect()]
    assert order != sorted(order)


def test_no_python_in_the_plan(documents):
    plan = M.replicate(documents)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))


def test_odd_rows(odd_docs, no_docs):
    assert run(odd_docs) == brute(odd_docs)
    assert run(odd_docs, size=9.0) == brute(odd_docs, size=9.0)
    assert run(odd_docs, weights={None: 1.0, "b": 2.0}) == brute(odd_docs, weights={None: 1.0, "b": 2.0})
    assert run(odd_docs, weights={}) == []
    assert run(no_docs) == []
    with pytest.raises(ValueError):
        M.replicate(odd_docs, weights={"a": -1.0})
    out = M.replicate(odd_docs)
    assert out.columns[:len(odd_docs.columns)] == odd_docs.columns
