from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest

from stratum.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>"


def integers(vector):
    return [int(np.floor(256.0 * float(np.float32(c)))) for c in vector]


def reference(rows):
    """x of the valid rows, the fit list's n, S and exact covariance."""
    valid = [(i, tuple(integers(v))) for i, v in rows
             if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({x for _, x in valid})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(d)]
    cov = np.array([[float(Fraction(sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in fit), n ** 3))
                     for j in range(d)] for i in range(d)])
    return valid, fit, n, sums, cov


def made(rows=150, dims=7, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(rows, dims)) @ rng.normal(size=(dims, dims))
    out = [(k, [float(c) for c in v]) for k, v in enumerate(base)]
    return out + [(1000 + k, out[0][1]) for k in range(60)] + [
        (2000, None), (2001, [None] + [1.0] * (dims - 1)), (2002, [float("nan")] * dims), (2003, [float("inf")] * dims),
        (None, out[1][1]), (2004, [-0.0] * dims), (2005, [])]


def test_against_exact_covariance(spark):
    rows = made()
    valid, fit, n, sums, cov = reference(rows)
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == 4 * len(valid)
    by_row = {}
    for r in got:
        by_row.setdefault((r.id, r.component), []).append(r)
    signs = {}
    for i, x in valid:
        z = np.array([a - s / n for a, s in zip(x, sums)])
        for k in range(4):
            for r in by_row[i, k + 1]:
                assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums))
                assert r.explained == pytest.approx(values[k] / np.trace(cov), rel=1e-9)
                want = float(z @ vectors[:, k]) / np.sqrt(values[k])
                sign = signs.setdefault(k, 1.0 if want * r.whitened > 0 else -1.0)
                assert r.whitened == pytest.approx(sign * want, abs=1e-9)
                assert 0 <= r.identity_error < 1e-9


def test_covariance_is_polarised_exactly(spark):
    rows = made(90, 5, 8)
    *_, n, sums, cov = reference(rows)
    _, length, of = whitening.learn(whitening.fit_list(spark.createDataFrame(rows, SCHEMA)))
    assert length == 5 and of.n == n and of.sums.tolist() == sums
    assert np.array_equal(of.covariance, cov)                  # both rounded once


def test_square_sums_of_any_size():
    rng = np.random.default_rng(1)
    for bits in (10, 30, 45, 61):
        z = rng.integers(-2 ** bits, 2 ** bits, (1500, 3))
        want = [sum(int(v) ** 2 for v in column) for column in z.T]
        assert whitening.square_sums(z) == want == whitening.square_sums(z.astype(object))


def test_digits():
    for v in (0, -1, 5, -2 ** 200, 2 ** 270 - 7, 2 ** 40, -2 ** 40 + 1):
        assert whitening.undigits(whitening.digits(v)) == v


def test_pack_is_canonical():
    for x in ([1, -128], [127, 128], [40_000, 0], [2 ** 40, -3], [-2 ** 63, 2 ** 63 - 1]):
        assert whitening.unpack([whitening.pack(np.array(x, np.int64))]).tolist() == [x]


def test_large_entries(spark):
    rows = [(k, [3e38 * (k % 3 - 1), 1e15 * k, 0.5]) for k in range(12)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert len(got) == 36 and all(np.isfinite(r.whitened) for r in got)
    assert any(r.deviation is None for r in got)               # passes 64 bits


def test_without_variance(spark):
    for rows in ([(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [0.5, 0.25])]):
        got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
        assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(1, 0, 0.0, 0.0, 0.0)}
        assert len(got) == 2 * len(rows)


def test_one_direction_only(spark):
    rows = [(k, [k / 8, k / 4, 1.0, 1.0, 1.0]) for k in range(20)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.whitened for r in got if r.component > 1} == {0.0}
    assert [r.explained for r in got if r.component == 1] == pytest.approx([1.0] * 20)
    assert got[0].identity_error < 1e-9


def test_odd_lengths_names_and_types(spark):
    rows = [(str(k), [Decimal(k), Decimal(-k * k)], 1.0, "x") for k in range(9)] + [("z", [Decimal(1)], None, None)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<decimal(9,2)>, x double, length string")
    got = whitening.whiten(df).collect()
    assert {r.id for r in got} == {str(k) for k in range(9)} and {r.n for r in got} == {9}


def test_empty_tables(spark):
    for rows in ([], [(1, None), (2, [None]), (3, [])]):
        df = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
        assert df.collect() == [] and "identity_error" in df.columns
