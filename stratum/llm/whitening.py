"""Whitening of embeddings from polarised variances.

Entries become integers x = floor(256 * c), so that all sums are exact. The
distinct vectors are the fit list: n of them with sums S. Tasks add up, for every
dimension and for the sum of every two dimensions, the squares of the centred
values n*x - S; totals leave a task as 40-bit digits of one integer, which Spark
sums by dimension pair. Then

    cov(i, j) = (Q(i + j) - Q(i) - Q(j)) / (2 n^3),      var(i) = Q(i) / n^3

are integers divided once, and only the d * (d + 1) / 2 totals reach the driver,
where the covariance matrix is assembled for ``eigh``. Rows are whitened in a map.

Defined results: a row whose vector is null, empty or holds a null or non-finite
entry is dropped, and so is one whose length is not that of most fit vectors (of
equally many, the greater). x is held to the range of a 64-bit integer. A
component without variance (eigenvalue within rounding of 0) whitens to 0, its
share is 0, and the identity error leaves it out. ``deviation`` is null where it
passes 64 bits. Repeated and null ids are kept; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import arrow_schema, field, map_batches, on_workers, record_batch, settle, slices

SCALE = 256
COMPONENTS = 4
#: A total is carried as so many signed digits: enough for 64-bit entries of 2^40 vectors.
DIGIT, DIGITS = 40, 7
#: Vectors whose pair sums a task squares at a time.
BLOCK = 2_048
LONG = np.iinfo(np.int64)
_WIDTHS = (np.int8, np.int16, np.int32, np.int64)


def quantise(vectors: pa.ListArray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the valid vectors of a list array, and their integer vectors."""
    c = pc.cast(vectors.values, pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    edges = vectors.offsets.to_numpy()
    wrong = np.concatenate([[0], np.cumsum(~np.isfinite(c))])[edges]
    valid = (np.diff(edges) > 0) & (np.diff(wrong) == 0) & vectors.is_valid().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(SCALE * c) + 0.0
    low, high = x <= float(LONG.min), x >= float(LONG.max)
    x = np.where(low | high | np.isnan(x), 0.0, x).astype(np.int64)
    x[low], x[high] = LONG.min, LONG.max
    places = np.flatnonzero(valid)
    return places, [x[edges[at]:edges[at + 1]] for at in places]


def pack(x: np.ndarray) -> bytes:
    """The vector as bytes of the least width that holds it, after that width:
    equal vectors are equal bytes."""
    least, most = int(x.min()), int(x.max())
    kind = next(k for k in _WIDTHS if np.iinfo(k).min <= least and most <= np.iinfo(k).max)
    return bytes([kind().itemsize]) + x.astype(f"<i{kind().itemsize}").tobytes()


def unpack(packed: Iterable[bytes]) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    return np.stack([np.frombuffer(p, f"<i{p[0]}", offset=1).astype(np.int64) for p in packed])


def digits(total: int) -> list[int]:
    """Signed base-2^DIGIT digits, least first, whose sum gives the total back."""
    return [(total >> (DIGIT * k)) & ((1 << DIGIT) - 1) for k in range(DIGITS - 1)] + [total >> (DIGIT * (DIGITS - 1))]


def undigits(row: Iterable[int]) -> int:
    return sum(int(d) << (DIGIT * k) for k, d in enumerate(row))


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n*x - S, in 64 bits where they hold it and its pair sums, else as integers
    of any size. ``sums`` is an array of Python integers."""
    largest = n * int(max(abs(int(x.max())), abs(int(x.min())))) + max(abs(int(s)) for s in sums)
    if largest < 1 << 61:
        return x * n - sums.astype(np.int64)
    return x.astype(object) * n - sums


def square_sums(z: np.ndarray) -> list[int]:
    """Exact sums of squares of each column."""
    if z.dtype == object:
        return [int(s) for s in (z * z).sum(0)]
    largest = max(int(z.max()), -int(z.min()))
    if largest * largest * len(z) < 1 << 63:
        return np.einsum("ij,ij->j", z, z).tolist()
    if len(z) > 1 << 10:
        return [a + b for a, b in zip(square_sums(z[:1 << 10]), square_sums(z[1 << 10:]))]
    # Parts of 21 bits (the top one signed): products of two, 1,024 times, stay below 2^63.
    parts = [z & 0x1FFFFF, (z >> 21) & 0x1FFFFF, z >> 42]
    total = [0] * z.shape[1]
    for a in range(3):
        for b in range(a, 3):
            part = np.einsum("ij,ij->j", parts[a], parts[b]).tolist()
            total = [t + (p << (21 * (a + b) + (a < b))) for t, p in zip(total, part)]
    return total


def _totals(fit: DataFrame, work) -> dict[tuple[int, int], int]:
    """Sum over the fit list of what ``work(matrix)`` yields as ((i, j), integer):
    added up in each task, then by (i, j) over the tasks."""
    ddl = "i int, j int, " + ", ".join(f"d{k} bigint" for k in range(DIGITS))
    schema = arrow_schema(ddl)
    on_workers(fit.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], int] = {}
        for matrix in _matrices(batches):
            for key, value in work(matrix):
                sums[key] = sums.get(key, 0) + value
        if sums:
            rows = [(i, j, *digits(v)) for (i, j), v in sums.items()]
            yield record_batch(dict(zip(schema.names, map(list, zip(*rows)))), schema)

    parts = fit.mapInArrow(run, ddl).groupBy("i", "j").agg(*[F.sum(f"d{k}").alias(f"d{k}") for k in range(DIGITS)])
    return {(r[0], r[1]): undigits(r[2:]) for r in parts.collect()}


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for part in slices(batch):
            packed = part.column("x").to_pylist()
            for at in range(0, len(packed), BLOCK):
                yield unpack(packed[at:at + BLOCK])


class Fit:
    """n, S and the covariance of a fit list, with its leading components."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, components: int):
        self.n, self.sums, self.covariance = n, np.array(sums, object), covariance
        values, vectors = np.linalg.eigh(covariance)
        values, vectors = values[::-1], vectors[:, ::-1]
        trace = float(np.trace(covariance))
        k = min(components, len(sums))
        self.eigenvalues = values[:k]
        # Either sign is a component: the largest entry is made positive.
        top = vectors[:, :k]
        self.vectors = top * np.where(top[np.abs(top).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
        self.varies = self.eigenvalues > max(float(values[0]), 0.0) * len(sums) * np.finfo(float).eps
        scale = np.sqrt(np.where(self.varies, self.eigenvalues, 1.0))
        self.projection = np.where(self.varies, self.vectors / scale, 0.0)
        self.explained = np.where(self.varies, self.eigenvalues / (trace if trace > 0 else 1.0), 0.0)
        self.mean = np.array([s / n for s in sums])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.projection

    def deviations(self, x: np.ndarray) -> list[int | None]:
        z = centred(x, self.n, self.sums)
        return [v if v <= LONG.max else None for v in square_sums(z.T)]


def quantised(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, length, x) of the rows with a valid vector."""
    def step(batch: pa.RecordBatch) -> dict:
        places, found = quantise(batch.column("vector"))
        return {"id": batch.column("id").take(pa.array(places)), "length": [len(x) for x in found],
                "x": [pack(x) for x in found]}

    return map_batches(rows.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vector")), lambda: step,
                       f"id {field(rows, id_col)}, length int, x binary")


def fit_list(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(length, x): each distinct integer vector once, in the shared folder."""
    return settle(quantised(rows, id_col, vec_col).select("length", "x").distinct(), "fit")


def learn(fit: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, int, Fit | None]:
    """The fit list's vectors of the usual length, that length and their fit
    (None for an empty list)."""
    most = fit.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).first()
    if most is None:
        return fit, 0, None
    length, n = most
    fit = fit.where(F.col("length") == length)

    def column_sums(x: np.ndarray):
        high, low = x >> 32, x & 0xFFFFFFFF
        return (((i, i), (h << 32) + v) for i, (h, v) in enumerate(zip(high.sum(0).tolist(), low.sum(0).tolist())))

    found = _totals(fit, column_sums)
    sums = np.array([found[i, i] for i in range(length)], object)

    def pair_squares(x: np.ndarray):
        z = centred(x, n, sums)
        for i in range(length):
            yield (i, i), square_sums(z[:, i:i + 1])[0]
            if i + 1 < length:
                yield from zip(((i, j) for j in range(i + 1, length)), square_sums(z[:, i:i + 1] + z[:, i + 1:]))

    squares = _totals(fit, pair_squares)
    covariance = np.empty((length, length))
    for i in range(length):
        covariance[i, i] = squares[i, i] / n ** 3
        for j in range(i + 1, length):
            twice = squares[i, j] - squares[i, i] - squares[j, j]
            covariance[i, j] = covariance[j, i] = twice / (2 * n ** 3)
    return fit, length, Fit(n, sums.tolist(), covariance, components)


def identity_error(fit: DataFrame, of: Fit) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    ddl = "a int, b int, total double"
    schema = arrow_schema(ddl)
    on_workers(fit.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = of.projection.shape[1]
        total = np.zeros((k, k + 1))
        for x in _matrices(batches):
            w = of.whiten(x)
            total += np.concatenate([w.T @ w, w.sum(0)[:, None]], 1)
        a, b = np.indices(total.shape)
        yield record_batch({"a": a.ravel().tolist(), "b": b.ravel().tolist(), "total": total.ravel().tolist()}, schema)

    total = {(r.a, r.b): r.total / of.n for r in
             fit.mapInArrow(run, ddl).groupBy("a", "b").agg(F.sum("total").alias("total")).collect()}
    k, kept = of.projection.shape[1], np.flatnonzero(of.varies).tolist()
    return max((abs(total[a, b] - total[a, k] * total[b, k] - (a == b)) for a in kept for b in kept), default=0.0)


def whiten(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): for
    each valid row one row per component."""
    fit, length, of = learn(fit_list(rows, id_col, vec_col), components)
    ddl = (f"id {field(rows, id_col)}, component int, n bigint, deviation bigint, whitened double, "
           "explained double, identity_error double")
    if of is None:
        return rows.sparkSession.createDataFrame([], ddl)
    error = identity_error(fit, of)
    k = of.projection.shape[1]

    def step(batch: pa.RecordBatch) -> dict:
        x = unpack(batch.column("x").to_pylist()) if batch.num_rows else np.zeros((0, length), np.int64)
        m = len(x)
        return {"id": batch.column("id").take(pa.array(np.repeat(np.arange(m), k))),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                "n": pa.array(np.full(m * k, of.n)),
                "deviation": [d for d in (of.deviations(x) if m else []) for _ in range(k)],
                "whitened": pa.array(of.whiten(x).ravel()),
                "explained": pa.array(np.tile(of.explained, m)),
                "identity_error": pa.array(np.full(m * k, error))}

    return map_batches(quantised(rows, id_col, vec_col).where(F.col("length") == length), lambda: step, ddl)


__all__ = ["Fit", "fit_list", "identity_error", "learn", "pack", "quantise", "square_sums", "unpack", "whiten"]
