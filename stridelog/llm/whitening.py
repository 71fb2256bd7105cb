"""Embedding whitening: leading principal components of all vectors, and rows projected on them.

The covariance is taken in two passes over all vectors: exact integer sums first, then products of
the centred values, added up per task and across tasks by matrix cell. What reaches the driver has
the size of the matrix, whatever the number of vectors. There the symmetric matrix is brought to
tridiagonal form by Householder reflections, its leading eigenvalues are found by bisection on
Sturm counts, and their vectors by inverse iteration, in which vectors of close eigenvalues are
made orthogonal to each other. A last pass projects every vector.

Vectors are integers here: x = floor(1024 c) + 100000 for an entry c. Sums and squares are exact
while n times the distance of an entry x from its mean stays below 2^55.

Rows whose vector is null, empty, or holds a null or non-finite entry take no part, and neither do
vectors of another length than the commonest one (of equally common ones the longest). Repeated
rows and repeated or null ids count and come out as often as they are there. Components without
variance (eigenvalue 0 up to rounding) have no direction and are left out, so that a table of one
vector, or of equal ones, has no rows, like an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelog.llm.common import written

SCALE, SHIFT = 1024.0, 100_000
COMPONENTS = 8

# Squares of numbers up to 2^63 in three parts, cut at this bit.
_CUT = 24
_EPS = np.finfo(float).eps


@dataclass(frozen=True)
class Whitening:
    """What the rows are projected with: exact sums, unit components (rows) and eigenvalues."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def usable(vector: Column) -> Column:
    """Whether a vector is there, is not empty, and has only finite entries."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def _vectors(df: DataFrame, vector: str, *others: Column) -> DataFrame:
    return df.where(usable(F.col(vector))).select(
        F.col(vector).cast("array<double>").alias("v"), *others)


def _matrices(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of equal length as one integer matrix each: (places of the rows, matrix)."""
    sizes = lists.value_lengths().to_numpy()
    values = np.floor(SCALE * lists.flatten().to_numpy()).astype(np.int64) + SHIFT
    ends = np.cumsum(sizes)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, values[(ends[at] - size)[:, None] + np.arange(size)]


def exact_sums(vectors: DataFrame) -> tuple[int, np.ndarray]:
    """Number and sums of the vectors of the commonest length."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for part in parts:
            for at, x in _matrices(part.column(0)):
                row = np.append(x.sum(axis=0), len(at))
                totals[x.shape[1]] = totals.get(x.shape[1], 0) + row
        for size, row in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size + 1, size)), pa.array(np.arange(size + 1)), pa.array(row)],
                ["size", "i", "value"])

    cells = vectors.select("v").mapInArrow(run, "size LONG, i LONG, value LONG").groupBy(
        "size", "i").agg(F.sum("value").alias("value"))
    cells = written(cells, "vector-sums")
    commonest = cells.where("i = size").orderBy(F.desc("value"), F.desc("size")).first()
    if commonest is None:
        return 0, np.zeros(0, dtype=np.int64)
    rows = cells.where((F.col("size") == commonest["size"]) & (F.col("i") < F.col("size")))
    sums = np.zeros(commonest["size"], dtype=np.int64)
    for r in rows.collect():
        sums[r["i"]] = r["value"]
    return int(commonest["value"]), sums


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exactly."""
    return x * np.int64(n) - sums


def covariance(vectors: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """The covariance (divisor n) of all vectors as long as ``sums``, centred before multiplying."""
    d = len(sums)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for part in parts:
            for _, x in _matrices(part.column(0)):
                if x.shape[1] == d:
                    centred = _centred(x, n, sums) / n
                    total += centred.T @ centred
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "value"])

    cells = vectors.select("v").mapInArrow(run, "i LONG, j LONG, value DOUBLE").groupBy(
        "i", "j").agg((F.sum("value") / F.lit(float(n))).alias("value"))
    out = np.zeros((d, d))
    for r in cells.collect():  # as many as the matrix has
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["value"]
    return out


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, subdiagonal and reflectors (rows) of a symmetric matrix brought to that form."""
    a = matrix.astype(float).copy()
    d = len(a)
    reflectors = np.zeros((max(d - 2, 0), d))
    for k in range(d - 2):
        x = a[k + 1:, k]
        v = x.copy()
        v[0] += np.copysign(np.linalg.norm(x), x[0])
        length = np.linalg.norm(v)
        if length == 0:
            continue
        v /= length
        reflectors[k, k + 1:] = v
        block = a[k + 1:, k + 1:]
        p = block @ v
        w = p - (v @ p) * v
        block -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1:, k] = a[k, k + 1:] = x - 2 * (v @ x) * v
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def sturm_counts(diagonal: np.ndarray, below: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of a tridiagonal matrix are less than each of the places ``at``."""
    tiny = np.finfo(float).tiny * 1e10 + _EPS ** 2 * np.abs(diagonal).max(initial=0.0)
    q = diagonal[0] - at
    count = (q < 0).astype(int)
    for i in range(1, len(diagonal)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = diagonal[i] - at - below[i - 1] ** 2 / q
        count += q < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, below: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, from the largest, by bisection to the last bit."""
    d = len(diagonal)
    reach = np.zeros(d)
    reach[:-1] += np.abs(below)
    reach[1:] += np.abs(below)
    rank = d - np.arange(count)  # the k-th largest has d - k lesser ones, and itself
    low = np.full(count, (diagonal - reach).min()) - 1e-300
    high = np.full(count, (diagonal + reach).max()) * (1 + 4 * _EPS) + 1e-300
    for _ in range(2_000):
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        over = sturm_counts(diagonal, below, middle) >= rank
        high, low = np.where(over, middle, high), np.where(over, low, middle)
    return low + (high - low) / 2


def _shifted_solve(diagonal: np.ndarray, below: np.ndarray, shift: float,
                   right: np.ndarray) -> np.ndarray:
    """Solve (T - shift) y = right by elimination with row exchanges."""
    d = len(diagonal)
    small = _EPS * max(np.abs(diagonal).max(), np.abs(below).max(initial=0.0), 1e-300)
    main, over = diagonal - shift, np.append(below, 0.0)
    second, under, y = np.zeros(d), below.copy(), right.copy()
    for i in range(d - 1):
        if abs(under[i]) > abs(main[i]):
            main[i], under[i] = under[i], main[i]
            over[i], main[i + 1] = main[i + 1], over[i]
            second[i], over[i + 1] = over[i + 1], 0.0
            y[i], y[i + 1] = y[i + 1], y[i]
        if main[i] == 0.0:
            main[i] = small
        factor = under[i] / main[i]
        main[i + 1] -= factor * over[i]
        over[i + 1] -= factor * second[i]
        y[i + 1] -= factor * y[i]
    if abs(main[-1]) < small:
        main[-1] = small
    for i in range(d - 1, -1, -1):
        if i + 1 < d:
            y[i] -= over[i] * y[i + 1]
        if i + 2 < d:
            y[i] -= second[i] * y[i + 2]
        y[i] /= main[i]
    return y


def tridiagonal_vectors(diagonal: np.ndarray, below: np.ndarray,
                        values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) for the eigenvalues, given from the largest.

    Eigenvalues closer than a thousandth of the matrix's size form clusters: each vector of one is
    made orthogonal to those before it at every step, and equal shifts are moved apart.
    """
    d, draw = len(diagonal), np.random.default_rng(0)
    size = max(np.abs(diagonal).max(), np.abs(below).max(initial=0.0), 1e-300)
    vectors, first, shift = np.zeros((len(values), d)), 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * size:
            first = k
        shift = min(value, shift - 10 * _EPS * size) if k > first else value
        y = draw.standard_normal(d)
        for _ in range(6):
            y = _shifted_solve(diagonal, below, shift, y / np.linalg.norm(y))
            for _ in range(2):
                y = y / np.linalg.norm(y)
                y -= vectors[first:k].T @ (vectors[first:k] @ y)
        vectors[k] = y / np.linalg.norm(y)
    return vectors


def leading_components(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, from the largest, and unit eigenvectors (rows) of a symmetric matrix.

    A component's entry of largest size is positive.
    """
    size = np.abs(matrix).max()
    if len(matrix) == 1 or size == 0:
        return np.diag(matrix)[:count].copy(), np.eye(len(matrix))[:count]
    diagonal, below, reflectors = tridiagonal(matrix / size)
    values = leading_eigenvalues(diagonal, below, min(count, len(matrix)))
    vectors = tridiagonal_vectors(diagonal, below, values)
    for v in reflectors[::-1]:
        vectors -= 2 * np.outer(vectors @ v, v)
    signs = np.sign(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=1)[:, None], axis=1))
    return values * size, vectors * signs


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Whitening of the usable vectors of ``df``; all of them count."""
    vectors = _vectors(df, vector)
    n, sums = exact_sums(vectors)
    if n == 0:
        none = np.zeros(0)
        return Whitening(0, sums, np.zeros((0, 0)), none, none)
    matrix = covariance(vectors, n, sums)
    trace = float(np.trace(matrix))
    values, rows = leading_components(matrix, components)
    real = values > len(matrix) * _EPS * max(trace, 1e-300)
    return Whitening(n, sums, rows[real], values[real], values[real] / (trace or 1.0))


def transform(df: DataFrame, model: Whitening, keep: list[str],
              vector: str = "embedding") -> DataFrame:
    """The columns ``keep`` of the rows that take part, with ``_whitened``, an array of their
    values per component, and ``_deviation``, the exact sum of (n x - S)^2 as a decimal."""
    n, sums = model.n, model.sums
    factors = model.components / np.sqrt(model.eigenvalues)[:, None] if n else model.components

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at, x in _matrices(part.column(0)):
                if x.shape[1] != len(sums):
                    continue
                centred = _centred(x, n, sums)
                high, low = centred >> _CUT, centred & ((1 << _CUT) - 1)
                white = (centred / n) @ factors.T
                bounds = np.arange(len(at) + 1) * white.shape[1]
                yield pa.RecordBatch.from_arrays([
                    part.column(1).take(pa.array(at)),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)),
                                             pa.array(white.ravel())),
                    pa.array((high * high).sum(axis=1)), pa.array((high * low).sum(axis=1)),
                    pa.array((low * low).sum(axis=1))],
                    ["_kept", "_whitened", "_high", "_mixed", "_low"])

    kept = F.struct(*[F.col(k) for k in keep]) if keep else F.struct(F.lit(0))
    source = _vectors(df, vector, kept.alias("_kept"))
    schema = (f"_kept {source.schema['_kept'].dataType.simpleString()}, _whitened ARRAY<DOUBLE>, "
              "_high LONG, _mixed LONG, _low LONG")
    part = lambda name, factor: F.col(name).cast("decimal(19,0)") * F.lit(factor).cast(
        "decimal(16,0)")
    total = (part("_high", 1 << 2 * _CUT) + part("_mixed", 2 << _CUT) + part("_low", 1))
    return source.mapInArrow(run, schema).select(
        *[F.col("_kept")[k].alias(k) for k in keep], "_whitened",
        total.cast("decimal(38,0)").alias("_deviation"))


def identity_error(rows: DataFrame, count: int) -> float:
    """The largest absolute entry of the covariance of ``_whitened`` minus the identity."""
    if not count:
        return 0.0
    w = [F.col("_whitened")[i] for i in range(count)]
    means = [F.avg(w[i]).alias(f"m{i}") for i in range(count)]
    products = [F.avg(w[i] * w[j]).alias(f"p{i}_{j}") for i in range(count) for j in range(i + 1)]
    got = rows.agg(*means, *products).first()
    return max(abs(got[f"p{i}_{j}"] - got[f"m{i}"] * got[f"m{j}"] - (i == j))
               for i in range(count) for j in range(i + 1))


def whiten(df: DataFrame, keep: list[str], vector: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: ``keep``, ``component`` from 1, ``n``, ``deviation``
    (decimal), ``whitened``, ``explained`` (share of the variance) and ``identity_error``."""
    model = fit(df, vector, components)
    rows = written(transform(df, model, keep, vector), "whitened")
    error = identity_error(rows, len(model.eigenvalues))
    shares = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    return rows.select(*keep, "_deviation", F.posexplode("_whitened").alias("_i", "_w")).select(
        *keep, (F.col("_i") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
        F.col("_deviation").alias("deviation"), F.col("_w").alias("whitened"),
        F.get(shares, F.col("_i")).alias("explained"), F.lit(float(error)).alias("identity_error"))
