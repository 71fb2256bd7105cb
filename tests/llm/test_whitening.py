from __future__ import annotations

import numpy as np
import pytest

from stridelog.llm import whitening


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<FLOAT>, n LONG, _w DOUBLE")


def plain(rows):
    """Deviations with Python integers, components from numpy's own solver."""
    x = np.floor(1024 * np.array(rows, dtype=np.float32).astype(float)).astype(int) + 100_000
    n, sums = len(x), x.sum(axis=0)
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = x - sums / n
    matrix = centred.T @ centred / n
    values, columns = np.linalg.eigh(matrix)
    values, columns = values[::-1][:8], columns[:, ::-1][:, :8]
    return n, deviation, centred @ columns / np.sqrt(values), values / np.trace(matrix)


@pytest.mark.parametrize("d, n", [(24, 300), (3, 40)])
def test_whitening_is_that_of_a_plain_solver(spark, d, n):
    draw = np.random.default_rng(d)
    data = (draw.standard_normal((n, d)) * np.linspace(0.1, 2, d)).astype(np.float32)
    rows = [(i, v.tolist(), 1, 0.5) for i, v in enumerate(data)]
    odd = [(n, None, 1, 0.5), (n + 1, [1.0] * (d - 1) + [None], 1, 0.5), (n + 2, [], 1, 0.5),
           (n + 3, [float("nan")] + [0.0] * (d - 1), 1, 0.5), (n + 4, [1.0] * (d + 1), 1, 0.5),
           (n + 5, [float("-inf")] * d, 1, 0.5)]
    got = whitening.whiten(vectors(spark, rows + odd), keep=["vec_id"]).collect()
    count, deviation, white, explained = plain(data)
    parts = min(d, 8)
    assert len(got) == n * parts
    signs = {}
    for r in got:
        k, i = r["component"] - 1, r["vec_id"]
        assert r["n"] == count and int(r["deviation"]) == deviation[i]
        sign = signs.setdefault(k, np.sign(r["whitened"] * white[i, k]))
        assert abs(r["whitened"] - sign * white[i, k]) < 1e-9
        assert abs(r["explained"] / explained[k] - 1) < 1e-9
        assert r["identity_error"] < 1e-9


def matrices():
    draw = np.random.default_rng(4)
    basis = np.linalg.qr(draw.standard_normal((40, 40)))[0]
    yield "equal values", basis @ np.diag([3.0] * 5 + [1.0] * 35) @ basis.T
    yield "close values", basis @ np.diag(1 + 1e-12 * np.arange(40)) @ basis.T
    yield "diagonal", np.diag(np.arange(40.0))
    yield "blocks", np.kron(np.eye(10), np.array([[2, 1, 0, 0], [1, 2, 0, 0], [0, 0, 1, 0], [0, 0, 0, 5]]))
    yield "rank one", np.outer(np.arange(12.0), np.arange(12.0))
    yield "large and small", basis @ np.diag(10.0 ** np.arange(0, -40, -1)) @ basis.T
    yield "zero", np.zeros((5, 5))
    yield "single", np.array([[4.0]])
    yield "pair", np.array([[2.0, 1.0], [1.0, 2.0]])


@pytest.mark.parametrize("name, matrix", list(matrices()), ids=lambda x: x if isinstance(x, str) else "")
def test_leading_components(name, matrix):
    values, rows = whitening.leading_components(matrix, 8)
    size = max(np.abs(matrix).max(), 1e-300)
    want = np.linalg.eigvalsh(matrix)[::-1][:8]
    assert np.abs(values - want).max() < 1e-13 * size * len(matrix)
    assert np.abs(rows @ rows.T - np.eye(len(rows))).max() < 1e-12
    assert np.abs(rows @ matrix - values[:, None] * rows).max() < 1e-12 * size * len(matrix)


def test_sturm_counts_tell_how_many_are_less():
    draw = np.random.default_rng(9)
    diagonal, below = draw.standard_normal(30), draw.standard_normal(29)
    matrix = np.diag(diagonal) + np.diag(below, 1) + np.diag(below, -1)
    values, at = np.linalg.eigvalsh(matrix), draw.standard_normal(50) * 2
    assert whitening.sturm_counts(diagonal, below, at).tolist() == [(values < x).sum() for x in at]


def test_no_variance_and_no_vectors(spark):
    equal = vectors(spark, [(None, [1.0, 2.0], 1, 0.5)] * 5)
    assert whitening.whiten(equal, keep=["vec_id"]).count() == 0
    assert whitening.whiten(equal.where("false"), keep=["vec_id"]).count() == 0


def test_repeated_rows_come_out_as_often(spark):
    rows = [(7, [0.0, 1.0], 1, 0.5)] * 3 + [(7, [1.0, 0.0], 1, 0.5)]
    got = whitening.whiten(vectors(spark, rows), keep=["vec_id", "n"][:1]).collect()
    assert len(got) == 4 and {r["component"] for r in got} == {1}  # one direction only
    assert abs(sum(r["whitened"] for r in got)) < 1e-9


def test_large_numbers_of_rows_keep_deviations_exact(spark):
    sums = np.array([5 * 10 ** 14, -3], dtype=np.int64)
    model = whitening.Whitening(10 ** 9, sums, np.eye(2), np.ones(2), np.ones(2) / 2)
    row = whitening.transform(vectors(spark, [(1, [3.5, -2.25], 1, 0.5)]), model, ["vec_id"]).first()
    x = [int(1024 * 3.5) + 100_000, int(1024 * -2.25) + 100_000]
    assert int(row["_deviation"]) == sum(
        (10 ** 9 * a - int(s)) ** 2 for a, s in zip(x, sums))
