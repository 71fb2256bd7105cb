from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridelog.llm.neighbours import SearchConfig, nearest

VECTORS = "vec_id LONG, embedding ARRAY<FLOAT>"


def plain(rows, queries, k):
    out = {}
    for q, v in queries:
        far = sorted((float(np.sqrt(((np.float32(x).astype(float) - np.float32(v)) ** 2).sum())), i)
                     for i, x in rows if i != q and len(x) == len(v))
        out[q] = far[:k]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("kind", ["even", "clusters", "copies"])
def test_recall(spark, kind):
    draw = np.random.default_rng(3)
    points = draw.standard_normal((1500, 24))
    if kind == "clusters":
        points = points * 0.05 + draw.standard_normal((12, 24))[draw.integers(12, size=1500)]
    if kind == "copies":
        points[::3] = points[0]
    rows = [(i, p.astype(np.float32).tolist()) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, VECTORS)
    config = SearchConfig(block=400, query_block=20)
    got = answers(nearest(df, df.where("vec_id % 20 = 0"), config=config))
    want = plain(rows, [r for r in rows if r[0] % 20 == 0], 10)
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i in got[q]} & {i for _, i in w}) for q, w in want.items())
    assert hits >= 0.98 * 10 * len(want)
    for q, found in got.items():
        assert found == sorted(found)
        true = {i: s for s, i in plain(rows, [rows[q]], len(rows))[q]}
        assert all(abs(s - true[i]) < 1e-12 for s, i in found)
    if kind == "copies":
        assert [i for _, i in got[0]] == list(range(3, 33, 3))


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]),
            (9, [1.0, 0.0])]
    df = spark.createDataFrame(rows, VECTORS).withColumn("block", F.lit(1)).withColumn("v", F.lit(2))
    got = answers(nearest(df, df))
    assert {q: [i for _, i in f] for q, f in got.items()} == {0: [9, 1], 1: [0, 9], 9: [0, 1]}
    assert nearest(df.where("false"), df).count() == 0
    assert nearest(df, df.where("false")).count() == 0


def test_repeated_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0])], VECTORS)
    got = answers(nearest(df, df, k=5))
    assert got == {0: [(1.0, 1), (1.0, 1)], 1: [(1.0, 0)]}
