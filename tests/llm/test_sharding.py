from __future__ import annotations

import collections
import random
import zlib

import pytest
from helpers import documents, some_texts, with_odd_columns
from pyspark.sql import functions as F

from stridelog.llm import sharding


def plain_capacity(sizes, shards):
    def fits(most):
        used, filled = 1, 0
        for size in sizes:
            if filled + size > most:
                used, filled = used + 1, 0
            filled += size
        return used <= shards

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


@pytest.mark.parametrize(("seed", "groups", "keys"), [(1, 4, 60), (2, 200, 60), (3, 3000, 60),
                                                      (4, 150, 14), (5, 500, 40)])
def test_capacity_is_the_smallest(spark, monkeypatch, seed, groups, keys):
    monkeypatch.setattr(sharding, "FIRST_BITS", 4)  # so that cells must be split again
    monkeypatch.setattr(sharding, "COLLECT_BITS", 6)
    draw = random.Random(seed)
    places = sorted(draw.sample(range(1 << keys), groups))
    sizes = [int(draw.paretovariate(1.2) * 50) for _ in places]
    table = spark.createDataFrame(list(zip(places, sizes)), "key LONG, bytes LONG")
    plan = sharding.plan_shards(table, 7)
    assert plan.capacity == plain_capacity(sizes, 7)
    assert plan.first_keys == sorted(plan.first_keys)
    filled = [0] * 7
    for key, size in zip(places, sizes):
        filled[sum(key >= first for first in plan.first_keys[1:])] += size
    assert max(filled) <= plan.capacity


def test_assignment(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_PIECE", 20)
    texts = some_texts(11, 300) + ["same"] * 150 + [None, "", None]
    docs = with_odd_columns(documents(spark, texts))
    rows = sharding.assign_shards(docs, 5).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    slots, home, filled = collections.defaultdict(list), {}, collections.Counter()
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(data) + 1 and r["text_crc32"] == zlib.crc32(data)
        assert home.setdefault(data, r["shard"]) == r["shard"]
        slots[r["shard"]].append(r["slot"])
        filled[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(filled.values()) < 1.2 * min(filled.values())


def test_few_groups_repeats_nulls_and_empty_tables(spark):
    docs = documents(spark, ["x", None])
    nulls = docs.withColumn("doc_id", F.lit(None).cast("long"))
    rows = sharding.assign_shards(docs.union(docs).union(nulls), 16).collect()
    assert len(rows) == 6 and len({r["shard"] for r in rows}) == 2
    assert sorted(r["slot"] for r in rows) == [0, 0, 1, 1, 2, 2]
    assert sharding.assign_shards(docs.where("false"), 4).count() == 0
