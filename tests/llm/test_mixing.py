from __future__ import annotations

import collections
import hashlib
import math

from helpers import documents, with_odd_columns
from pyspark.sql import functions as F

from stridelog.llm.mixing import poisson_steps, replicate, source_rates


def unit(*values):
    digest = hashlib.md5("|".join("null" if v is None else str(v) for v in values).encode())
    return int(digest.hexdigest()[:13], 16) / 16 ** 13


def poisson(rate, u):
    """The least count whose cumulated probability is over ``u``."""
    k, p = 0, math.exp(-rate)
    total = p
    while total <= u:
        k += 1
        p *= rate / k
        total += p
    return k


def plain(rows, seed="mix"):
    """(id, copy) of every copy, from rows of (id, text, source)."""
    size = collections.Counter()
    for _, text, source in rows:
        size[source] += len((text or "").encode())
    share = {s: math.sqrt(b) for s, b in size.items()}
    scale = sum(size.values()) / sum(share.values())
    out = []
    for i, _, source in rows:
        rate = share[source] * scale / size[source] if size[source] else 0.0
        out += [(i, c) for c in range(poisson(rate, unit(f"{seed}-count", i, source)))]
    return out


def test_equals_plain_version(spark):
    texts = ["w" * (i % 90) for i in range(600)]
    docs = documents(spark, texts).withColumn("source", F.when(
        F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("s"), (F.col("doc_id") % 5).cast("string"))))
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    got = [(r["doc_id"], r["_copy"]) for r in replicate(docs).collect()]
    assert sorted(got) == sorted(plain(rows))


def test_weights_are_met_on_average(spark):
    docs = documents(spark, ["ten bytes."] * 6000)
    out = replicate(docs, weights={"src0": 6, "src1": 3}).groupBy("source").count().collect()
    n = {r["source"]: r["count"] for r in out}
    assert set(n) == {"src0", "src1"}
    assert abs(n["src0"] - 4000) < 250 and abs(n["src1"] - 2000) < 200


def test_steps_are_the_distribution_function(spark):
    for rate in (0.0, 0.3, 4.0, 900.0):
        steps = spark.range(1).select(poisson_steps(F.lit(rate)).alias("s")).first()["s"]
        assert steps[0] == math.exp(-rate) and abs(steps[-1] - 1) < 1e-9
        middle = int(rate)
        want = sum(math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1)) if rate else 1.0
                   for k in range(middle + 1))
        assert abs(steps[middle] - want) < 1e-9


def test_order_is_global_and_repeatable(spark):
    docs = documents(spark, ["some text"] * 500)
    one, two = replicate(docs), replicate(docs.repartition(7))
    rows = sorted((r["doc_id"], r["_copy"], r["_place"]) for r in one.collect())
    assert rows == sorted((r["doc_id"], r["_copy"], r["_place"]) for r in two.collect())
    places = [p for *_, p in rows]
    assert len(set(places)) == len(places) and 0.4 < sum(places) / len(places) < 0.6


def test_nulls_repeats_odd_columns_and_empty_tables(spark):
    docs = documents(spark, ["a", None, "", "a"])
    odd = with_odd_columns(docs)
    out = replicate(odd)
    assert set(out.columns) == set(odd.columns)
    out.collect()
    assert replicate(docs.where("false")).count() == 0
    empty = documents(spark, [None, ""])
    assert replicate(empty).count() == 0  # sources without bytes have the rate 0
    assert {r["_rate"] for r in source_rates(empty).collect()} == {0.0}
    nulls = docs.withColumn("doc_id", F.lit(None).cast("long"))
    replicate(nulls.union(nulls)).collect()
