from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, some_texts, with_odd_columns, words
from pyspark.sql import functions as F

from stridelog.llm import near_dedup as nd
from stridelog.llm.components import connected_components
from stridelog.llm.near_dedup import NearDedupConfig, keep_one_per_class, near_duplicate_classes
from stridelog.llm.textbatch import batches


def changed(text, draw, share):
    return " ".join(w if draw.random() > share else w + "x" for w in text.split(" "))


def corpus(seed=5):
    """Exact copies, near copies in families small and large, chains, and texts of their own."""
    draw = random.Random(seed)
    base = [" ".join(words(t)) for t in some_texts(seed, 40, 3000) if len(words(t)) > 40]
    out = list(base)
    out += [base[0]] * 5 + [base[1] + " \n"]
    out += [changed(base[2], draw, 0.01) for _ in range(60)]
    out += [changed(base[3], draw, 0.03) for _ in range(20)]
    chain = base[4]
    for _ in range(8):
        chain = changed(chain, draw, 0.015)
        out.append(chain)
    passage = " ".join(words(base[5])[:60])
    out += [passage + " " + " ".join(f"own{i}w{k}" for k in range(80)) for i in range(40)]
    out += ["short text", "short text", "short  text", "one", "", None, " \n"]
    draw.shuffle(out)
    return out


def plain_classes(texts, config=NearDedupConfig()):
    """Weighted Jaccard similarity of all pairs, and the components of its links."""
    frequency = Counter(w for t in texts for w in set(words(t)))
    filled = sum(bool(words(t)) for t in texts)
    idf = {w: 1 + math.log((filled + 1) / (n + 1)) for w, n in frequency.items()}
    bags = []
    for text in texts:
        w, bag = words(text), {}
        for i in range(max(1, len(w) - config.shingle + 1) if w else 0):
            gram = tuple(w[i:i + config.shingle])
            bag.setdefault(gram, [0, sum(idf[x] for x in gram) / len(gram)])[0] += 1
        bags.append({g: n * m for g, (n, m) in bag.items()})
    top = list(range(len(texts)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(bags):
        for j in range(i):
            shared = sum(min(v, bags[j][g]) for g, v in a.items() if g in bags[j])
            if a and shared >= (config.threshold - nd.ROUNDING) * (
                    sum(a.values()) + sum(bags[j].values()) - shared):
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize(
    "small_bucket, word_table", [(128, 1 << 18), (3, 1 << 18), (32, 100), (3, 0)])
def test_classes_equal_all_pairs(spark, small_bucket, word_table):
    """Whichever way buckets are searched and weights reach the texts."""
    texts = corpus()
    config = NearDedupConfig(small_bucket=small_bucket, word_table=word_table)
    rows = near_duplicate_classes(documents(spark, texts), config=config).collect()
    got = {r["doc_id"]: r["class_id"] for r in rows}
    assert got == dict(enumerate(plain_classes(texts)))


def test_samples_agree_as_often_as_texts_are_similar():
    draw, draws, config = random.Random(3), np.random.default_rng(4), NearDedupConfig(bands=64)
    text = " ".join(f"w{draw.randrange(500)}" for _ in range(600))
    pairs = [(text, changed(text, draw, share)) for share in (0.01, 0.03, 0.08)]
    tables = nd._random_tables(config.samples)
    for pair in pairs:
        both = [b for one in pair for _, _, b in batches(pa.array([one]))]
        name = np.unique(np.concatenate([b.word_hash() for b in both]))
        weights = nd.WordWeights(name, draws.uniform(1, 8, len(name)))
        sides = [nd.features(b, None, weights, 5) for b in both]
        true = nd.similarity(*sides, 1)[0]
        left, right = (nd.sketch(s, 1, tables)[0] for s in sides)
        assert abs((left == right).mean() - true) < 0.1


def test_one_of_each_class_is_kept(spark):
    texts = corpus(9)
    docs = with_odd_columns(documents(spark, texts))
    out = keep_one_per_class(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(set(plain_classes(texts)))


def test_repeats_null_ids_and_empty_tables(spark):
    docs = documents(spark, ["a b c d e f g", "a b c d e f g", None])
    twice = docs.union(docs)
    assert keep_one_per_class(twice).count() == 2
    nulls = twice.withColumn("doc_id", F.when(F.col("doc_id") != 1, F.col("doc_id")))
    rows = near_duplicate_classes(nulls).collect()
    assert sorted((r["doc_id"] is None, r["class_id"]) for r in rows) == [
        (False, 0), (False, 0), (False, 2), (False, 2), (True, 0), (True, 0)]
    assert near_duplicate_classes(docs.where("false")).count() == 0
    assert near_duplicate_classes(documents(spark, [None, ""])).count() == 2


def test_components_of_paths_and_stars(spark):
    draw = random.Random(1)
    path = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 180)]
    links = path + star + [(200, 200), (5, 4), (300, 299)]
    draw.shuffle(links)
    rows = connected_components(spark.createDataFrame(links, "a LONG, b LONG")).collect()
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 180)} | {200: 200, 300: 299, 299: 299}
    assert {r["node"]: r["label"] for r in rows} == want


def test_document_frequencies_are_exact_and_reach_every_word(spark):
    texts = ["a b a", "b c", None, "", "a d \u00e9", "a d \u00e9"]
    docs = documents(spark, texts).select(F.col("doc_id").alias("id"), "text")
    rows = nd.document_frequencies(docs, "text").collect()
    assert sorted(r["n"] for r in rows if r["word"] is not None) == [1, 2, 2, 2, 3]
    assert [r["n"] for r in rows if r["word"] is None] == [4]
    for size in (0, 1, 3, 100):
        weighed = nd._weighed(docs, NearDedupConfig(word_table=size))
        weights = weighed.weights
        assert len(weights.value.word) <= size
        table = weighed.with_rare(weighed.rows).orderBy("id").toArrow()
        assert table.column("id").to_pylist() == list(range(6))
        (_, _, batch), = batches(table.column("text").combine_chunks())
        got = weights.value.of(batch.word_hash(), table.column("rare").combine_chunks())
        want = [n for t in texts for n in ({"a": 3, "c": 1}.get(w, 2) for w in words(t))]
        assert np.allclose(got, [1 + math.log(5 / (n + 1)) for n in want])
