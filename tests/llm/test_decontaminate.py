from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import documents, some_texts, with_odd_columns
from stridelog.llm import decontaminate as dc


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(texts, items):
    """Hit places and items of every text, window by window."""
    out = []
    for text in texts:
        ws, hit, found = words_of(text), set(), set()
        for item, passage in items:
            ps = words_of(passage)
            size = min(len(ps), 10)
            wanted = {tuple(ps[i:i + size]) for i in range(len(ps) - size + 1)} if ps else set()
            for i in range(len(ws) - size + 1 if ps else 0):
                if tuple(ws[i:i + size]) in wanted:
                    hit.update(range(i, i + size))
                    if item is not None:
                        found.add(str(item))
        out.append((len(ws), len(hit), tuple(sorted(found))))
    return out


def planted(seed):
    draw = random.Random(seed)
    texts = [t for t in some_texts(seed, 60)]
    items = [(i, " ".join(words_of(draw.choice(texts))[3:3 + draw.randint(1, 40)])) for i in range(25)]
    items += [(100, "Zq-Zq! 7 zq"), (101, ""), (102, None), (None, "only here"), (103, items[2][1]),
              (104, " ".join(words_of(items[3][1])[:12])), (100, "twice given id")]
    texts += ["x zq ZQ 7 zq", "only HERE, only here", "", None, "twice given id",
              " ".join(p or "" for _, p in items), "zq zq 7"]
    return texts, items


@pytest.mark.parametrize("block_words", [1 << 20, 60])
def test_hits_are_those_of_all_windows(spark, block_words):
    texts, items = planted(3)
    docs = with_odd_columns(documents(spark, texts))
    benchmark = spark.createDataFrame(items, "item_id LONG, text STRING")
    rows = dc.contamination(docs, benchmark, block_words=block_words).withColumn(
        "hit", dc.n_hit()).orderBy("doc_id").collect()
    assert [(r["_n_words"], r["hit"], tuple(r["_items"])) for r in rows] == plain(texts, items)
    assert [r["text"] for r in rows] == texts
    clean = dc.decontaminate(docs, benchmark, block_words=block_words)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {
        i for i, (_, hit, _) in enumerate(plain(texts, items)) if hit == 0}


def test_long_items_are_cut_without_loss(spark, monkeypatch):
    draw = random.Random(5)
    item = " ".join(draw.choice("abcdefgh") for _ in range(400))
    parts = item.split()
    texts = [" ".join(parts[i:i + 11]) for i in range(0, 390, 7)] + [item]
    monkeypatch.setattr(dc, "PIECE_WORDS", 50)
    # The cut is made in the workers: pieces of the package's own size would be one piece.
    pieces = dc._pieces(spark.createDataFrame([("one", item)], "item_id STRING, text STRING"),
                        "item_id", "text").collect()
    assert max(len(r["words"]) for r in pieces) <= 59 or len(pieces) == 1
    rows = dc.contamination(documents(spark, texts),
                            spark.createDataFrame([("one", item)], "item_id STRING, text STRING"))
    got = [(r["_n_words"], r["hit"], tuple(r["_items"]))
           for r in rows.withColumn("hit", dc.n_hit()).orderBy("doc_id").collect()]
    assert got == plain(texts, [("one", item)])


def test_longest_matches_are_those_of_a_plain_search():
    draw = np.random.default_rng(1)
    words = draw.integers(0, 4, 500)
    starts = np.flatnonzero(words)
    tests = draw.integers(1, 4, 120)
    left = 120 - np.arange(120)
    order = dc.suffix_array(words, starts, 120)
    length, first, last = dc.longest_matches(words, order, tests, left, np.full(120, 3))

    def common(a, b):
        n = 0
        while a + n < 500 and b + n < 120 and words[a + n] == tests[b + n]:
            n += 1
        return n

    for t in range(120):
        best = [common(s, t) for s in starts]
        assert length[t] == max(best)
        if left[t] >= 3:
            assert set(order[first[t]:last[t]]) == {s for s, n in zip(starts, best) if n >= 3}


def test_empty_tables_and_many_equal_rows(spark):
    docs = documents(spark, ["one two three four"] * 400)
    items = spark.createDataFrame([(i, "two three") for i in range(50)], "item_id LONG, text STRING")
    rows = dc.contamination(docs, items)
    assert rows.where((dc.n_hit() == 2) & (F.size("_items") == 50)).count() == 400
    assert dc.contamination(docs, items.where("false")).where(dc.n_hit() == 0).count() == 400
    assert dc.contamination(docs.where("false"), items).count() == 0
    assert dc.decontaminate(docs, items).count() == 0
