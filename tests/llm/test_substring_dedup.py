from __future__ import annotations

import collections
import random

import pytest
from helpers import documents, some_texts, with_odd_columns, words
from pyspark.sql import functions as F

from stridelog.llm import substring_dedup
from stridelog.llm.substring_dedup import remove_repeats


def plain(texts, window):
    found = collections.Counter()
    for text in texts:
        w = words(text)
        found.update(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
    out = []
    for text in texts:
        w, gone = words(text), set()
        for i in range(len(w) - window + 1):
            if found[tuple(w[i:i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def corpus(seed):
    draw = random.Random(seed)
    base = some_texts(seed, 50, 60) + some_texts(seed + 1, 30, 2000)
    passage = " ".join(f"p{i}" for i in range(70))
    out = list(base)
    for text in base[:30]:
        w = words(text)
        at = draw.randrange(len(w) + 1)
        cut = draw.randrange(60)
        out.append(" ".join(w[:at]) + "\t" + " ".join(passage.split()[cut:cut + draw.randint(5, 60)])
                   + "\n" + " ".join(w[at:]))
    for text in base[40:70]:
        w = words(text)
        if w:
            w[draw.randrange(len(w))] = "edit"
        out.append(" ".join(w))
    out += ["a " * 500, "a b " * 200, "a a a b", passage + " tail", passage, passage, "", None, " \n"]
    out += [" ".join(words(base[60]) * 2)]
    return out


@pytest.mark.parametrize(("seed", "window", "anchor"), [(1, 35, 8), (2, 35, 8), (3, 12, 4), (4, 9, 9)])
def test_equals_plain_version(spark, seed, window, anchor):
    texts = corpus(seed)
    rows = remove_repeats(documents(spark, texts), window=window, anchor=anchor).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in rows}
    assert got == dict(enumerate(plain(texts, window)))


def test_the_way_for_many_documents_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BROADCAST_ROWS", 0)
    texts = corpus(5)
    rows = remove_repeats(documents(spark, texts)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in rows} == dict(
        enumerate(plain(texts, 35)))


def test_repeats_nulls_odd_columns_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = with_odd_columns(documents(spark, [text, None, "x"]))
    assert {r["n_removed"] for r in remove_repeats(docs).collect()} == {0}
    rows = remove_repeats(docs.union(docs)).collect()
    assert sorted(r["n_removed"] for r in rows) == [0, 0, 0, 0, 40, 40]
    nulls = docs.union(docs).withColumn("doc_id", F.lit(None).cast("long"))
    assert sorted(r["n_removed"] for r in remove_repeats(nulls).collect()) == [0, 0, 0, 0, 40, 40]
    assert remove_repeats(docs.where("false")).count() == 0


def test_thousands_of_copies_of_one_row(spark):
    """Lists of places follow the text, not the copies: 2,000 rows of 3,000 words, some 30 MB."""
    docs = spark.range(2000).selectExpr(
        "7L AS doc_id", "array_join(transform(sequence(1, 3000), i -> 'word' || i), ' ') AS text")
    rows = remove_repeats(docs.union(documents(spark, ["x y"]).select("doc_id", "text")))
    assert sorted((r["doc_id"], r["n_removed"], r["count"]) for r in rows.groupBy(
        "doc_id", "n_removed").count().collect()) == [(0, 0, 1), (7, 3000, 2000)]
    flags = substring_dedup._flags
    keyed = substring_dedup._keyed(docs, "doc_id", "text")
    phrases = substring_dedup._phrase_table(keyed, 35, 8)
    longest = flags(phrases, substring_dedup._index(phrases)).agg(F.max(F.size("flags"))).first()[0]
    assert longest < 3000
