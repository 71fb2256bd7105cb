from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from helpers import documents, with_odd_columns
from stridelog.llm import spelling


def plain_counts(rows, every):
    """Occurrences of words with the planted typing errors, run by run."""
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                out[run] += 1
    return out


def one_edit(a, b):
    """Whether one inserted, deleted or replaced code point turns a into b, by trying them all."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_forms(counts):
    near = {a: [b for b in counts if one_edit(a, b)] for a in counts}
    form = {}
    for a, others in near.items():
        best = min(others, key=lambda b: (-counts[b], b), default=None)
        form[a] = best if best is not None and counts[best] >= 10 * counts[a] else None
    out = set()
    for a in counts:
        root = a
        while form[root] is not None:
            root = form[root]
        out.add((a, form[a], root, counts[a], len(near[a]), counts[form[a]] if form[a] else None))
    return out


def got(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
            for r in df.collect()}


def some_words(seed, count, letters="abé", sizes=(7, 12)):
    draw = random.Random(seed)
    words = {"".join(draw.choice(letters) for _ in range(draw.randint(*sizes))) for _ in range(count)}
    return {w: draw.choice([1, 2, 3, 20, 30, 400, 5000, 100000]) for w in words}


@pytest.mark.parametrize("group", [2, 16, 512])
def test_forms_are_those_of_all_pairs(spark, group):
    counts = some_words(1, 900)
    words = spark.createDataFrame(list(counts.items()), "word STRING, n LONG")
    assert got(spelling.variant_forms(words, group=group)) == plain_forms(counts)


def test_a_large_family_of_one_prefix(spark):
    draw, stem = random.Random(2), "commonstemofmanywords"
    counts = {stem + "".join(draw.choice("abcdefgh") for _ in range(4)): draw.randint(1, 60)
              for _ in range(1500)}
    counts |= {stem[:i] + stem[i + 1:]: i + 1 for i in range(len(stem))} | {stem: 700}
    words = spark.createDataFrame(list(counts.items()), "word STRING, n LONG")
    assert got(spelling.variant_forms(words, group=64)) == plain_forms(counts)


def test_forms_are_followed_to_the_last(spark):
    chain = {"aaaaaaa": 1, "aaaaaab": 10, "aaaaabb": 100, "aaaabbb": 1000, "aaabbbb": 10000}
    words = spark.createDataFrame(list(chain.items()), "word STRING, n LONG")
    rows = {r["word"]: r["root"] for r in spelling.variant_forms(words).collect()}
    assert set(rows.values()) == {"aaabbbb"}


def test_ties_go_to_the_least_word(spark):
    counts = {"wordxab": 1, "wordxac": 50, "wordxéb": 50, "wordxabs": 50}
    words = spark.createDataFrame(list(counts.items()), "word STRING, n LONG")
    assert got(spelling.variant_forms(words)) == plain_forms(counts)


TEXTS = ["Understand understand UNDERSTAND ünderstand", None, "", "short ones only", "¿Über-Straße? naïveté×÷",
         "understand " * 40, "ÀÉÿabcdĀefghijk", "understand " * 40, "x" * 20_000]


@pytest.mark.parametrize("every", [None, 2, 31])
def test_counts_are_those_of_a_plain_walk(spark, every, monkeypatch):
    docs = with_odd_columns(documents(spark, TEXTS * 3))
    want = plain_counts([(i, t) for i, t in enumerate(TEXTS * 3)], every)
    rows = spelling.word_counts(docs, typo_every=every).collect()
    assert {r["word"]: r["n"] for r in rows} == dict(want)


def test_long_texts_are_counted_alike(monkeypatch):
    import pyarrow as pa

    raw = pa.scalar("Understanding gives understanding; " * 50).as_buffer()
    whole = spelling._words(raw, "7", 2, 7)
    monkeypatch.setattr(spelling, "LONG_TEXT", 10)
    assert spelling._words(raw, "7", 2, 7) == whole


def test_repeated_rows_and_empty_tables(spark):
    docs = documents(spark, ["understand"] * 3)
    assert spelling.word_counts(docs.union(docs)).collect()[0]["n"] == 6
    none = spelling.word_counts(docs.where("false"))
    assert none.count() == 0 and spelling.variant_forms(none).count() == 0
    nulls = spark.createDataFrame([(None, 3)], "word STRING, n LONG")
    assert spelling.variant_forms(nulls).count() == 0


def test_very_long_words(spark):
    base = "ab" * 30_000
    counts = {base: 90, base[:-1]: 3, base[1:] + "z": 2, "c" + base[1:]: 9}
    words = spark.createDataFrame(list(counts.items()), "word STRING, n LONG")
    assert got(spelling.variant_forms(words)) == plain_forms(counts)
