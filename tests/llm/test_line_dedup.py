from __future__ import annotations

import collections
import random

from helpers import documents, some_texts, with_odd_columns
from pyspark.sql import functions as F

from stridelog.llm.line_dedup import drop_bitmaps, with_kept_lines

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(SPACES).translate(LOWER)


def plain(texts, min_docs, min_chars=1):
    found = collections.Counter()
    for text in texts:
        found.update({key(line) for line in (text or "").split("\n")})
    gone = {k for k, n in found.items() if n >= min_docs and len(k) >= min_chars}
    out = []
    for text in texts:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in gone]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def odd_texts():
    draw, common = random.Random(7), ["Ähnlich IST das", "  read More ", "\tx", "ÉCOLE", "école"]
    out = [None, "", "\n", "  \n\t", "read more", "READ MORE\x0b", " x", "x\n" * 500]
    for text in some_texts(8, 60):
        lines = text.split("\n") + draw.choices(common, k=draw.randint(0, 4))
        draw.shuffle(lines)
        out.append("\n".join(lines))
    return out


def test_equals_plain_version(spark):
    texts = odd_texts()
    for min_docs, min_chars in ((2, 1), (5, 1), (5, 4), (1000, 1)):
        rows = with_kept_lines(documents(spark, texts), min_docs=min_docs,
                               min_chars=min_chars).collect()
        got = {r["doc_id"]: (r["_n_lines"], r["_n_dropped"], r["_kept"]) for r in rows}
        assert got == dict(enumerate(plain(texts, min_docs, min_chars)))


def test_a_line_in_every_document(spark):
    texts = [f"same line\nown {i}" for i in range(300)]
    docs = documents(spark, texts)
    assert {r["_kept"] for r in with_kept_lines(docs).collect()} == {f"own {i}" for i in range(300)}
    bits = drop_bitmaps(docs).collect()
    assert len(bits) == 300 and all(r["dropped"] == {0: 1} for r in bits)


def test_long_text_uses_many_bitmap_words(spark):
    texts = ["\n".join(f"l{j}" if j % 2 else f"{i} {j}" for j in range(1000)) for i in range(10)]
    rows = with_kept_lines(documents(spark, texts)).collect()
    assert all(r["_n_dropped"] == 500 and r["_n_lines"] == 1000 for r in rows)
    assert all("l1" not in r["_kept"].split("\n") for r in rows)


def test_nulls_repeats_odd_columns_and_empty_tables(spark):
    docs = documents(spark, ["a\nb", None, "a\nb"])
    nulls = docs.withColumn("doc_id", F.lit(None).cast("long"))
    rows = with_kept_lines(nulls.union(nulls), min_docs=2).collect()
    assert sorted(r["_n_dropped"] for r in rows) == [0, 0, 0, 0, 0, 0]  # one document by content
    rows = with_kept_lines(docs.union(docs), min_docs=2).collect()
    assert sorted(r["_n_dropped"] for r in rows) == [0, 0, 2, 2, 2, 2]
    odd = with_odd_columns(docs)
    out = with_kept_lines(odd, min_docs=2)
    assert set(out.columns) == set(odd.columns) | {"_n_lines", "_n_dropped"}
    assert sorted(r["_kept"] for r in out.collect()) == ["", "", ""]
    assert with_kept_lines(docs.where("false")).count() == 0
