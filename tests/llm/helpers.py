"""Texts and plain versions that several tests share."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


def words(text):
    return WORD.findall(text or "")


def some_texts(seed: int, count: int, vocabulary: int = 400) -> list[str]:
    """Texts of random words in lines, some of them empty or very short."""
    draw = random.Random(seed)
    vocab = ["".join(draw.choice("abcdeéñß") for _ in range(draw.randint(1, 7)))
             for _ in range(vocabulary)]
    out = []
    for _ in range(count):
        lines = [" ".join(draw.choice(vocab) for _ in range(draw.randint(0, 25)))
                 for _ in range(draw.randint(0, 9))]
        out.append("\n".join(lines))
    return out


def documents(spark, texts, first: int = 0):
    rows = [(first + i, t, "en", f"src{i % 3}", None if t is None else len(t))
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def with_odd_columns(docs):
    """Columns with names that operators use inside or add."""
    from pyspark.sql import functions as F

    names = ("_h1 _d1 _row _text dropped pos key node label a p d1 at ids decoded kept _kept _n "
             "_rate _copy _place _u n_words samples h1 shard slot").split()
    return docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
