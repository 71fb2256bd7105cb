from __future__ import annotations

import hashlib
import struct
import time
from random import Random

import pytest
from helpers import documents, some_texts, with_odd_columns
from hypothesis import given, settings
from hypothesis import strategies as st

from stridelog.llm import bpe
from stridelog.llm.queries import word_vocabulary

tokenizers = pytest.importorskip("tokenizers")
PATH = word_vocabulary()
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
ENCODER = bpe.Encoder(bpe.read_vocabulary(PATH))


def same(texts):
    for text, packed in zip(texts, ENCODER.encode([t.encode() for t in texts])):
        want = LIBRARY.encode(text, add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == want, repr(text)
        assert ENCODER.decode(packed).decode() == LIBRARY.decode(want, skip_special_tokens=False)


ODD = ["", " ", "It's I'LL don't", "a1b22!!??", "<|endoftext|>x<|startoftext|> y<|endoftext|>",
       "<|ENDOFTEXT|>", "Σίσυφος ΣΑΣ", "é ́x", "İstanbul ẞ", "日本 😀😀", "\x1c\x1dx\x85y",
       "</w> <//w>>a</w>", "½²Ⅷ", "a" * 500, "!" * 300, "the" * 100, "x y　z"]


def test_odd_texts_match_the_library():
    same(ODD)
    same(some_texts(1, 40))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=0x2FF, exclude_categories=["Cs"]), max_size=40),
                max_size=4))
def test_any_text_matches_the_library(texts):
    same(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(sorted(ENCODER.bpe.vocab)), max_size=6))
def test_joined_tokens_match_the_library(tokens):
    same(["".join(t.replace("</w>", "") for t in tokens)])


@pytest.mark.parametrize("size", [5_000, 200_000])
def test_long_unbroken_words_match_the_library(size):
    random = Random(size)
    start = time.process_time()
    same(["".join(random.choices("etaoinshr", k=size)), "ab" * (size // 2), "é" * (size // 4)])
    assert time.process_time() - start < 60


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_WORDS", 3)
    monkeypatch.setattr(bpe, "MAX_PAIRS", 5)
    small = bpe.Encoder(ENCODER.bpe)
    for text in [*ODD, *some_texts(2, 20)]:
        assert small.encode([text.encode()]) == ENCODER.encode([text.encode()])


def test_in_spark_with_nulls_repeats_and_odd_columns(spark):
    texts = [None, "", *ODD, "Hello world " * 3000]
    docs = with_odd_columns(documents(spark, texts))
    out = bpe.encode_decode(docs.union(docs), PATH)
    assert set(out.columns) == (set(docs.columns) - {"text"})
    rows = out.collect()
    assert len(rows) == 2 * len(texts)
    for row in rows:
        want = LIBRARY.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        assert row["ids"] == struct.pack(f"<{len(want)}I", *want)
        assert row["decoded"] == LIBRARY.decode(want, skip_special_tokens=False)
    assert bpe.encode_decode(docs.where("false"), PATH).count() == 0


def test_query_digests(spark):
    from stridelog.llm.queries import op10_bpe_round_trip

    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for row in op10_bpe_round_trip(spark, sf_dir).collect():
        ids = LIBRARY.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
