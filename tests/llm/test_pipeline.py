"""The whole pipeline against a plain version of each stage."""

from __future__ import annotations

import struct

import corpus_pipeline
import pytest
from test_line_dedup import plain as plain_lines
from test_mixing import plain as plain_copies
from test_near_dedup import plain_classes
from test_quality import plain as plain_quality

from stridelog.llm.quality import RepetitionRules
from stridelog.llm.queries import word_vocabulary

SF_DIR = "/root/testdata/sf0.001"
NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_are_those_asked_for():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "mixing", "bpe"]


def test_equals_plain_version(spark):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(word_vocabulary())
    docs = [tuple(r[n] for n in NAMES) for r in
            spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()]
    rules = RepetitionRules()
    docs = [d for d in docs if plain_quality(d[1], rules)["kept"]]
    lines = plain_lines([d[1] for d in docs], 10)
    docs = [(d[0], kept, d[2], d[3], len(kept)) for d, (_, _, kept) in zip(docs, lines)]
    classes = plain_classes([d[1] for d in docs])
    docs = [d for i, d in enumerate(docs) if classes[i] == i]
    by_id = {d[0]: d for d in docs}
    want = []
    for i, _ in plain_copies([(d[0], d[1], d[3]) for d in docs]):
        ids = library.encode(by_id[i][1], add_special_tokens=False).ids
        want.append((i, by_id[i][3], len(ids), struct.pack(f"<{len(ids)}I", *ids)))
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    got = [(r["doc_id"], r["source"], r["n_tokens"], bytes(r["ids"])) for r in rows]
    assert sorted(got) == sorted(want)


def test_stages_take_odd_tables(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0),
            (2, "word " * 60, None, None, 300),
            (3, " ".join(f"w{i}" for i in range(80)), "en", "s", None)]
    schema = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
    for table in (rows, rows[:0]):
        docs = spark.createDataFrame(table, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_DIR)
            if name != "bpe":
                assert out.columns == docs.columns
            assert out.count() <= max(len(table), 2 * len(table))
