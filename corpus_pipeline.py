"""From raw documents to token ids: five stages, each over all rows that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelog.llm import bpe, line_dedup, mixing, near_dedup, quality
from stridelog.llm.common import prepare, table, written
from stridelog.llm.queries import word_vocabulary
from stridelog.session import configure

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _ready(spark: SparkSession) -> None:
    prepare(configure(spark))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    _ready(spark)
    return quality.drop_repetitive(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; a document may be left with an empty text."""
    _ready(spark)
    text = F.when(F.col("text").isNotNull(), F.col("_kept"))
    return line_dedup.with_kept_lines(docs).withColumns(
        {"text": text, "n_chars": F.length(text).cast("long")}).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one of least id."""
    _ready(spark)
    return near_dedup.keep_one_per_class(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat so that sources come near the square root of their sizes."""
    _ready(spark)
    return mixing.replicate(docs).select(*docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, as packed 32-bit integers, and a digest of their decoding."""
    _ready(spark)
    return bpe.encode_decode(docs, word_vocabulary(), keep=["doc_id", "source"]).select(
        "doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

# Sampling with floating-point draws and byte-pair merging are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next."""
    _ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
