"""Line dedup over a corpus: hashes of lines go through Spark, texts come back only at the end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelog.llm.common import hash128, text_of

SPACES = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY, _DOC = ["_h1", "_h2"], ["_d1", "_d2"]
WORD = 64    # lines per word of a bitmap
PIECES = 32  # parts in which the lines of one key are joined


def line_key(line: Column) -> Column:
    """The line without outer ASCII white space and with A-Z in lower case."""
    bare = F.btrim(line, F.lit(SPACES))
    ascii_only = F.length(bare) == F.octet_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _doc_key(id_col: str, text_col: str) -> list[Column]:
    """A document is known by id and text, so null or repeated ids mix nothing up."""
    hashes = hash128(F.col(id_col), F.col(text_col))
    return [h.alias(name) for h, name in zip(hashes, _DOC)]


def drop_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Which lines go, as bitmaps: a row for each document that loses lines.

    A line goes if its key has at least ``min_chars`` code points and stands in at least
    ``min_docs`` documents (rows; rows equal in id and text count once). Columns ``_d1``
    and ``_d2`` identify the document, ``dropped`` maps the number of a word of 64 lines to
    its bits. Words without a dropped line are left out: all their lines are kept.

    Hashes are range-partitioned by key, document and position and sorted in that order, so a
    key that stands in a third of all documents covers many partitions. There the first
    occurrence of a key in each document is read off as the rows stream by, and the
    occurrences are added up per key. All exchanges carry hashes and positions only.
    """
    lines = docs.select(
        *_doc_key(id_col, text_col),
        F.posexplode(F.transform(F.split(text_of(text_col), "\n", -1), line_key)),
    ).where(F.length("col") >= min_chars)
    h1, h2 = hash128(F.col("col"))
    order = [*_KEY, *_DOC]
    ranged = (
        lines.select(h1.alias("_h1"), h2.alias("_h2"), *_DOC, "pos")
        .repartitionByRange(*order).sortWithinPartitions(*order, "pos")
    )
    # Rows of one key and document share a range, so this grouping needs no exchange.
    firsts = ranged.groupBy(*order).agg(F.min("pos").alias("_first"))
    frequent = (
        firsts.groupBy(*_KEY).agg(F.count("_first").alias("_docs"))
        .where(F.col("_docs") >= min_docs).select(*_KEY)
    )
    # A frequent key meets its lines in pieces, as its lines may be a third of all. The piece is
    # taken in the join itself, so that both uses of ``ranged`` have the same columns and share
    # one exchange.
    pieces = F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))).alias("_piece")
    cut = frequent.select(F.col("_h1").alias("_f1"), F.col("_h2").alias("_f2"), pieces)
    words = (
        ranged.join(cut, (F.col("_h1") == F.col("_f1")) & (F.col("_h2") == F.col("_f2"))
                    & (F.pmod("_d1", F.lit(PIECES)) == F.col("_piece")))
        .groupBy(*_DOC, F.floor(F.col("pos") / WORD).cast("int").alias("_word"))
        .agg(F.bit_or(_shift("shiftleft", F.lit(1).cast("long"), F.col("pos") % WORD)).alias("_bits"))
    )
    return words.groupBy(*_DOC).agg(
        F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("dropped"))


def _shift(name: str, value: Column, by: Column) -> Column:
    return F.call_function(name, value, by.cast("int"))


def _is_dropped(i: Column) -> Column:
    bits = F.element_at("dropped", F.floor(i / WORD).cast("int"))
    return F.coalesce(_shift("shiftright", bits, i % WORD).bitwiseAND(F.lit(1)) == 1, F.lit(False))


def with_kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with ``_n_lines``, ``_n_dropped`` and ``_kept``, the text without dropped lines.

    A null or empty text is one empty line. All rows and columns of ``docs`` stay, but columns
    with the names of the added ones give way; repeated rows give repeated results. A document whose lines are all dropped keeps the empty text.
    """
    bitmaps = drop_bitmaps(docs, id_col, text_col, min_docs, min_chars)
    added = ("_n_lines", "_n_dropped", "_kept")
    others = F.struct(*[c for c in docs.columns if c not in added]).alias("_row")
    text, lines = F.col("_text"), F.split("_text", "\n", -1)
    n_dropped = F.aggregate(
        F.map_values("dropped"), F.lit(0), lambda n, bits: n + F.bit_count(bits))
    kept = F.array_join(F.filter(lines, lambda _, i: ~_is_dropped(i)), "\n")
    return (
        docs.select(others, text_of(text_col).alias("_text"), *_doc_key(id_col, text_col))
        .join(bitmaps, _DOC, "left")
        .select(
            "_row",
            F.size(lines).cast("long").alias("_n_lines"),
            F.coalesce(n_dropped, F.lit(0)).cast("long").alias("_n_dropped"),
            F.when(F.col("dropped").isNull(), text).otherwise(kept).alias("_kept"),
        )
        .select("_row.*", *added)
    )
