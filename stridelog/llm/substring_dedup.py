"""Substring dedup: windows of 35 words that recur, found by phrases filed under anchor hashes.

The reference is the whole corpus. It is indexed in blocks, which are the hash partitions of its
phrases: wherever the smallest hash among the 8-word sequences of a 35-word window stays at one
place, its anchor, the words that these windows cover form a phrase. Equal windows have equal
anchors, so a window can only recur in the block that holds its anchor, and asking that block is
asking them all.

No Lempel-Ziv parse takes place: no factor is formed or extended. Phrases that recur whole are
duplicate spans by equal hashes. Where a phrase's anchor recurs in other surroundings, each window
is looked up by itself among the windows of the phrases with the same anchor.

Only hashes are exchanged until the spans of each document are known.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelog.llm.common import BROADCAST_ROWS, hash128, written
from stridelog.llm.textbatch import NGrams, TextBatch, batches, mix

WINDOW = 35
ANCHOR = 8

_DOC = ["d1", "d2"]
_LOW = np.uint64(0xFFFFFFFF)


def _anchors(grams: NGrams, window: int, anchor: int) -> np.ndarray:
    """For each window start the place of its anchor: the least hash, the leftmost of equals."""
    width = window - anchor + 1
    least = (grams.all(anchor) & ~_LOW) | np.arange(
        max(grams.size - anchor + 1, 0), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    return (least & _LOW).astype(np.int64)


def _phrases(batch: TextBatch, window: int, anchor: int) -> dict[str, np.ndarray]:
    """Anchor hash, phrase hash, text, first window (as a word of the text) and windows."""
    words = batch.word_hash()
    none = np.zeros(0, dtype=np.int64)
    if len(words) < window:
        return {"a": none, "p": none, "row": none, "first": none, "windows": none}
    grams, row = NGrams(words), batch.row_of_word()
    starts = np.arange(len(words) - window + 1)
    starts = starts[row[starts] == row[starts + window - 1]]
    place = _anchors(grams, window, anchor)[starts]
    opens = np.ones(len(starts), dtype=bool)
    opens[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(opens)
    first, place = starts[at], place[at]
    windows = np.diff(np.append(at, len(starts)))
    whole = grams.between(first, first + windows + window - 1)
    return {
        "a": grams.between(place, place + anchor).view(np.int64),
        "p": mix(whole ^ (place - first).astype(np.uint64)).view(np.int64),
        "row": row[first], "first": first - batch.word_bounds[row[first]], "windows": windows,
    }


def _phrase_table(keyed: DataFrame, window: int, anchor: int) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            docs = [c.to_numpy() for c in part.columns[:2]]
            for start, _, batch in batches(part.column(2)):
                found = _phrases(batch, window, anchor)
                row = found["row"] + start
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (found["a"], found["p"], docs[0][row], docs[1][row],
                                           found["first"] << 8 | found["windows"])],
                    ["a", "p", *_DOC, "at"])

    return keyed.select(*_DOC, "text").mapInArrow(
        run, "a LONG, p LONG, d1 LONG, d2 LONG, at LONG")


def _index(phrases: DataFrame) -> DataFrame:
    """Phrases with a recurring anchor: ``whole`` if they recur themselves, and whether their
    windows must be looked at (``open``): those of a single phrase, in every document; those of
    a recurring one that has single ones beside it, in one document (``rep``)."""
    kinds = phrases.groupBy("a", "p").agg(
        F.count(F.lit(1)).alias("n"), F.min("d1").alias("rep"))
    # Asking for ``rep`` here too lets both uses of ``kinds`` read one exchange.
    anchors = kinds.groupBy("a").agg(
        F.count("rep").alias("kinds"), F.sum("n").alias("all"), F.min("n").alias("least"))
    return kinds.join(anchors.where("all > 1"), "a").select(
        "a", "p", "rep", (F.col("n") > 1).alias("whole"),
        ((F.col("kinds") > 1) & (F.col("least") == 1)).alias("open"))


def _flags(phrases: DataFrame, index: DataFrame) -> DataFrame:
    """Per document the phrases of the index: place, windows and the bits whole and open.

    Rows equal in id and text are one document, and sets take their places once."""
    opened = F.col("open") & (~F.col("whole") | (F.col("rep") == F.col("d1")))
    bits = F.when(F.col("whole"), 2).otherwise(0) + F.when(opened, 1).otherwise(0)
    return phrases.join(index, ["a", "p"]).where(F.col("whole") | opened).select(
        *_DOC, (F.shiftleft("at", 2) + bits).alias("flag")
    ).groupBy(*_DOC).agg(
        F.collect_set("flag").alias("flags"), F.max(F.col("flag") % 2).alias("open"))


def _window_table(opened: DataFrame, window: int) -> DataFrame:
    """128-bit hashes of the windows of open phrases, with document and place."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            docs = [c.to_numpy() for c in part.columns[:2]]
            lists = part.column(3)
            for start, end, batch in batches(part.column(2)):
                words = batch.word_hash()
                flags = lists.slice(start, end - start)
                row = np.repeat(np.arange(end - start), flags.value_lengths().to_numpy())
                flag = flags.flatten().to_numpy()
                row, flag = row[flag & 1 == 1], flag[flag & 1 == 1]
                count = flag >> 2 & 255
                place = np.repeat(flag >> 10, count) + _ranks(count)
                row = np.repeat(row, count)
                at = place + batch.word_bounds[row]
                two = [NGrams(w).between(at, at + window).view(np.int64)
                       for w in (words, mix(words + np.uint64(1)))]
                row += start
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (*two, docs[0][row], docs[1][row], place)],
                    ["w1", "w2", *_DOC, "place"])

    return opened.select(*_DOC, "text", "flags").mapInArrow(
        run, "w1 LONG, w2 LONG, d1 LONG, d2 LONG, place LONG")


def _ranks(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of several runs."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def _covered(size: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    steps = np.zeros(size + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:-1]) > 0


def _cut_texts(docs: DataFrame, id_col: str, window: int) -> DataFrame:
    """Drop the words of ``spans`` (null: none) from each text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts, spans = part.column(1), part.column(2)
            for start, end, batch in batches(texts):
                sizes, removed, kept = np.diff(batch.word_bounds), [], []
                for i in range(end - start):
                    words = batch.text(i).split()
                    found = spans[start + i].values
                    if found is not None and len(found):
                        span = found.to_numpy()
                        gone = _covered(len(words), span >> 8, (span & 255) + window - 1)
                        removed.append(int(gone.sum()))
                        words = compress(words, (~gone).tolist())
                    else:
                        removed.append(0)
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(start, end - start), pa.array(sizes),
                     pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    [id_col, "n_words", "n_removed", "kept"])

    return docs.select(id_col, "text", "spans").mapInArrow(
        run, f"`{id_col}` {id_type}, n_words LONG, n_removed LONG, kept STRING")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id and text with a 128-bit key of both: rows equal in both have the same spans."""
    d1, d2 = hash128(F.col(id_col), F.col(text_col))
    return docs.select(F.col(id_col), F.col(text_col).alias("text"), d1.alias("d1"), d2.alias("d2"))


def _spans_of(flags: Column, hits: Column) -> Column:
    """Spans as place and windows in one number: whole phrases, and single windows."""
    whole = F.filter(flags, lambda f: f.bitwiseAND(F.lit(2)) == 2)
    whole = F.transform(whole, lambda f: F.shiftright(f, 2))
    return F.concat(F.coalesce(whole, F.array().cast("array<bigint>")),
                    F.coalesce(hits, F.array().cast("array<bigint>")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Per row of ``docs``: id, ``n_words``, ``n_removed`` and ``kept``, the words left.

    A word goes if it lies in a window of ``window`` words whose sequence starts at another
    place too, in the same document or any other; all copies go, the first one included, and
    windows are judged on the texts as given. Kept words are joined by one space. A null or
    empty text has no words. Repeated rows are copies of each other. ``window`` is at most
    255 + ``anchor``. A text is held whole, with some sixty bytes of arrays per byte.
    """
    keyed = _keyed(docs, id_col, text_col)
    phrases = _phrase_table(keyed, window, anchor)
    index = written(_index(phrases), "index")
    flags = written(_flags(phrases, index), "flags")

    opened = _with_lists(keyed, flags.where("open = 1").select(*_DOC, "flags"))
    windows = written(_window_table(opened, window), "windows")
    repeated = written(windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"))
                       .where("n > 1").select("w1", "w2"), "repeated")
    hits = windows.join(repeated, ["w1", "w2"]).groupBy(*_DOC).agg(
        F.collect_set(F.shiftleft("place", 8) + 1).alias("hits"))
    spans = written(
        flags.join(hits, _DOC, "left")
        .select(*_DOC, _spans_of(F.col("flags"), F.col("hits")).alias("spans"))
        .where(F.size("spans") > 0), "spans")

    # Texts without spans need no exchange, if a list of the others is small enough to tell.
    if spans.count() <= BROADCAST_ROWS:
        keys = F.broadcast(spans.select(*_DOC))
        plain = keyed.join(keys, _DOC, "left_anti").withColumn(
            "spans", F.lit(None).cast("array<bigint>"))
        marked = keyed.join(keys, _DOC, "left_semi").join(spans, _DOC)
        return _cut_texts(plain.select(id_col, "text", "spans").union(
            marked.select(id_col, "text", "spans")), id_col, window)
    return _cut_texts(keyed.join(spans, _DOC, "left"), id_col, window)


def _with_lists(keyed: DataFrame, lists: DataFrame) -> DataFrame:
    """Documents with a list each; if few have one, only their texts are exchanged."""
    if lists.count() <= BROADCAST_ROWS:
        keyed = keyed.join(F.broadcast(lists.select(*_DOC)), _DOC, "left_semi")
    return keyed.join(lists, _DOC)
