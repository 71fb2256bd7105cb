"""Benchmark decontamination: verbatim passages of test items, found in suffix arrays.

The documents are cut into shards, one per batch of texts, and each shard gets a suffix array over
its words. Every suffix of every test item is binary-searched in it, word by word: the suffixes of
the shard that share the first words are a range of the array, which the next word narrows until
it is empty. So each test suffix ends with its longest verbatim match and the range of its
locations. Where it is at least as long as a window, the words at these locations are hit.

A window is ``WINDOW`` consecutive words of an item; a shorter item is one window. Words are runs of
letters, digits and non-ASCII characters, with A-Z in lower case, and are compared by 64-bit hashes.

The test items are searched in blocks of at most some ``BLOCK_WORDS`` words, so that what is sent to
the workers is bounded. A document is never cut and every block sees all documents, so nothing has
to be brought together by a shuffle. Words that no item of the block has cannot begin a match and
are left out of the array.

Null and empty texts have no words; they match nothing and stay as they are. Repeated rows, of
either table, are judged each for itself; items that share windows are all found. An item without
an id is looked for like any other but is not listed. Other columns of the documents stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelog.llm.common import text_of, written
from stridelog.llm.textbatch import TextBatch, batches

WINDOW = 10

# Words of test items searched at once, and words of an item that are kept in one piece.
BLOCK_WORDS = 1 << 20
PIECE_WORDS = 1 << 16

# Bytes of text that share a suffix array; a longer text has one of its own.
SHARD_BYTES = 1 << 21

_BYTES = np.arange(256)
SEPARATORS = ~(((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
               | (_BYTES >= 0x80))
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

REPORT = "_n_words LONG, _spans ARRAY<LONG>, _items ARRAY<STRING>, _longest LONG"


def suffix_array(words: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The places ``starts`` in the order of the words from there on, up to ``depth`` words.

    ``words`` are numbers from 1, or 0 where no match can go on. Prefixes of doubling length are
    ranked by pairs of ranks of half their length.
    """
    rank = words.astype(np.int64)
    length = 1
    while length < depth:
        beyond = np.zeros(len(rank), dtype=np.int64)
        beyond[:-length] = rank[length:] if length < len(rank) else 0
        pair = rank * (int(rank.max(initial=0)) + 1) + beyond
        pair[rank == 0] = 0
        _, again = np.unique(pair[starts], return_inverse=True)
        rank = np.zeros(len(rank), dtype=np.int64)
        rank[starts] = again + 1
        length *= 2
        if len(again) == 0 or again.max() + 1 == len(starts):
            break
    return starts[np.argsort(rank[starts], kind="stable")]


def _narrow(keys: np.ndarray, low: np.ndarray, high: np.ndarray, word: np.ndarray,
            right: bool) -> np.ndarray:
    """Per range [low, high) of ascending ``keys`` the first place not less than (``right``: the
    first greater than) ``word``; all ranges are halved together."""
    low, high = low.copy(), high.copy()
    open_ = low < high
    while open_.any():
        middle = (low + high) // 2
        key = keys[np.minimum(middle, len(keys) - 1)]
        go_right = open_ & ((key <= word) if right else (key < word))
        low = np.where(go_right, middle + 1, low)
        high = np.where(open_ & ~go_right, middle, high)
        open_ = low < high
    return low


def longest_matches(words: np.ndarray, order: np.ndarray, tests: np.ndarray, left: np.ndarray,
                    windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Binary search of test suffixes in a suffix array.

    ``tests`` are the words of all items and ``left`` how many words of its piece each has from
    there on. Returns per test suffix the length of its longest match, and the range of the array
    that shares its first ``windows`` words (empty if the match is shorter).
    """
    padded = np.append(words, np.zeros(int(left.max(initial=0)) + 1, dtype=words.dtype))
    low = np.zeros(len(tests), dtype=np.int64)
    high = np.full(len(tests), len(order), dtype=np.int64)
    longest = np.zeros(len(tests), dtype=np.int64)
    first, last = np.zeros_like(low), np.zeros_like(low)
    active, depth = np.arange(len(tests)), 0
    while len(active) and len(order):
        keys, word = padded[order + depth], tests[active + depth]
        begin = _narrow(keys, low[active], high[active], word, right=False)
        end = _narrow(keys, begin, high[active], word, right=True)
        found = begin < end
        active, depth = active[found], depth + 1
        low[active], high[active] = begin[found], end[found]
        longest[active] = depth
        full = active[windows[active] == depth]
        first[full], last[full] = low[full], high[full]
        active = active[left[active] > depth]
    return longest, first, last


@dataclass(frozen=True)
class Block:
    """Test items as numbered words, one after the other."""

    vocabulary: np.ndarray  # ascending word hashes; a word's number is its place plus one
    words: np.ndarray
    left: np.ndarray  # words of the item's piece from this word on
    windows: np.ndarray  # the window from this word on, 0 if none begins here
    items: np.ndarray  # the item of this word as a place in ``names``, -1 if it has no id
    names: list[str]


def _pieces(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """Word hashes of the items; long items in pieces that share the windows across their ends."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start, end, batch in batches(part.column(1), SHARD_BYTES, SEPARATORS, LOWER):
                hashes = batch.word_hash().view(np.int64)
                for row in range(end - start):
                    low, high = batch.word_bounds[row:row + 2]
                    for at in range(low, high, PIECE_WORDS):
                        stop = min(at + PIECE_WORDS + WINDOW - 1, high)
                        if at > low and stop - at < WINDOW:
                            continue  # all its windows are in the piece before
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).slice(start + row, 1),
                             pa.array([int(high - low)]), pa.array([hashes[at:stop]])],
                            ["item", "size", "words"])

    return benchmark.select(F.col(item_id).cast("string").alias("item"), text_of(text).alias("t")
                            ).mapInArrow(run, "item STRING, size LONG, words ARRAY<LONG>")


def _blocks(pieces: DataFrame, block_words: int) -> Iterator[Block]:
    """The pieces in blocks of about ``block_words`` words; one block reaches the driver at a time."""
    total = pieces.agg(F.sum(F.size("words")).alias("n")).first()["n"] or 0
    count = max(-(-total // block_words), 1)
    number = F.pmod(F.xxhash64("item", "words"), F.lit(count))
    for b in range(count):
        rows = pieces.where(number == b).orderBy("item").collect()
        hashes = [np.array(r["words"], dtype=np.int64) for r in rows]
        sizes = np.array([len(h) for h in hashes], dtype=np.int64)
        joined = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.int64)
        vocabulary, words = np.unique(joined, return_inverse=True)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(joined))
        window = np.repeat(np.array([min(r["size"], WINDOW) for r in rows], dtype=np.int64), sizes)
        names = sorted({r["item"] for r in rows} - {None})
        places = {name: i for i, name in enumerate(names)} | {None: -1}
        ids = np.array([places[r["item"]] for r in rows], dtype=np.int64)
        yield Block(vocabulary, words + 1, left, np.where(left >= window, window, 0),
                    np.repeat(ids, sizes), names)


def _hits(batch: TextBatch, block: Block) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Of a shard: which words are hit, the items of each text, and its longest match."""
    hashes, vocabulary = batch.word_hash().view(np.int64), block.vocabulary
    n, rows = len(hashes), batch.rows
    hit, items = np.zeros(n + 1, dtype=np.int64), [np.zeros(0, dtype=np.int64)] * rows
    longest = np.zeros(rows, dtype=np.int64)
    if n == 0 or len(vocabulary) == 0:
        return hit[:n] > 0, items, longest
    place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = vocabulary[place] == hashes
    # A word without a number after each text keeps matches within it.
    row = batch.row_of_word()
    at = np.arange(n) + row
    words = np.zeros(n + rows, dtype=np.int64)
    words[at] = np.where(known, place + 1, 0)
    order = suffix_array(words, at[known], int(block.left.max()))
    length, first, last = longest_matches(words, order, block.words, block.left, block.windows)

    texts = row[np.searchsorted(at, order)]
    found = np.flatnonzero((last > first) & (block.windows > 0))
    for width in np.unique(block.windows[found]):
        # Ranges of one width are equal or apart, so marks on the array tell the locations.
        same = found[block.windows[found] == width]
        marks = np.zeros(len(order) + 1, dtype=np.int64)
        np.add.at(marks, np.unique(first[same]), 1)
        np.add.at(marks, np.unique(last[same]), -1)
        word = order[np.cumsum(marks[:-1]) > 0]
        word = word - row[np.searchsorted(at, word)]
        np.add.at(hit, word, 1)
        np.add.at(hit, word + width, -1)
    # Texts of a range, then the items of the ranges of a text, one text at a time.
    ranges = np.unique(np.stack([first[found], last[found]], axis=1), axis=0)
    of_range = {tuple(r): i for i, r in enumerate(ranges.tolist())}
    by_range: list[list[int]] = [[] for _ in ranges]
    for i in found:
        by_range[of_range[first[i], last[i]]].append(i)
    by_text: dict[int, list[int]] = {}
    for i, (low, high) in enumerate(ranges.tolist()):
        for t in np.unique(texts[low:high]).tolist():
            by_text.setdefault(t, []).append(i)
    best = [int(length[b].max()) for b in by_range]
    listed = [np.unique(block.items[b]) for b in by_range]
    for t, its in by_text.items():
        items[t] = np.unique(np.concatenate([listed[i] for i in its]))
        longest[t] = max(best[i] for i in its)
    return np.cumsum(hit[:n]) > 0, items, longest


def _spans(marked: np.ndarray) -> np.ndarray:
    """Begin and end, alternating, of the runs of marked places."""
    return np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))


def _search(docs: DataFrame, block: Block) -> DataFrame:
    """Merge what ``block`` finds into the report columns; ``docs`` is ``_kept, _text`` and those."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start, end, batch in batches(part.column(1), SHARD_BYTES, SEPARATORS, LOWER):
                hit, items, longest = _hits(batch, shared.value)
                spans, lists, deepest = [], [], []
                for row in range(end - start):
                    low, high = batch.word_bounds[row:row + 2]
                    before = part.column(3)[start + row].as_py() or []
                    marked = hit[low:high]
                    for a, b in zip(before[::2], before[1::2]):
                        marked[a:b] = True
                    spans.append(_spans(marked) if len(marked) else np.zeros(0, dtype=np.int64))
                    known = set(part.column(4)[start + row].as_py() or [])
                    names = [shared.value.names[i] for i in items[row] if i >= 0]
                    lists.append(sorted(known.union(names)))
                    deepest.append(max(int(longest[row]), part.column(5)[start + row].as_py() or 0))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(start, end - start),
                     part.column(1).slice(start, end - start),
                     pa.array(np.diff(batch.word_bounds)),
                     pa.array(spans, type=pa.list_(pa.int64())),
                     pa.array(lists, type=pa.list_(pa.string())), pa.array(deepest)],
                    ["_kept", "_text", "_n_words", "_spans", "_items", "_longest"])

    kept = docs.schema["_kept"].dataType.simpleString()
    return docs.mapInArrow(run, f"_kept {kept}, _text STRING, {REPORT}")


def contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None,
                  text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """All documents with their words (``_n_words``), the runs of words that items hit (``_spans``:
    begin and end, alternating), the items found (``_items``, as strings in order) and the length of the
    longest verbatim match of an item that was found (``_longest``).

    ``keep`` names the columns to keep (default: all).
    """
    pieces = written(_pieces(benchmark, item_id, item_text), "test-items")
    kept = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)])
    none = F.lit(None).cast("array<long>")
    rows = docs.select(kept.alias("_kept"), text_of(text).alias("_text"),
                       F.lit(0).cast("long").alias("_n_words"), none.alias("_spans"),
                       none.alias("_items"), F.lit(0).cast("long").alias("_longest"))
    for i, block in enumerate(_blocks(pieces, block_words)):
        if i:
            rows = written(rows, "contamination")
        rows = _search(rows, block)
    columns = docs.columns if keep is None else keep
    return rows.select(*[F.col("_kept")[c].alias(c) for c in columns],
                       *[c.split()[0] for c in REPORT.split(", ")])


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a single hit, with all their columns."""
    clean = contamination(docs, benchmark, **options).where(F.size("_spans") == 0)
    return clean.drop(*[c.split()[0] for c in REPORT.split(", ")])


def n_hit() -> Column:
    """Number of hit words, from ``_spans``."""
    return F.aggregate(F.transform("_spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
                       F.lit(0).cast("long"), lambda a, b: a + b)
