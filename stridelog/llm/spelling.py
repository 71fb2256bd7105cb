"""Spelling variants: words one edit away from a far commoner word, found by dense tiling.

Two words are near if exactly one inserted, deleted or replaced code point parts them. With words
as rows of a padded matrix of code points, and again of one that is padded on the left, the common
prefix and suffix of two words are counted by comparing rows; they are near if both together reach
the length of the longer word minus one.

Not every word is compared with every other. A near pair shares a prefix of half that length or
else a suffix of the rest, so words are filed under both, apart for pairs of equal lengths and for
pairs whose lengths differ by one. Groups of over ``GROUP`` words are filed anew: the part in which
the edit may lie is halved once more, until groups are small. This loses nothing and finds no pair
twice, and ends because words that agree in all but one place are at most as many as there are
letters. A group is then compared in tiles: all its rows against those a fixed distance below.

What is counted per word is added up within a task before it is exchanged.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelog.llm.common import text_of, written

LEAST_LENGTH = 7
FACTOR = 10

# Words per group, bytes of a tile's matrices, entries of a word count before it is passed on.
GROUP = 512
TILE_BYTES = 1 << 23
COUNTED = 200_000

# Text longer than this is gone through run by run instead of listing its runs.
LONG_TEXT = 1 << 22

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def word_counts(docs: DataFrame, typo_every: int | None = None, least: int = LEAST_LENGTH,
                doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n``, its occurrences, over the maximal letter runs of all texts, with A-Z in
    lower case; only words of at least ``least`` code points.

    ``typo_every`` plants typing errors: where it divides h, the unsigned crc32 of
    ``<doc_id>:<run>``, the run's code point h % length goes first. A null id is written "null".
    Null texts have no words. Repeated rows count as often as they are there.
    """
    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for part in parts:
            for name, value in zip(part.column(0), part.column(1)):
                total.update(_words(value.as_buffer(), name.as_py(), typo_every, least))
                if len(total) > COUNTED:
                    yield _count_batch(total)
                    total.clear()
        yield _count_batch(total)

    source = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).alias("id"),
                         text_of(text).alias("text"))
    return source.mapInArrow(counted, "word STRING, n LONG").groupBy("word").agg(
        F.sum("n").alias("n"))


def _words(raw: pa.Buffer, name: str, typo_every: int | None, least: int) -> dict[str, int]:
    lowered = raw.to_pybytes().lower().decode()  # of bytes, lower() changes A-Z only
    if len(lowered) > LONG_TEXT:
        runs = Counter(m.group() for m in _RUN.finditer(lowered))
    else:
        runs = Counter(_RUN.findall(lowered))
    if typo_every is None:
        return {w: n for w, n in runs.items() if len(w) >= least}
    start, out = zlib.crc32(f"{name}:".encode()), {}
    for word, n in runs.items():
        if len(word) < least:
            continue  # a code point less makes it shorter still
        h = zlib.crc32(word.encode(), start)
        if h % typo_every == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
            if len(word) < least:
                continue
        out[word] = out.get(word, 0) + n
    return out


def _count_batch(total: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])


def _filed(words: DataFrame) -> DataFrame:
    """Every word under its first six keys.

    ``need`` is the length of the longer word of a pair minus one, and ``step`` the difference of
    the lengths. A group holds pairs that share the first ``p`` and the last ``q`` code points and
    whose common prefix is shorter than ``below``; prefix and suffix must reach ``need``.
    """
    size = F.length("word")
    need = F.array(*[F.struct(n.alias("need"), F.lit(step).alias("step"))
                     for n, step in ((size - 1, 0), (size - 1, 1), (size, 1))])
    whole = words.select("word", "n", F.explode(need).alias("_at")).select(
        "word", "n", "_at.*", F.lit(0).alias("p"), F.lit(0).alias("q"),
        (F.col("_at.need") + 1).alias("below"))
    return _halved(whole)


def _halved(rows: DataFrame) -> DataFrame:
    """File every row under two narrower keys: the common prefix reaches the middle of the part
    still open, or it does not and the suffix has to make up for it."""
    middle = F.ceil((F.col("p") + F.col("below")) / 2).cast("int")
    far = F.struct(middle.alias("p"), F.col("q").alias("q"), F.col("below").alias("below"))
    near = F.struct(F.col("p").alias("p"),
                    F.greatest("q", F.col("need") - middle + 1).alias("q"), middle.alias("below"))
    return rows.select("word", "n", "need", "step", F.explode(F.array(far, near)).alias("_to")
                       ).select("word", "n", "need", "step", "_to.*")


def _keyed(rows: DataFrame) -> DataFrame:
    """Add the 128-bit key of each row's group. A prefix longer than the word makes no pair."""
    prefix, suffix = F.expr("left(word, p)"), F.expr("right(word, q)")
    parts = [F.col(c) for c in ("need", "step", "p", "q", "below")] + [prefix, suffix]
    fits = (F.greatest("p", "q") <= F.length("word")) & (F.col("below") > F.col("p"))
    return rows.where(fits).withColumns(
        {"k1": F.xxhash64(*parts), "k2": F.xxhash64(F.lit(1), *parts)})


def near_groups(words: DataFrame, group: int = GROUP) -> DataFrame:
    """The words in groups of at most ``group`` (or that cannot be cut), keyed ``k1, k2``."""
    done, rows = None, _filed(words)
    while True:
        keyed = written(_keyed(rows), "word-groups")
        sizes = keyed.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("size"))
        counted = written(keyed.join(sizes.where("size > 1"), ["k1", "k2"]), "word-groups")
        large = (F.col("size") > group) & (F.col("below") - F.col("p") > 1)
        small = counted.where(~large)
        done = small if done is None else done.unionByName(small)
        rest = counted.where(large)
        if rest.isEmpty():
            return done
        rows = _halved(rest.select("word", "n", "need", "step", "p", "q", "below"))


def _matrix(words: list[str], width: int, right: bool) -> np.ndarray:
    """Code points of the words, padded with 0 after or before them."""
    joined = "".join(w.rjust(width, "\0") if right else w.ljust(width, "\0") for w in words)
    return np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).reshape(len(words), width)


def _run_length(equal: np.ndarray) -> np.ndarray:
    """How many leading entries of each row are true."""
    return np.where(equal.all(axis=1), equal.shape[1], equal.argmin(axis=1))


def near_pairs(words: list[str], group: np.ndarray, step: np.ndarray,
               below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the near pairs within groups; rows of one group stand together.

    ``step`` is the difference of lengths that counts, and pairs must have a common prefix shorter
    than ``below``. Row i meets row i + s, for all rows at once, for every s below a group's size.
    """
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    width = int(sizes.max(initial=0)) + 1  # at least one place of padding ends every row
    ends = np.searchsorted(group, group, side="right")
    left, right = _matrix(words, width, False), _matrix(words, width, True)
    chunk = max(TILE_BYTES // (8 * width), 1)
    found_a, found_b = [], []
    for s in range(1, int((ends - np.arange(len(words))).max(initial=0))):
        rows = np.flatnonzero(np.arange(len(words)) + s < ends)
        rows = rows[np.abs(sizes[rows] - sizes[rows + s]) == step[rows]]
        for at in range(0, len(rows), chunk):
            a = rows[at:at + chunk]
            b = a + s
            shorter, longer = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
            prefix = np.minimum(_run_length(left[a] == left[b]), shorter)
            suffix = np.minimum(_run_length(right[a, ::-1] == right[b, ::-1]), shorter)
            near = (prefix + suffix >= longer - 1) & (prefix < below[a])
            near &= (prefix < shorter) | (step[a] == 1)  # not the word itself
            found_a.append(a[near])
            found_b.append(b[near])
    none = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(found_a or none), np.concatenate(found_b or none)


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """Per word with near words: ``n_near``, and the commonest of them (``best``; of equally common
    ones the least in code-point order) with its count ``best_n``. ``words`` are distinct."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, width = [], 0, 0
        for part in parts:
            held.append(part)
            rows, width = rows + part.num_rows, max(width, part.column("need").to_numpy().max())
            if rows * width * 8 > TILE_BYTES:  # the last group may go on in the next batch
                table = pa.Table.from_batches(held)
                cut = _last_group(table)
                yield from _near_rows(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
                rows, width = table.num_rows - cut, width if cut < table.num_rows else 0
        if held:
            yield from _near_rows(pa.Table.from_batches(held))

    groups = near_groups(words, group).select("k1", "k2", "word", "n", "need", "step", "below")
    # Words of one length stand together, so that a batch's matrices have little padding.
    placed = groups.repartition("k1", "k2").sortWithinPartitions("need", "k1", "k2")
    each = placed.mapInArrow(run, "word STRING, n_near LONG, best STRING, best_n LONG")
    return each.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min_by("best", F.struct(-F.col("best_n"), F.col("best"))).alias("best"),
        F.max("best_n").alias("best_n"))


def _last_group(rows: pa.Table) -> int:
    """The row at which the last group begins."""
    k1, k2 = rows.column("k1").to_numpy(), rows.column("k2").to_numpy()
    others = np.flatnonzero((k1 != k1[-1]) | (k2 != k2[-1]))
    return int(others[-1]) + 1 if len(others) else 0


def _near_rows(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    if rows.num_rows < 2:
        return
    k1, k2 = rows.column("k1").to_numpy(), rows.column("k2").to_numpy()
    words, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
    group = np.zeros(len(words), dtype=np.int64)
    np.cumsum((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]), out=group[1:])
    a, b = near_pairs(words, group, rows.column("step").to_numpy(), rows.column("below").to_numpy())
    if not len(a):
        return
    one, other = np.concatenate([a, b]), np.concatenate([b, a])
    rank = np.zeros(len(words), dtype=np.int64)  # by words, in code-point order
    rank[np.array(sorted(range(len(words)), key=words.__getitem__))] = np.arange(len(words))
    order = np.lexsort((rank[other], -n[other], one))
    one, other = one[order], other[order]
    at, counts = np.unique(one, return_index=True, return_counts=True)[1:]
    yield pa.RecordBatch.from_arrays(
        [pa.array([words[i] for i in one[at]]), pa.array(counts),
         pa.array([words[i] for i in other[at]]), pa.array(n[other[at]])],
        ["word", "n_near", "best", "best_n"])


def variant_forms(words: DataFrame, factor: int = FACTOR, group: int = GROUP) -> DataFrame:
    """All ``words`` (``word``, ``n``; distinct) with ``form``, ``root``, ``n_near``, ``form_n``.

    The form is the commonest near word if it is at least ``factor`` times as common; the root is
    where following forms ends, the word itself if it has none.
    """
    words = written(words.where(F.col("word").isNotNull()).select("word", "n"), "words")
    near = near_words(words, group)
    is_form = F.col("best_n") >= F.lit(factor) * F.col("n")
    forms = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    return forms.join(_roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of all words with a form. Each round doubles the steps taken; forms
    grow ``factor``-fold at each step, so there are few."""
    links = written(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")),
                    "roots")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(links.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links
