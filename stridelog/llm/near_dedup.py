"""Near-duplicate documents by consistent weighted sampling over TF-IDF weighted word shingles.

A document is a bag of five-word shingles. A shingle weighs its count times the mean inverse
document frequency of its words, over all documents. Improved consistent weighted sampling
draws, for each of a number of hash functions, one shingle with a chance in proportion to its
weight, so that two documents draw the same with their weighted Jaccard similarity as chance.
Samples are banded; documents that share a band are candidates, and candidates are verified by
the similarity itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelog.llm.common import broadcast_if_small, written
from stridelog.llm.components import connected_components
from stridelog.llm.textbatch import NGrams, TextBatch, batches, mix


@dataclass(frozen=True)
class NearDedupConfig:
    """``bands`` x ``rows`` samples: two documents at similarity s share a band with the chance
    1 - (1 - s ** rows) ** bands, which is 0.9994 at 0.8 and over 0.99999 at 0.87.

    ``small_bucket`` is a matter of speed alone: documents of a band value that no more than so
    many share are compared with each other; larger ones go through a leader first.
    ``word_table`` bounds the table of frequent words that every worker gets; the frequencies of
    all other words are joined to the texts that hold them. It changes no result.
    """

    shingle: int = 5
    threshold: float = 0.8
    bands: int = 14
    rows: int = 4
    small_bucket: int = 32
    word_table: int = 1 << 18

    @property
    def samples(self) -> int:
        return self.bands * self.rows


_RARE = "ARRAY<STRUCT<word: LONG, idf: FLOAT>>"
ROUNDING = 1e-9        # by which sums of weights may fall short of the threshold
WHOLE = 1 << 62        # a limit of bytes that no batch reaches
_LEVELS = 14           # bits of a shingle's hash that pick its random numbers, per sample
_PARTS = 64            # classes of shingles by hash, in which shared weights are bounded apart
_FEATURE_BITS = 44     # bits of a shingle's hash kept; the rest holds the text's number


def document_frequencies(docs: DataFrame, text_col: str) -> DataFrame:
    """``word`` (its hash) and ``n``, the number of rows with it; for the null word, all rows with
    words."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for _, _, batch in batches(part.column(0)):
                name, at = np.unique(batch.word_hash(), return_inverse=True)
                pair = np.unique(batch.row_of_word() * len(name) + at)
                found = np.bincount(pair % max(len(name), 1), minlength=len(name))
                filled = int((np.diff(batch.word_bounds) > 0).sum())
                yield pa.RecordBatch.from_arrays([
                    pa.array([*name.view(np.int64), 0], mask=np.arange(len(name) + 1) == len(name)),
                    pa.array([*found, filled], pa.int64())], ["word", "n"])

    return written(docs.select(text_col).mapInArrow(count, "word LONG, n LONG")
                   .groupBy("word").agg(F.sum("n").alias("n")), "words")


def inverse_frequency(n: Column, documents: int) -> Column:
    return (1 + F.log((documents + 1) / (n + 1))).cast("float")


@dataclass
class WordWeights:
    """Inverse document frequencies of the frequent words, by hash in rising order."""

    word: np.ndarray
    idf: np.ndarray

    def of(self, words: np.ndarray, rare: pa.ListArray | None = None) -> np.ndarray:
        """The weights of words; those of words not in the table are in the lists ``rare``."""
        out, known = _looked_up(words, self.word, self.idf)
        if rare is not None and not known.all():
            listed = rare.flatten()
            name = listed.field(0).to_numpy(zero_copy_only=False).view(np.uint64)
            order = np.argsort(name)
            out[~known], _ = _looked_up(
                words[~known], name[order], listed.field(1).to_numpy(zero_copy_only=False)[order])
        return out

    def unknown(self, words: np.ndarray) -> np.ndarray:
        return ~_looked_up(words, self.word, self.idf)[1]


def _looked_up(words: np.ndarray, names: np.ndarray,
               values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The value of each word (0 if it has none), and whether it has one."""
    if not len(names):
        return np.zeros(len(words)), np.zeros(len(words), dtype=bool)
    at = np.minimum(np.searchsorted(names, words), len(names) - 1)
    known = names[at] == words
    return np.where(known, values[at], 0.0), known


@dataclass
class _Weighed:
    """Rows (``id``, ``text``) and what their words weigh: frequent ones by ``weights``, others by
    the ``lists`` of their ``row``; without lists all are frequent."""

    rows: DataFrame
    weights: Broadcast
    lists: DataFrame | None = None

    def with_rare(self, rows: DataFrame) -> DataFrame:
        """Rows with the list ``rare`` in place of ``row`` and ``listed``."""
        none = F.lit(None).cast(_RARE).alias("rare")
        if self.lists is None:
            return rows.select("*", none)
        out = [c for c in rows.columns if c not in ("row", "listed")]
        return rows.where("NOT listed").select(*out, none).union(
            rows.where("listed").join(self.lists, "row").select(*out, "rare"))


def _weighed(docs: DataFrame, config: NearDedupConfig) -> _Weighed:
    """Weigh the words of ``docs`` (``id``, ``text``).

    Frequent are words of at least a number of documents, the least power of two that leaves no
    more than ``word_table`` of them. A rare word has fewer rows than that, so none is hot. Rows
    get a number to bring their words together again, so that equal texts do not meet. Texts are
    written once with it and the lists apart from them.
    """
    spark = docs.sparkSession
    counts = document_frequencies(docs, "text")
    documents = sum(r["n"] for r in counts.where("word IS NULL").collect())
    levels = {r["level"]: r["count"] for r in counts.where("word IS NOT NULL").groupBy(
        F.floor(F.log2("n")).alias("level")).count().collect()}
    left, least = sum(levels.values()), 0
    while left > config.word_table:
        left -= levels.get(least, 0)
        least += 1
    idf = counts.where("word IS NOT NULL").select(
        "word", inverse_frequency(F.col("n"), documents).alias("idf"),
        (F.floor(F.log2("n")) >= least).alias("frequent"))
    kept = idf.where("frequent").select("word", "idf").toArrow()
    name = kept.column("word").to_numpy().view(np.uint64)
    order = np.argsort(name)
    weights = spark.sparkContext.broadcast(
        WordWeights(name[order], kept.column("idf").to_numpy()[order]))
    if not least:
        return _Weighed(docs, weights)

    def tag(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first, end, batch in batches(part.column(1)):
                words, row = batch.word_hash(), batch.row_of_word()
                open_ = weights.value.unknown(words)
                name, at = np.unique(words[open_], return_inverse=True)
                pair = np.unique(row[open_] * len(name) + at)
                size = np.bincount(pair // max(len(name), 1), minlength=end - first)
                ends = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
                listed = pa.array(name[pair % max(len(name), 1)].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(first, end - first) for c in part.columns),
                     pa.ListArray.from_arrays(ends, listed)], ["id", "text", "words"])

    tagged = written(docs.mapInArrow(tag, "id LONG, text STRING, words ARRAY<LONG>").withColumn(
        "row", F.monotonically_increasing_id()), "tagged")
    lists = tagged.select("row", F.explode("words").alias("word")).join(
        idf.where("NOT frequent").select("word", "idf"), "word").groupBy("row").agg(
        F.collect_list(F.struct("word", "idf")).alias("rare"))
    rows = tagged.select("id", "text", "row", (F.size("words") > 0).alias("listed"))
    return _Weighed(rows, weights, written(lists, "lists"))


@dataclass
class Features:
    """Shingles of the texts of a batch, ordered by text: key (text and hash), weight, text."""

    key: np.ndarray
    weight: np.ndarray
    row: np.ndarray


def features(batch: TextBatch, rare: pa.ListArray, weights: WordWeights, n: int) -> Features:
    """Distinct shingles with their weights. A text of fewer than ``n`` words is one shingle."""
    words = batch.word_hash()
    grams, word_idf = NGrams(words), weights.of(words, rare)
    sums = np.concatenate([[0.0], np.cumsum(word_idf)])
    first, last = batch.word_bounds[:-1], batch.word_bounds[1:]
    row = batch.row_of_word()
    starts = np.arange(len(words))
    whole = starts + n <= last[row]
    short = (starts == first[row]) & ~whole
    starts = starts[whole | short]
    row = row[starts]
    ends = np.minimum(starts + n, last[row])
    key = (grams.between(starts, ends) >> np.uint64(64 - _FEATURE_BITS)) | (
        row.astype(np.uint64) << np.uint64(_FEATURE_BITS))
    mean = (sums[ends] - sums[starts]) / (ends - starts)
    order = np.argsort(key)
    key, mean = key[order], mean[order]
    opens = np.ones(len(key), dtype=bool)
    opens[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(opens)
    count = np.diff(np.append(at, len(key)))
    return Features(key[at], mean[at] * count, (key[at] >> np.uint64(_FEATURE_BITS)).astype(int))


def _random_tables(samples: int) -> list[tuple[np.ndarray, ...]]:
    """For each sample: r, 1/r, beta and ln c - r + r * beta of every level, and its multiplier."""
    drawn = np.random.default_rng(20240607)
    out = []
    for _ in range(samples):
        r = drawn.gamma(2.0, 1.0, 1 << _LEVELS)
        c = drawn.gamma(2.0, 1.0, 1 << _LEVELS)
        beta = drawn.random(1 << _LEVELS)
        odd = np.uint64(drawn.integers(1 << 62)) * np.uint64(2) + np.uint64(1)
        out.append((*(x.astype(np.float32) for x in (r, 1 / r, beta, np.log(c) - r + r * beta)),
                    odd))
    return out


def sketch(found: Features, rows: int, tables: list[tuple[np.ndarray, ...]]) -> np.ndarray:
    """A matrix (texts x samples) of 32-bit samples; a text without words has zeros.

    Sample k of a text is the shingle of least ``c / (y * exp(r))``, where ``ln y`` is the
    weight's logarithm rounded down on a grid of step r shifted by beta. Equal values, which
    the finite tables allow, are told apart by the shingle's hash.
    """
    out = np.zeros((rows, len(tables)), dtype=np.uint32)
    if not len(found.key):
        return out
    log_weight = np.log(found.weight).astype(np.float32)
    name = mix(found.key & np.uint64((1 << _FEATURE_BITS) - 1))
    opens = np.ones(len(found.row), dtype=bool)
    opens[1:] = found.row[1:] != found.row[:-1]
    at = np.flatnonzero(opens)
    filled = found.row[at]
    for k, (r, per_r, beta, base, odd) in enumerate(tables):
        spread = name * odd
        level = (spread >> np.uint64(64 - _LEVELS)).astype(np.intp)
        step = np.floor(log_weight * per_r.take(level) + beta.take(level))
        value = base.take(level) - r.take(level) * step + np.float32(128)
        label = (spread >> np.uint64(8)).astype(np.uint32) ^ (
            step.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1))
        packed = value.view(np.uint32).astype(np.uint64) << np.uint64(32) | label
        out[filled, k] = np.minimum.reduceat(packed, at).astype(np.uint32)
    return out


def similarity(left: Features, right: Features, rows: int) -> np.ndarray:
    """Weighted Jaccard similarity of texts with the same number in two batches."""
    _, i, j = np.intersect1d(left.key, right.key, assume_unique=True, return_indices=True)
    shared = np.bincount(left.row[i], np.minimum(left.weight[i], right.weight[j]), rows)
    both = np.bincount(left.row, left.weight, rows) + np.bincount(right.row, right.weight, rows)
    return shared / np.maximum(both - shared, 1e-300)


def _sketches(docs: _Weighed, config: NearDedupConfig) -> DataFrame:
    """Per document: id, 128-bit hash of its words (null without words), samples as binary."""
    n, samples, weights = config.shingle, config.samples, docs.weights

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _random_tables(samples)
        for part in parts:
            for first, end, batch in batches(part.column(1)):
                words = batch.word_hash()
                none = np.diff(batch.word_bounds) == 0
                bounds = batch.word_bounds[:-1], batch.word_bounds[1:]
                h1 = NGrams(words).between(*bounds).view(np.int64)
                h2 = NGrams(mix(words + np.uint64(1))).between(*bounds).view(np.int64)
                rare = part.column(2).slice(first, end - first)
                drawn = sketch(features(batch, rare, weights.value, n), batch.rows, tables)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).slice(first, end - first),
                    pa.array(h1, mask=none), pa.array(h2, mask=none),
                    pa.array([row.tobytes() for row in drawn], pa.binary()),
                ], ["id", "h1", "h2", "samples"])

    return docs.with_rare(docs.rows).mapInArrow(
        run, "id LONG, h1 LONG, h2 LONG, samples BINARY")


def _with_texts(pairs: DataFrame, texts: _Weighed) -> DataFrame:
    """``a``, ``b``, both texts and both lists of rare words. Only texts of nodes in some pair are
    exchanged."""
    wanted = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "used")
    found = texts.rows.withColumnRenamed("id", "node").join(
        broadcast_if_small(wanted), "node").dropDuplicates(["node"])
    used = written(texts.with_rare(found), "texts")
    left = used.select(F.col("node").alias("a"), F.col("text").alias("left"),
                       F.col("rare").alias("left_rare"))
    right = used.select(F.col("node").alias("b"), F.col("text").alias("right"),
                        F.col("rare").alias("right_rare"))
    return pairs.join(left, "a").join(right, "b").select(
        "a", "b", "left", "right", "left_rare", "right_rare")


def _both_features(part: pa.RecordBatch, weights: WordWeights,
                   n: int) -> Iterator[tuple[int, int, Features, Features]]:
    """Shingles of the left and of the right texts of a batch, by pieces of bounded size."""
    for first, end, left in batches(part.column(2)):
        right, left_rare, right_rare = (c.slice(first, end - first) for c in part.columns[3:6])
        (_, _, right), = batches(right, WHOLE)
        yield (first, end, features(left, left_rare, weights, n),
               features(right, right_rare, weights, n))


def _compared(pairs: DataFrame, texts: _Weighed, config: NearDedupConfig) -> DataFrame:
    """``a``, ``b`` and their ``similarity``."""
    n, weights = config.shingle, texts.weights

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first, end, left, right in _both_features(part, weights.value, n):
                found = similarity(left, right, end - first)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(first, end - first) for c in part.columns[:2]), pa.array(found)],
                    ["a", "b", "similarity"])

    return _with_texts(pairs, texts).mapInArrow(run, "a LONG, b LONG, similarity DOUBLE")


def _related(pairs: DataFrame, texts: _Weighed, config: NearDedupConfig) -> DataFrame:
    """How ``b`` stands to ``a``: its ``own`` weight, the weight ``shared`` with ``a``, the same
    by classes of shingles (``parts``), and the shingles that weigh more in ``b`` than in ``a``
    (``novel``), with how much more."""
    n, weights = config.shingle, texts.weights
    name_bits = np.uint64((1 << _FEATURE_BITS) - 1)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first, end, left, right in _both_features(part, weights.value, n):
                rows = end - first
                _, i, j = np.intersect1d(
                    left.key, right.key, assume_unique=True, return_indices=True)
                more = right.weight.copy()
                more[j] -= np.minimum(left.weight[i], right.weight[j])
                novel = more > ROUNDING * right.weight
                both = np.minimum(left.weight[i], right.weight[j])
                part_of = right.row[j] * _PARTS + (
                    mix(right.key[j] & name_bits) % np.uint64(_PARTS)).astype(int)
                parts_ = np.bincount(part_of, both, rows * _PARTS)
                ends = np.concatenate([[0], np.cumsum(np.bincount(right.row[novel], minlength=rows))])
                names = (right.key[novel] & name_bits).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    *(c.slice(first, rows) for c in part.columns[:2]),
                    pa.array(np.bincount(right.row, right.weight, rows)),
                    pa.array(np.bincount(right.row[j], both, rows)),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(rows + 1) * _PARTS, pa.int32()), pa.array(parts_)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                        [pa.array(names), pa.array(more[novel])], ["shingle", "more"])),
                ], ["a", "b", "own", "shared", "parts", "novel"])

    return _with_texts(pairs, texts).mapInArrow(
        run, "a LONG, b LONG, own DOUBLE, shared DOUBLE, parts ARRAY<DOUBLE>, "
             "novel ARRAY<STRUCT<shingle: LONG, more: DOUBLE>>")


def _plausible(pairs: DataFrame, sketches: DataFrame, config: NearDedupConfig) -> DataFrame:
    """Pairs that share at least half as many samples as a pair at the threshold does on average.

    Of 56 samples a pair at 0.8 has fewer than 23 equal with a chance below 1e-8. One at 0.6,
    as far from a leader as matters, has so few with a chance of about 0.001.
    """
    size, least = config.samples, config.samples * config.threshold / 2

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            left, right = (
                np.frombuffer(b"".join(c.to_pylist()), dtype=np.uint32).reshape(-1, size)
                for c in part.columns[2:4])
            near = (left == right).sum(axis=1) >= least
            yield part.select(["a", "b"]).filter(pa.array(near))

    left = sketches.select(F.col("node").alias("a"), F.col("samples").alias("left"))
    right = sketches.select(F.col("node").alias("b"), F.col("samples").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(
        run, "a LONG, b LONG")


def _candidates(members: DataFrame, small: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of each bucket: all if it is small, else its leader, the least node, with every
    other member. Also gives the members of large buckets with their leader.
    """
    sizes = written(members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("leader")).where("n > 1"), "sizes")
    placed = written(members.join(sizes, "bucket"), "buckets")
    few = placed.where(F.col("n") <= small)
    within = few.select("bucket", F.col("node").alias("a")).join(
        few.select("bucket", F.col("node").alias("b")), "bucket").where("a < b")
    large = placed.where(F.col("n") > small).select("leader", "node").distinct()
    led = large.where("leader < node").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    return within.select("a", "b").union(led).distinct(), large


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           config: NearDedupConfig | None = None) -> DataFrame:
    """``id_col`` and ``class_id`` for every row of ``docs``: the least id of its class.

    A class is a connected component of documents linked by a similarity of at least the
    threshold. Documents with the same words in the same order are one node from the start.
    A null or empty text, or one of white space only, has no words and is a class of its own.
    Rows with the same id belong to one document. A row without an id is in the class of the
    documents with its words, if there are any, and in none (null) otherwise.

    Large buckets, such as a family of copies that holds a third of the corpus, are never paired
    out. Their members are compared with a leader and with the most central member of their
    family; those linked through these need nothing more. What else may be linked is told by the
    shingles in which members differ from the family, see ``_left_open``.
    """
    config = config or NearDedupConfig()
    weighed = _weighed(docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), config)
    drawn = written(_sketches(weighed, config), "sketches")

    sketches = written(
        drawn.where("h1 IS NOT NULL AND id IS NOT NULL").groupBy("h1", "h2")
        .agg(F.min("id").alias("node"), F.min("samples").alias("samples")), "nodes")
    width = 4 * config.rows
    bands = [F.xxhash64(F.lit(i), F.substring("samples", 1 + i * width, width))
             for i in range(config.bands)]
    members = sketches.select(
        F.explode(F.array(*bands)).alias("bucket"), "node")

    search = _Search(sketches, weighed, config)
    pairs, large = _candidates(members, config.small_bucket)
    links = search.links(pairs)
    labels = connected_components(links)
    open_ = _open(large, "leader", labels)
    if not open_.isEmpty():
        family = _families(open_, labels, search)
        novel = _shared_novel(family, config)
        links = links.union(search.links(_central_pairs(family, novel)))
        links = links.union(search.links(_left_open(
            family, novel, connected_components(links), config)))
        labels = connected_components(links)

    nodes = sketches.select("h1", "h2", "node").join(labels, "node", "left").select(
        "h1", "h2", F.coalesce("label", "node").alias("class"))
    return drawn.join(nodes, ["h1", "h2"], "left").select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col),
        F.coalesce("class", "id").alias("class_id"))


@dataclass
class _Search:
    """What it takes to look at pairs of nodes."""

    sketches: DataFrame
    texts: _Weighed
    config: NearDedupConfig

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs that are similar enough, seen by their samples first."""
        likely = written(_plausible(pairs, self.sketches, self.config), "likely")
        found = _compared(likely, self.texts, self.config)
        return written(found.where(
            F.col("similarity") >= self.config.threshold - ROUNDING).select("a", "b"), "links")


def _open(members: DataFrame, group: str, labels: DataFrame, node: str = "node") -> DataFrame:
    """The members of groups (buckets, families) that are not yet one component as a whole. In the
    others every pair is known to be in one class, so nothing is left to find."""
    found = members.join(labels.select(F.col("node").alias(node), "label"), node, "left")
    named = F.coalesce("label", node)
    several = found.groupBy(group).agg(F.min(named).alias("low"), F.max(named).alias("high")).where(
        "low < high").select(group)
    return written(members.join(several, group, "left_semi"), "open")


def _families(large: DataFrame, labels: DataFrame, search: _Search) -> DataFrame:
    """The members of large buckets by family, each compared with the pivot of its family.

    A family is made of the buckets in which most members are of the same component; the pivot
    ``a`` is that component's least node.
    """
    named = labels.select("node", "label")
    members = written(large.join(named, "node", "left").select(
        "leader", "node", F.coalesce("label", "node").alias("label")), "members")
    pivots = members.groupBy("leader", "label").agg(F.count(F.lit(1)).alias("n")).groupBy(
        "leader").agg(F.max_by("label", F.struct("n", "label")).alias("a"))
    pairs = members.join(written(pivots, "pivots"), "leader").select(
        "a", F.col("node").alias("b")).distinct()
    return written(_related(written(pairs, "family"), search.texts, search.config),
                   "related")


def _shared_novel(family: DataFrame, config: NearDedupConfig) -> DataFrame:
    """Per member the shingles that its family's pivot lacks and two members or more have, with
    their weight; ``common`` if they are more than a small bucket takes."""
    novel = family.select("a", "b", F.explode("novel").alias("_n")).select(
        "a", "b", F.col("_n.shingle").alias("shingle"), F.col("_n.more").alias("more"))
    counts = novel.groupBy("a", "shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "a", "shingle", (F.col("n") > config.small_bucket).alias("common"))
    return written(novel.join(counts, ["a", "shingle"]), "novel")


def _with_common(family: DataFrame, novel: DataFrame) -> DataFrame:
    """Adds to ``shared`` the weight that a member has in ``common`` shingles of its family."""
    found = novel.where("common").groupBy("a", "b").agg(F.sum("more").alias("common"))
    common = F.coalesce("common", F.lit(0.0))
    return family.select("a", "b", "own", "shared", "parts").join(found, ["a", "b"], "left").select(
        "a", "b", "own", (F.col("shared") + common).alias("shared"), common.alias("common"), "parts")


def _central_pairs(family: DataFrame, novel: DataFrame) -> DataFrame:
    """Every member of a family with its most central one, the one of fewest shingles of its own.

    The pivot may be a copy with changes; then copies of the original are nearer to this member.
    """
    placed = written(_with_common(family, novel), "placed")
    central = placed.groupBy("a").agg(F.max_by("b", F.struct(
        F.col("shared") / F.col("own"), -F.col("b"))).alias("centre"))
    return placed.select("a", "b").join(written(central, "centres"), "a").where(
        "b <> centre").select(
        F.least("b", "centre").alias("a"), F.greatest("b", "centre").alias("b")).distinct()


def _left_open(family: DataFrame, novel: DataFrame, labels: DataFrame,
               config: NearDedupConfig) -> DataFrame:
    """Which pairs of a family may be linked although no path between them is known.

    Pairs that have a shingle in common which is neither in the pivot nor common in the family
    are listed with the weight of all these; few members have such a shingle. Beyond it a pair
    shares at most what the lesser of both has in pivot and common shingles. With the threshold t
    a link takes that the weights of both together are at most (1 + t) / t times what they
    share. So without a listed shingle each weight has to be at most the ``slack`` of the other.
    Such pairs meet by weight, in steps of five per cent, and are bounded once more by the lesser
    pivot weights in each class of shingles: of two members that lack different pivot shingles
    both lacks count. All bounds are on the safe side, so no link is lost.
    """
    t, step = config.threshold - ROUNDING, 0.05

    def enough(shared: Column, other_own: str) -> Column:
        return shared * (1 + ROUNDING) * ((1 + t) / t) >= F.col("own") + F.col(other_own)

    family = _open(family, "a", labels, "b")
    named = labels.select(F.col("node").alias("b"), "label")
    placed = written(_with_common(family, novel).join(named, "b", "left").select(
        "a", "b", "own", "shared", "common", "parts", F.coalesce("label", "b").alias("label"),
        ((1 + t) / t * F.col("shared") * (1 + ROUNDING) - F.col("own")).alias("slack")), "placed")

    # In a family of one component nothing is open; in others pairs within one are not.
    top = labels.select(F.col("node").alias("a"), F.col("label").alias("top"))
    place = F.floor(F.log(F.col("own")) / step)
    low, high = F.col("own") * t, F.least(F.col("slack"), F.col("own") / t)
    outside = placed.join(top, "a", "left").where(
        (~F.col("label").eqNullSafe(F.col("top"))) & (low <= high)).select(
        "a", "own", "slack", "common", "parts", "label", "b", F.explode(F.sequence(
            F.floor(F.log(low) / step), F.floor(F.log(high) / step))).alias("place"))
    inside = placed.join(top, "a", "left").select(
        "a", place.alias("place"), F.col("b").alias("v"), F.col("own").alias("v_own"),
        F.col("slack").alias("v_slack"), F.col("common").alias("v_common"),
        F.col("parts").alias("v_parts"), F.col("label").alias("v_label"),
        F.col("label").eqNullSafe(F.col("top")).alias("v_within"))
    # Two members outside would meet from both sides; the condition is the same on each.
    in_pivot = F.aggregate(
        F.zip_with("parts", "v_parts", lambda x, y: F.least(x, y)), F.lit(0.0), lambda x, y: x + y)
    by_weight = outside.join(inside, ["a", "place"]).where(
        "label <> v_label AND v_own <= slack AND own <= v_slack AND (v_within OR b < v)").where(
        enough(in_pivot + F.least("common", "v_common"), "v_own")).select("b", "v")

    rare = written(novel.where("NOT common").join(
        placed.select("a", "b", "own", "shared", "label"), ["a", "b"]).select(
        "a", "shingle", "b", "more", "own", "shared", "label"), "rare")
    other = rare.select("a", "shingle", *(
        F.col(c).alias(n) for c, n in [("b", "v"), ("more", "v_more"), ("own", "v_own"),
                                       ("shared", "v_shared"), ("label", "v_label")]))
    by_shingle = rare.join(other, ["a", "shingle"]).where("b < v AND label <> v_label").groupBy(
        "a", "b", "v").agg(
        F.sum(F.least("more", "v_more")).alias("listed"),
        *(F.first(c).alias(c) for c in ("own", "shared", "v_own", "v_shared"))).where(
        enough(F.col("listed") + F.least("shared", "v_shared"), "v_own")).select("b", "v")
    return by_weight.union(by_shingle).select(
        F.least("b", "v").alias("a"), F.greatest("b", "v").alias("b")).distinct()


def keep_one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       config: NearDedupConfig | None = None) -> DataFrame:
    """The rows of ``docs`` that stand for their class, one for each, with all their columns.

    The document of least id stays. Of repeated rows with its id one stays; rows without an
    id cannot be told apart and all stay.
    """
    classes = near_duplicate_classes(docs, id_col, text_col, config)
    kept = classes.where(F.col(id_col) == F.col("class_id")).select(id_col).distinct()
    named = docs.join(written(kept, "kept"), id_col, "left_semi").dropDuplicates([id_col])
    return named.union(docs.where(F.col(id_col).isNull()))
