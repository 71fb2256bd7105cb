"""Contiguous shards of ordered groups with the smallest possible largest shard.

Groups are equal texts; they stay whole and are ordered by a digest of the text. The smallest
capacity is found by binary search, where a greedy walk along the prefix sums of group sizes
checks whether a capacity suffices. The sums live in Spark: the driver only sees them for cells
of the key space, as a table of bounded size, and asks for finer cells where the answer still
depends on what is inside one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelog.llm.common import broadcast_if_small, text_of, written

KEY_BITS = 60           # of a text's SHA-256 digest, its place in the order
FIRST_BITS = 12         # cells of the first look: 4096
COLLECT_BITS = 16       # at most about so many (as a power of two) finer cells per look
ROWS_PER_PIECE = 100_000


def group_key(text: Column) -> Column:
    """The first 60 bits of the digest. Different texts with equal keys would form one group."""
    return F.conv(F.substring(F.sha2(text, 256), 1, KEY_BITS // 4), 16, 10).cast("long")


@dataclass
class Cells:
    """Non-empty ranges of the key space in order: first key, bits of width, bytes, groups."""

    key: np.ndarray
    bits: np.ndarray
    bytes: np.ndarray
    groups: np.ndarray

    def __post_init__(self) -> None:
        self.ahead = np.concatenate([[0], np.cumsum(self.bytes)])  # bytes before each cell
        self.total = int(self.ahead[-1])

    def below(self, x: int, hopeful: bool) -> int:
        """The largest number of bytes up to ``x`` after which a cut may stand.

        Inside a cell of several groups it is not known; then the bound from above is ``x``
        and the one from below the beginning of the cell.
        """
        if x >= self.total:
            return self.total
        i = int(np.searchsorted(self.ahead, x, side="right")) - 1
        return x if hopeful and self.groups[i] > 1 else int(self.ahead[i])

    def cuts(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        """Where a greedy walk cuts, each shard as full as it gets."""
        out, at = [], 0
        for _ in range(shards):
            at = self.below(at + capacity, hopeful)
            out.append(at)
        return out

    def least_capacity(self, shards: int, hopeful: bool) -> int:
        low, high = -(-self.total // shards), self.total
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, hopeful)[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def unknown(self, spans: list[tuple[int, int]]) -> np.ndarray:
        """Cells of several groups that lie in some span of bytes."""
        wanted = np.zeros(len(self.key), dtype=bool)
        for low, high in spans:
            first = int(np.searchsorted(self.ahead, low, side="right")) - 1
            last = int(np.searchsorted(self.ahead, high, side="right"))
            wanted[max(first, 0):last] = True
        return np.flatnonzero(wanted & (self.groups > 1))


def _look(groups: DataFrame, bits: int, within: list[tuple[int, int]] | None) -> Cells:
    """Cells of 2 ** ``bits`` keys; ``within`` lists (first key, bits) of the cells to split."""
    if within is not None:
        spark, parts = groups.sparkSession, []
        for wide in sorted({b for _, b in within}):
            cells = spark.createDataFrame(
                [(k >> wide,) for k, b in within if b == wide], "at LONG")
            parts.append(groups.join(F.broadcast(cells), F.shiftright("key", wide) == F.col("at")))
        groups = parts[0]
        for part in parts[1:]:
            groups = groups.union(part)
    rows = groups.groupBy(F.shiftright("key", bits).alias("cell")).agg(
        F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("groups")).orderBy("cell").collect()
    column = lambda name: np.array([r[name] for r in rows], dtype=np.int64)
    return Cells(column("cell") << bits, np.full(len(rows), bits, dtype=np.int64),
                 column("bytes"), column("groups"))


def _refined(groups: DataFrame, cells: Cells, at: np.ndarray) -> Cells:
    """The same cells with those at ``at`` replaced by finer ones."""
    step = max(1, COLLECT_BITS - int(np.ceil(np.log2(len(at)))))
    bits = max(0, int(cells.bits[at].min()) - step)
    finer = _look(groups, bits, [(int(cells.key[i]), int(cells.bits[i])) for i in at])
    rest = np.setdiff1d(np.arange(len(cells.key)), at)
    merged = [np.concatenate([getattr(cells, f)[rest], getattr(finer, f)])
              for f in ("key", "bits", "bytes", "groups")]
    order = np.argsort(merged[0])
    return Cells(*(m[order] for m in merged))


@dataclass(frozen=True)
class ShardPlan:
    """Shard k holds the groups whose key is at least ``first_keys[k]`` and below the next."""

    capacity: int
    first_keys: list[int]

    def shard_of(self, key: Column) -> Column:
        places = [F.when(key >= F.lit(k), 1).otherwise(0) for k in self.first_keys[1:]]
        return sum(places, F.lit(0)).cast("int")


def plan_shards(groups: DataFrame, shards: int) -> ShardPlan:
    """The smallest capacity for ``groups`` (key, bytes; one row per group) and cuts under it.

    Under the smallest capacity each cut is put where it leaves the shards nearest to equal:
    as near to its share of the bytes as it can be while the shards before and after it fit.
    """
    cells = _look(groups, KEY_BITS - FIRST_BITS, None)
    if not cells.total:
        return ShardPlan(0, [0] + [1 << KEY_BITS] * (shards - 1))
    while True:
        low = cells.least_capacity(shards, hopeful=True)
        high = cells.least_capacity(shards, hopeful=False)
        if low == high:
            break
        at = cells.unknown(list(zip(cells.cuts(low, shards, False),
                                    cells.cuts(high, shards, True))))
        cells = _refined(groups, cells, at)
    while True:
        cuts, asked = _even_cuts(cells, low, shards)
        at = cells.unknown([(x, x) for x in asked])
        if not len(at):
            break
        cells = _refined(groups, cells, at)
    at = np.searchsorted(cells.ahead, cuts, side="left")
    keys = [int(cells.key[i]) if i < len(cells.key) else 1 << KEY_BITS for i in at]
    return ShardPlan(low, [0, *keys])


def _even_cuts(cells: Cells, capacity: int, shards: int) -> tuple[list[int], list[int]]:
    """Cuts near equal shares under ``capacity``, and the places that had to be known for it."""
    asked: list[int] = []

    def around(x: int) -> tuple[int, int]:
        """The places for a cut at or below ``x`` and at or above it."""
        asked.append(x)
        x = min(max(x, 0), cells.total)
        down = cells.below(x, False)
        i = int(np.searchsorted(cells.ahead, x, side="left"))
        return down, int(cells.ahead[i])

    first = [cells.total] * (shards + 1)  # the earliest cut after which the rest fits
    for k in range(shards - 1, 0, -1):
        first[k] = around(first[k + 1] - capacity)[1]
    cuts, at = [], 0
    for k in range(1, shards):
        share = min(max(round(k * cells.total / shards), first[k]), at + capacity)
        down, up = around(share)
        fits = [x for x in (down, up) if first[k] <= x <= at + capacity]
        at = min(fits or [down], key=lambda x: abs(x - share))
        cuts.append(at)
    return cuts, asked


def assign_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, size, CRC-32 of the text, shard and a slot within the shard.

    The size is the text's UTF-8 bytes plus 1. Null counts as the empty text and belongs to its
    group. Slots run from 0 without gaps. Repeated rows are rows of their own; null ids stay
    null; a shard for which there is no group stays empty.
    """
    text = text_of(text_col)
    rows = written(docs.select(
        F.col(id_col), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), group_key(text).alias("key")), "rows")
    groups = written(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    plan = plan_shards(groups, shards)

    # Slots: rows are numbered in pieces of bounded size, which the sizes of those before shift.
    cell = F.shiftright("key", KEY_BITS - FIRST_BITS).alias("cell")
    placed = rows.select("*", plan.shard_of(F.col("key")).alias("shard"), cell)
    counts = written(placed.groupBy("shard", "cell").agg(
        F.ceil(F.count(F.lit(1)) / ROWS_PER_PIECE).cast("int").alias("pieces")), "cells")
    cut = placed.join(broadcast_if_small(counts), ["shard", "cell"]).withColumn(
        "piece", F.pmod(F.xxhash64(id_col), "pieces").cast("int"))
    sizes = cut.groupBy("shard", "cell", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("cell", "piece").rowsBetween(
        Window.unboundedPreceding, -1)
    shifts = written(sizes.select(
        "shard", "cell", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")),
        "shifts")
    within = Window.partitionBy("shard", "cell", "piece").orderBy("key", id_col)
    return cut.join(broadcast_if_small(shifts), ["shard", "cell", "piece"]).select(
        id_col, "size", "text_crc32", "shard",
        (F.row_number().over(within) - 1 + F.col("shift")).cast("long").alias("slot"))
