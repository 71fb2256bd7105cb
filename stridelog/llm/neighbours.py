"""Nearest neighbours by collision counting over single projections.

Vectors are dealt into blocks, and each block keeps one sorted array per random projection. A
query opens a window around its own projection in every array and widens all windows step by
step (virtual rehashing: a window at radius R is a hash bucket of that size centred on the query).
A vector inside enough windows, the collision threshold, is verified by its true distance. The
search ends when the wanted number of verified vectors lies within the radius.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SearchConfig:
    """With windows of ``width`` times the radius a vector at the radius falls into a window
    with the chance 0.83, one at twice the radius with 0.50. Of 64 windows the first has at
    least the threshold of 0.66 with a chance over 0.999, so that recall is near 1.

    ``block`` and ``query_block`` are the sizes that a task handles at a time.
    """

    projections: int = 64
    width: float = 2.719
    collisions: float = 0.66
    growth: float = 2.0
    block: int = 8192
    query_block: int = 4096


def usable(vector: str) -> Column:
    """Whether a vector takes part: not null, empty or zero, and all components finite."""
    finite = F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class _Block:
    """The vectors of a block, equal ones as one, with a sorted array per projection."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, config: SearchConfig) -> None:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        rows = np.ascontiguousarray(vectors + np.float32(0))  # -0 becomes 0
        _, first, same = np.unique(
            rows.view(f"V{rows.dtype.itemsize * rows.shape[1]}").ravel(), return_index=True,
            return_inverse=True)
        self.vectors = rows[first].astype(np.float64)
        # Of equal vectors only the least ids can be among the nearest.
        by = np.argsort(same, kind="stable")
        starts = np.searchsorted(same[by], np.arange(len(first) + 1))
        self.members = [ids[by[a:min(a + k, b)]] for a, b in zip(starts, starts[1:])]
        drawn = np.random.default_rng(417).standard_normal(
            (rows.shape[1], config.projections))
        self.config, self.drawn = config, drawn
        places = self.vectors @ drawn
        order = np.argsort(places, axis=0)
        # The sorted arrays stand one after the other, shifted apart, so that one search does all.
        self.gap = 2 * float(np.ptp(places, axis=0).max()) or 1.0
        self.shift = np.arange(config.projections) * self.gap - places.min(axis=0)
        self.sorted = (np.take_along_axis(places, order, axis=0) + self.shift).T.ravel()
        self.order = order.T.ravel()

    def nearest(self, query: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The ``k`` nearest (distance, id) found, nearest first, equal distances by id."""
        config, size = self.config, len(self.vectors)
        arrays = np.arange(config.projections)
        at = np.clip(query @ self.drawn + self.shift - arrays * self.gap,
                     -self.gap / 4, self.gap * 3 / 4)  # windows do not reach the next array
        count = np.zeros(size, dtype=np.int64)
        least = int(np.ceil(config.collisions * config.projections))
        first, last = arrays * size, (arrays + 1) * size
        left = np.searchsorted(self.sorted, at + arrays * self.gap)
        right, radius = left.copy(), self._first_radius(at + arrays * self.gap, left, k)
        pending = np.ones(size, dtype=bool)
        found: list[tuple[float, int]] = []
        while True:
            half = config.width * radius / 2
            low = np.searchsorted(self.sorted, at - half + arrays * self.gap, side="left")
            high = np.searchsorted(self.sorted, at + half + arrays * self.gap, side="right")
            low = np.minimum(np.maximum(low, first), left)
            high = np.maximum(np.minimum(high, last), right)
            parts = [self.order[a:b] for a, b in zip(low.tolist(), left.tolist())]
            parts += [self.order[a:b] for a, b in zip(right.tolist(), high.tolist())]
            left, right = low, high
            count += np.bincount(np.concatenate(parts), minlength=size)
            new = np.flatnonzero(pending & (count >= least))
            if len(new):
                pending[new] = False
                far = np.sqrt(((self.vectors[new] - query) ** 2).sum(axis=1))
                keep = far <= np.partition(far, k - 1)[k - 1] if len(far) > k else slice(None)
                found += [(float(d), int(i)) for d, n in zip(far[keep], new[keep])
                          for i in self.members[n]]
                found = sorted(found)[:k]
            if not pending.any() or (len(found) == k and found[-1][0] <= radius):
                return found
            radius *= config.growth
            if len(found) == k:
                radius = min(radius, found[-1][0])  # no farther vector can be among the nearest

    def _first_radius(self, at: np.ndarray, left: np.ndarray, k: int) -> float:
        """A radius at which about half of the windows hold ``k`` vectors; fewer cannot do."""
        near = np.clip(left[:, None] + np.arange(-k, k), 0, len(self.sorted) - 1)
        far = np.partition(np.abs(self.sorted[near] - at[:, None]), k - 1, axis=1)[:, k - 1]
        return 2 * float(np.median(far)) / self.config.width or 1e-6


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.chunk(0)
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
            vector_col: str = "embedding", config: SearchConfig | None = None) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score``: up to ``k`` rows per query.

    The score is the Euclidean distance in double precision; equal scores go by the smaller id.
    Every row of ``vectors`` but those with the query's id is a candidate. Rows whose id is null
    or whose vector is null, empty, zero or not finite take no part on either side, and vectors
    of different lengths are never neighbours. Repeated rows are candidates each; of query rows
    with the same id the least vector counts. Extra columns are ignored.
    """
    config = config or SearchConfig()
    index = vectors.where(F.col(id_col).isNotNull() & usable(vector_col)).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"),
        F.size(vector_col).alias("dim"))
    asked = queries.where(F.col(id_col).isNotNull() & usable(vector_col)).groupBy(
        F.col(id_col).cast("long").alias("id")).agg(F.min(vector_col).alias("v")).select(
        "id", "v", F.size("v").alias("dim"))
    blocks = max(1, -(-index.count() // config.block))
    query_blocks = max(1, -(-asked.count() // config.query_block))

    def dealt(df: DataFrame, own: str, own_count: int, other: str, other_count: int) -> DataFrame:
        numbers = F.sequence(F.lit(0), F.lit(other_count - 1))
        return df.select("id", "v", "dim", F.pmod(F.xxhash64("id"), F.lit(own_count)).cast(
            "int").alias(own), F.explode(numbers).alias(other))

    def search(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        out: tuple[list[int], list[int], list[float]] = ([], [], [])
        if rows.num_rows and wanted.num_rows:
            block = _Block(rows.column("id").to_numpy(), _matrix(rows.column("v")), k + 1, config)
            points = _matrix(wanted.column("v")).astype(np.float64) + 0.0
            texts, place = np.unique(points, axis=0, return_inverse=True)
            answers = [block.nearest(q, k + 1) for q in texts]  # equal queries are asked once
            for query, n in zip(wanted.column("id").to_pylist(), place.ravel().tolist()):
                for score, i in answers[n]:
                    if i != query:
                        out[0].append(query)
                        out[1].append(i)
                        out[2].append(score)
        return pa.table({"query_id": pa.array(out[0], pa.int64()),
                         "vec_id": pa.array(out[1], pa.int64()),
                         "score": pa.array(out[2], pa.float64())})

    keys = ["dim", "block", "part"]
    found = dealt(index, "block", blocks, "part", query_blocks).groupBy(*keys).cogroup(
        dealt(asked, "part", query_blocks, "block", blocks).groupBy(*keys)
    ).applyInArrow(search, "query_id LONG, vec_id LONG, score DOUBLE")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.select("*", F.row_number().over(order).alias("rank")).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
