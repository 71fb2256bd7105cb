"""KMeans over scaled features, to see whether the segments hold up geometrically.

All numbers of clusters and all their starts are fitted side by side: a scan of the users moves
the centres of every fit at once, so there are as many scans as the slowest start has steps.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelog.config import CLUSTER_FEATURES, SEED, SEGMENT, USER
from stridelog.functions.columns import long_form, share_pct
from stridelog.functions.ordered import exact_quantiles
from stridelog.operators.segments import SEGMENT_ORDER, UNCLASSIFIED
from stridelog.session import written_once

CLUSTER = "cluster_id"
MAX_K = 8
USERS_PER_K = 10

# Seeding by sampled candidates: rounds, how many candidates a round draws for each cluster, and
# how often to go on where there are fewer candidates than clusters.
SEED_ROUNDS, PER_CLUSTER, MORE_ROUNDS = 2, 2, 20
# Users per task of a scan, and users whose distances a task holds at a time.
TASK_USERS, SCAN_ROWS = 20_000, 4096
# A fit ends when no centre moves further than this.
TOLERANCE = 1e-4


@dataclass(frozen=True)
class KMeansModel:
    """Centres of clusters, in rows, and the sum of squared distances to them."""

    centres: np.ndarray
    cost: float

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def transform(self, vectors: DataFrame) -> DataFrame:
        """Add the number of the nearest centre to ``scaled``, the first of equals."""
        point = vector_to_array("scaled")
        far = F.array(*[F.aggregate(
            F.zip_with(point, F.array(*map(F.lit, centre)), lambda a, b: (a - b) * (a - b)),
            F.lit(0.0), lambda x, y: x + y) for centre in self.centres.tolist()])
        return vectors.withColumn("_far", far).withColumn(CLUSTER, (
            F.array_position("_far", F.array_min("_far")) - 1).cast("int")).drop("_far")

    def save(self, path: str) -> None:
        """Write the centres as a table, over what is there."""
        rows = [(i, centre, self.cost) for i, centre in enumerate(self.centres.tolist())]
        SparkSession.active().createDataFrame(
            rows, f"{CLUSTER} INT, centre ARRAY<DOUBLE>, training_cost DOUBLE"
        ).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(path: str) -> KMeansModel:
        rows = SparkSession.active().read.parquet(path).orderBy(CLUSTER).collect()
        return KMeansModel(np.array([r["centre"] for r in rows]), rows[0]["training_cost"])


def cluster_columns(feature_store: DataFrame,
                    wanted: Sequence[str] = CLUSTER_FEATURES) -> list[str]:
    """The cluster features a table has; warns about others, fails when there is none."""
    present = [c for c in wanted if c in feature_store.columns]
    missing = [c for c in wanted if c not in feature_store.columns]
    if not present:
        raise ValueError("the table has no cluster features")
    if missing:
        warnings.warn(f"cluster features not in the table: {missing}", stacklevel=2)
    return present


def cluster_input(feature_store: DataFrame) -> DataFrame:
    """The user and the cluster features as doubles, nulls as 0."""
    columns = cluster_columns(feature_store)
    return feature_store.select(
        USER, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]
    )


def scaling_parameters(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Median and interquartile range per feature; a range of 0 counts as 1."""
    quartiles = exact_quantiles(
        long_form(df, [], columns), ["feature"], "value",
        {"q1": 0.25, "center": 0.5, "q3": 0.75}, few_groups=True,
    )
    spread = F.col("q3") - F.col("q1")
    return quartiles.select(
        "feature", "center", F.when(spread == 0, 1.0).otherwise(spread).alias("scale")
    )


def robust_scaled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns less their median, over their interquartile range."""
    return _scaled(df, columns, scaling_parameters(df, columns))


def _scaled(df: DataFrame, columns: Sequence[str], parameters: DataFrame) -> DataFrame:
    wide = parameters.groupBy().pivot("feature", list(columns)).agg(
        F.max("center").alias("center"), F.max("scale").alias("scale")
    )
    return df.crossJoin(F.broadcast(wide)).select(USER, *[
        ((F.col(c) - F.col(f"{c}_center")) / F.col(f"{c}_scale")).alias(c) for c in columns
    ])


def place_users(feature_store: DataFrame, parameters: DataFrame, model: KMeansModel) -> DataFrame:
    """Clusters of users who may be new, by a fitted model and the scaling it was fitted on."""
    inputs = cluster_input(feature_store)
    columns = [c for c in inputs.columns if c != USER]
    scaled = _scaled(inputs, columns, parameters)
    return model.transform(VectorAssembler(inputCols=columns, outputCol="scaled").transform(
        scaled)).select(USER, CLUSTER)


def cluster_vectors(feature_store: DataFrame) -> DataFrame:
    """``person_id`` and the scaled feature vector, written once as many fits read it."""
    inputs = cluster_input(feature_store)
    columns = [c for c in inputs.columns if c != USER]
    scaled = written_once(robust_scaled(inputs, columns), "cluster-input")
    return VectorAssembler(inputCols=columns, outputCol="scaled").transform(scaled).select(
        USER, "scaled"
    )


def _nearest_sums(points: DataFrame, fits: Sequence[np.ndarray]
                  ) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """For every set of centres, in one scan: points and their sum for each centre, which is the
    nearest of its set to them, and the sum of squared distances.

    A task holds a sum per centre, and the driver gets their totals: some rows a centre.
    """
    bounds, flat = np.cumsum([0, *map(len, fits)]), np.concatenate(fits)
    turned, norms, rows = -2 * flat.T, (flat**2).sum(axis=1), SCAN_ROWS

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, cost, sums = np.zeros(len(flat)), np.zeros(len(flat)), np.zeros(flat.shape)
        for part in (p.slice(i, rows) for p in parts for i in range(0, p.num_rows, rows)):
            x = part.column(1).flatten().to_numpy().reshape(part.num_rows, -1)
            columns = np.ascontiguousarray(x.T)
            far = x @ turned + norms  # the squared distances, less the same number for all centres
            for first, end in zip(bounds, bounds[1:]):
                near, size = far[:, first:end].argmin(axis=1), end - first
                apart = x - flat[first + near]
                n[first:end] += np.bincount(near, minlength=size)
                cost[first:end] += np.bincount(
                    near, np.einsum("ij,ij->i", apart, apart), minlength=size)
                for j, column in enumerate(columns):
                    sums[first:end, j] += np.bincount(near, column, minlength=size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(flat))), pa.array(n), pa.array(cost), pa.array(sums.tolist())],
            ["centre", "n", "cost", "sums"])

    found = sorted(points.mapInArrow(
        run, "centre LONG, n DOUBLE, cost DOUBLE, sums ARRAY<DOUBLE>"
    ).groupBy("centre").agg(
        F.sum("n"), F.sum("cost"), *[F.sum(F.col("sums")[j]) for j in range(flat.shape[1])]
    ).collect())
    table = np.array([list(r)[1:] for r in found])
    return [(table[first:end, 0], table[first:end, 2:], float(table[first:end, 1].sum()))
            for first, end in zip(bounds, bounds[1:])]


def _drawn(points: DataFrame, candidates: Sequence[np.ndarray], costs: Sequence[float],
           number: int, salt: int) -> list[np.ndarray]:
    """Some ``number`` further candidates for each start, drawn by squared distance to those it
    has. The draw goes by the hash of the user, so it does not hang on partitions."""
    sets = [(i, c, number / cost) for i, (c, cost) in enumerate(zip(candidates, costs)) if cost > 0]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            key = part.column(0).to_numpy().view(np.uint64)
            x = part.column(1).flatten().to_numpy().reshape(part.num_rows, -1)
            for i, known, rate in sets:
                far = np.min([((x - c) ** 2).sum(axis=1) for c in known], axis=0)
                mixed = (key ^ np.uint64((salt * 1_000_003 + i + 1) * 0x9E3779B97F4A7C15 % 2**64))
                mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                taken = x[(mixed >> np.uint64(11)) * 2.0**-53 < far * rate]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(taken), i)), pa.array(taken.tolist(), pa.list_(pa.float64()))],
                    ["start", "x"])

    rows = points.mapInArrow(run, "start LONG, x ARRAY<DOUBLE>").distinct().collect()
    new: list[list[list[float]]] = [[] for _ in candidates]
    for row in sorted(rows):
        new[row["start"]].append(row["x"])
    return [np.array([*c.tolist(), *more]) for c, more in zip(candidates, new)]


def _spread(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` of the candidates, each drawn by weight and squared distance to those before."""
    rng = np.random.default_rng(seed)
    chosen: list[np.ndarray] = []
    odds = weights.copy()
    while len(chosen) < k and odds.sum() > 0:
        chosen.append(candidates[rng.choice(len(odds), p=odds / odds.sum())])
        odds = weights * np.min([((candidates - c) ** 2).sum(axis=1) for c in chosen], axis=0)
    return np.array(chosen)


def fit_all(vectors: DataFrame, ks: Sequence[int], starts: int, seed: int = SEED,
            max_iter: int = 500) -> dict[int, KMeansModel]:
    """For each number of clusters the best of several starts, by within-cluster cost.

    A start draws candidates over all users, the farther from those it has the likelier, and
    each number of clusters takes its first centres from them. Then all centres of all fits
    move together until none of a fit's moves. Users fewer or more alike than a number of
    clusters give fewer clusters.
    """
    points = vectors.select(F.xxhash64(USER).alias("key"), vector_to_array("scaled").alias("x"))
    tasks = -(-points.count() // TASK_USERS)
    points = (points.repartition(tasks) if tasks > 1 else points).persist()
    try:
        return _fitted(points, ks, starts, seed, max_iter)
    finally:
        points.unpersist()


def _fitted(points: DataFrame, ks: Sequence[int], starts: int, seed: int,
            max_iter: int) -> dict[int, KMeansModel]:
    """``fit_all`` on the users' hashes and vectors."""
    firsts = points.agg(*[F.min_by("x", F.xxhash64("key", F.lit(seed + i))) for i in range(starts)])
    candidates = [np.array([x]) for x in firsts.first()]
    for step in range(MORE_ROUNDS):
        totals = _nearest_sums(points, candidates)
        enough = step >= SEED_ROUNDS and min(map(len, candidates)) >= max(ks)
        if enough or not any(cost for _, _, cost in totals):
            break
        candidates = _drawn(points, candidates, [cost for _, _, cost in totals],
                            PER_CLUSTER * max(ks), seed + step)
    weights = [n for n, _, _ in _nearest_sums(points, candidates)]

    fits = [(k, _spread(candidates[i], weights[i], k, seed + i)) for k in ks for i in range(starts)]
    best: dict[int, KMeansModel] = {}
    for step in range(max_iter):
        moving = []
        for (k, centres), (n, sums, cost) in zip(fits, _nearest_sums(points, [c for _, c in fits])):
            # A centre that is nearest to nobody stays where it is.
            moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
            if step + 1 < max_iter and ((moved - centres) ** 2).sum(axis=1).max() > TOLERANCE**2:
                moving.append((k, moved))
            elif k not in best or cost < best[k].cost:
                best[k] = KMeansModel(centres, cost)
        fits = moving
        if not fits:
            break
    return best


def best_of(vectors: DataFrame, k: int, starts: int, seed: int = SEED,
            max_iter: int = 500) -> KMeansModel:
    """The best of several starts, by within-cluster cost."""
    return fit_all(vectors, [k], starts, seed, max_iter)[k]


def k_sweep(vectors: DataFrame, ks: Sequence[int], seed: int = SEED,
            starts: int = 1) -> DataFrame:
    """Silhouette and cost per number of clusters, over all users."""
    evaluator = ClusteringEvaluator(
        featuresCol="scaled", predictionCol=CLUSTER, distanceMeasure="squaredEuclidean"
    )
    vectors = vectors.persist()
    models = fit_all(vectors, ks, starts, seed, max_iter=300)
    rows = [(k, evaluator.evaluate(models[k].transform(vectors)), models[k].cost) for k in ks]
    vectors.unpersist()
    return vectors.sparkSession.createDataFrame(
        rows, "k INT, silhouette DOUBLE, training_cost DOUBLE"
    )


def candidate_ks(n_users: int) -> range:
    return range(2, min(MAX_K, n_users // USERS_PER_K) + 1)


def best_k(sweep: DataFrame) -> int:
    return sweep.orderBy(F.desc("silhouette"), "k").first()["k"]


def run_clustering(feature_store: DataFrame, n_clusters: int = 4, seed: int = SEED,
                   starts: int = 20) -> tuple[DataFrame, KMeansModel]:
    """Add ``cluster_id`` with the number of clusters of the best silhouette.

    ``n_clusters`` is used for tables too small to compare several numbers.
    """
    vectors = cluster_vectors(feature_store).persist()
    ks = candidate_ks(vectors.count())
    k = best_k(k_sweep(vectors, ks, seed, min(starts, 10))) if ks else n_clusters
    model = best_of(vectors, k, starts, seed)
    clusters = model.transform(vectors).select(USER, CLUSTER)
    vectors.unpersist()
    return feature_store.join(clusters, USER), model


def cluster_distribution(clusters: DataFrame) -> DataFrame:
    sizes = clusters.groupBy(CLUSTER).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n").alias("_total"))
    return sizes.crossJoin(F.broadcast(total)).select(
        CLUSTER, "n", share_pct(F.col("n"), F.col("_total"), 1).alias("pct")
    )


def pca_projection(vectors: DataFrame) -> tuple[DataFrame, list[float]]:
    """Two principal components per user, and the share of variance of each."""
    centred = StandardScaler(
        inputCol="scaled", outputCol="centred", withMean=True, withStd=False
    ).fit(vectors).transform(vectors)
    model = PCA(k=2, inputCol="centred", outputCol="pc").fit(centred)
    parts = vector_to_array("pc")
    points = model.transform(centred).select(
        USER, parts[0].alias("pc1"), parts[1].alias("pc2")
    )
    return points, [float(v) for v in model.explainedVariance]


def cluster_profile(df: DataFrame, key: str = CLUSTER, groups: Sequence | None = None,
                    prefix: str = "Cluster ") -> DataFrame:
    """Mean of each cluster feature per group, with a row per feature and a column per group."""
    if key not in df.columns:
        raise KeyError(f"no {key} column to profile by")
    columns = cluster_columns(df)
    means = df.groupBy(key).agg(
        *[F.round(F.avg(F.col(c).cast("double")), 3).alias(c) for c in columns]
    )
    name = F.concat(F.lit(prefix), F.col(key).cast("string"))
    long = means.select(name.alias("_group"), *columns).unpivot(
        ["_group"], columns, "feature", "mean"
    )
    named = None if groups is None else [f"{prefix}{g}" for g in groups]
    return long.groupBy("feature").pivot("_group", named).agg(F.max("mean"))


def cluster_by_segment(df: DataFrame) -> DataFrame:
    """Users per cluster and segment, as a table with a column per segment."""
    return df.groupBy(CLUSTER).pivot(SEGMENT, [*SEGMENT_ORDER, UNCLASSIFIED]).count().na.fill(0)
