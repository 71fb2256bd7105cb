"""The upgrade-propensity model: folds, boosted trees, out-of-fold scores, batch scoring."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressionModel, GBTRegressionModel, RandomForestRegressor,
)
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelog.config import CUTOFF, FOLDS, LABEL, SEED, SPLIT, USER
from stridelog.functions.columns import long_form, numeric_columns
from stridelog.functions.ordered import exact_quantiles, spread_row_number
from stridelog.operators import metrics
from stridelog.session import written_once

NOT_FEATURES = (USER, CUTOFF, LABEL, SPLIT)
FOLD = "fold"
PROBA = "y_pred_proba"
SAMPLE_ROWS = 1000

# Boosting settings. Trees are fitted in rounds until patience runs out; each costs several jobs.
TREES, PATIENCE, DEPTH, STEP, SHARE, LEAF_ROWS = 1000, 100, 5, 0.05, 0.8, 20
# A round fits as many trees at once, in the same passes over the rows; each has its own share of
# rows and features.
ROUND_TREES = 10
# Trees between two writings of the margins.
STORE_TREES = 50
# The Newton step of one row is held within these bounds, against rows with p near 0 or 1.
LARGEST_STEP = 4.0
# Rows per task while boosting: some tenths of a second for every level of a round's trees.
TASK_ROWS = 50_000
# Margins of one tree that a task puts in order for an AUC, and how many it takes at least to cut
# them into sets of about that size.
CELL_ROWS, CUT_ROWS = 200_000, 1000
# Rows per task that run through a hundred trees or so for their margins.
LOSS_ROWS = 10_000


@dataclass(frozen=True)
class PropensityModel:
    """Fitted medians (a one-row table) and fitted trees, with the features they read."""

    features: tuple[str, ...]
    medians: DataFrame
    pipeline: PipelineModel
    losses: tuple[float, ...] = ()  # 1 - AUC of the validation rows, if given, after each tree

    @property
    def trees(self) -> GBTClassificationModel:
        return self.pipeline.stages[-1]

    @property
    def n_trees(self) -> int:
        return self.trees.getNumTrees

    def save(self, path: str) -> None:
        self.medians.write.mode("overwrite").parquet(f"{path}/medians")
        self.pipeline.write().overwrite().save(f"{path}/pipeline")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PropensityModel:
        medians = spark.read.parquet(f"{path}/medians")
        return cls(tuple(medians.columns), medians, PipelineModel.load(f"{path}/pipeline"))


def training_table(feature_store: DataFrame, splits: DataFrame) -> DataFrame:
    return feature_store.join(splits.select(USER, SPLIT), USER)


def get_feature_cols(df: DataFrame) -> list[str]:
    return numeric_columns(df, skip=NOT_FEATURES)


def feature_medians(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Exact median per feature, one row per feature; null for a feature without values."""
    long = long_form(df, [], features)
    found = exact_quantiles(long, ["feature"], "value", {"median": 0.5}, few_groups=True)
    names = df.sparkSession.createDataFrame([(f,) for f in features], "feature STRING")
    return names.join(found, "feature", "left")


def _wide(medians: DataFrame, features: Sequence[str]) -> DataFrame:
    return medians.groupBy().pivot("feature", list(features)).agg(F.max("median"))


def aligned(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The table with every feature as a double; those it lacks are null."""
    lacking = [f for f in features if f not in df.columns]
    return df.withColumns({f: F.lit(None).cast("double") for f in lacking})


def imputed(df: DataFrame, medians: DataFrame, features: Sequence[str]) -> DataFrame:
    """The features as doubles with nulls replaced by the fitted medians (or 0)."""
    named = medians.select(*[F.col(f).alias(f"_median_{f}") for f in features])
    filled = aligned(df, features).crossJoin(F.broadcast(named)).withColumns({
        f: F.coalesce(F.col(f).cast("double"), F.col(f"_median_{f}"), F.lit(0.0))
        for f in features
    })
    return filled.drop(*[f"_median_{f}" for f in features])


def stratified_folds(df: DataFrame, k: int = FOLDS, seed: int = SEED) -> DataFrame:
    """Add a fold from 1 to k; each class is dealt out evenly in the order of a hash."""
    keyed = df.withColumn("_hash", F.md5(F.concat(F.col(USER), F.lit(str(seed)))))
    dealt = spread_row_number(keyed, [LABEL], "_hash", "_rank")
    return dealt.withColumn(FOLD, (F.pmod(F.col("_rank") - 1, F.lit(k)) + 1).cast("int")).drop(
        "_hash", "_rank"
    )


def _weighted(df: DataFrame, train: DataFrame) -> DataFrame:
    """Add weights by which both classes of ``train`` count the same."""
    ratio = train.agg(
        F.try_divide(
            F.count_if(F.col(LABEL) == 0).cast("double"),
            F.count_if(F.col(LABEL) == 1).cast("double"),
        ).alias("_ratio")
    )
    return df.crossJoin(F.broadcast(ratio)).withColumn(
        "_weight", F.when(F.col(LABEL) == 1, F.coalesce("_ratio", F.lit(1.0))).otherwise(1.0)
    ).drop("_ratio")


def fit(train: DataFrame, features: Sequence[str], validation: DataFrame | None = None,
        trees: int = TREES, seed: int = SEED, patience: int = PATIENCE) -> PropensityModel:
    """Fit medians and trees on ``train``.

    With ``validation`` its AUC is taken after every tree, and the model keeps the trees up to
    the best one found before ``patience`` rounds went by without a better; see ``best_round``.
    Boosting goes on from the margins it has stored: no tree is fitted twice, and the model kept
    is a prefix of the trees. The AUCs are asked for only when patience may have run out, so
    that no more than ``best + patience`` trees are fitted.
    """
    medians = written_once(_wide(feature_medians(train, features), features), "medians")
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")

    def inputs(rows: DataFrame) -> DataFrame:
        return imputed(rows, medians, features).select(
            F.array(*features).alias("_x"), F.col(LABEL).cast("double").alias("_y"),
            *[c for c in ["_weight"] if c in rows.columns], F.lit(0.0).alias("_margin"))

    placed = inputs(_weighted(train, train)).withColumn("features", array_to_vector("_x"))
    boosting = Boosting(placed.drop("_x"), seed)
    losses: list[float] = []
    if validation is None:
        boosting.grow(trees)
        best = trees
    else:
        held_out, best = inputs(validation), 1
        while True:
            boosting.grow(min(best + patience, trees))
            more, held_out = _auc_losses(boosting.trees, held_out, len(losses))
            losses += more
            best = best_round(losses, patience)
            if len(losses) == trees or len(losses) - best >= patience:
                break
    boosting.close()
    model = boosting.classifier(best, len(features))
    return PropensityModel(tuple(features), medians, PipelineModel([assembler, model]),
                           tuple(losses))


class Boosting:
    """Boosted regression trees for the logistic loss that can be continued.

    ``rows`` has ``features``, ``_y`` (0 or 1), ``_weight`` and ``_margin``, the log-odds so far.
    A round fits ``ROUND_TREES`` trees to the Newton step of every row, (y - p) / (p (1 - p)), with
    the weights times p (1 - p), each over its own share of rows and features. They grow level by
    level in the same passes, which take most of the time whatever the size of the table. The rows
    with their margins and steps are kept in memory, and a round adds its trees to them once. After
    ``STORE_TREES`` trees the margins are written to the shared folder, so that plans stay short
    and a lost executor repeats only the rounds since.
    """

    def __init__(self, rows: DataFrame, seed: int = SEED) -> None:
        self.seed, self.trees, self._open = seed, [], 0
        self._columns = rows.columns
        self._before = self._placed(rows)
        self._rows = self._kept(self._before)

    @staticmethod
    def _placed(rows: DataFrame) -> DataFrame:
        """The rows in tasks of some size, kept so that later columns do not change the dealing."""
        tasks = -(-rows.count() // TASK_ROWS)
        return (rows.repartition(tasks) if tasks > 1 else rows.coalesce(1)).persist()

    @staticmethod
    def _kept(rows: DataFrame) -> DataFrame:
        """Each round is several passes, so the rows stay in memory, with the step to be fitted."""
        p = F.lit(1.0) / (1.0 + F.exp(-F.col("_margin")))
        slope = F.greatest(F.col("_p") * (1.0 - F.col("_p")), F.lit(1e-6))
        return rows.withColumn("_p", p).withColumns({
            "_slope_weight": F.col("_weight") * slope,
            "_target": F.greatest(F.least((F.col("_y") - F.col("_p")) / slope,
                                          F.lit(LARGEST_STEP)), F.lit(-LARGEST_STEP)),
        }).drop("_p").persist()

    def grow(self, count: int) -> None:
        """Go on until there are ``count`` trees."""
        while len(self.trees) < count:
            if self._open >= STORE_TREES:
                self._store()
            more = self._next_trees(min(ROUND_TREES, count - len(self.trees)))
            self.trees += more
            self._open += len(more)
            self._drop_before()  # the round has filled the rows of now
            self._before, self._rows = self._rows, self._kept(self._moved(more))

    def _moved(self, more: Sequence[DecisionTreeRegressionModel]) -> DataFrame:
        """The rows with the margin after some more trees."""
        model = _ensemble(GBTRegressionModel, more, [STEP] * len(more))
        return model.setPredictionCol("_step").transform(self._rows).withColumn(
            "_margin", F.col("_margin") + F.col("_step")).select(*self._columns)

    def _with_margin(self) -> DataFrame:
        """The rows with the margin after all trees."""
        return self._rows

    def _drop_before(self) -> None:
        if self._before is not None:
            self._before.unpersist()
            self._before = None

    def _store(self) -> None:
        moved = self._rows
        placed = self._placed(written_once(moved.select(*self._columns), "margins"))
        self._drop_before()
        self._before, self._rows = placed, self._kept(placed)
        moved.unpersist()
        self._open = 0

    def _next_trees(self, n: int) -> list[DecisionTreeRegressionModel]:
        forest = RandomForestRegressor(
            featuresCol="features", labelCol="_target", weightCol="_slope_weight", numTrees=n,
            bootstrap=False, maxDepth=DEPTH, subsamplingRate=SHARE,
            featureSubsetStrategy=str(SHARE), minInstancesPerNode=LEAF_ROWS,
            seed=self.seed + len(self.trees)).fit(self._rows)
        return list(forest.trees)

    def classifier(self, count: int, n_features: int) -> GBTClassificationModel:
        """The first ``count`` trees as a model. Spark's takes half the log-odds as margin."""
        model = _ensemble(GBTClassificationModel, self.trees[:count], [STEP / 2] * count,
                          n_features, 2)
        return model.setFeaturesCol("features")

    def close(self) -> None:
        self._drop_before()
        self._rows.unpersist()


def _ensemble(kind: type, trees: Sequence[DecisionTreeRegressionModel],
              weights: Sequence[float], *sizes: int):
    """Single trees put together as one of Spark's ensemble models."""
    jvm = SparkContext.getOrCreate()._jvm
    package = "classification" if kind is GBTClassificationModel else "regression"
    tree_class = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    java_kind = getattr(getattr(jvm.org.apache.spark.ml, package), kind.__name__)
    java_trees = JavaWrapper._new_java_array([t._java_obj for t in trees], tree_class)
    java_weights = JavaWrapper._new_java_array(
        [float(w) for w in weights], SparkContext._gateway.jvm.double)
    return kind(java_kind(f"{kind.__name__}_{uuid.uuid4().hex[:12]}", java_trees, java_weights,
                          *sizes))


def _auc_losses(trees: Sequence[DecisionTreeRegressionModel], rows: DataFrame,
                done: int) -> tuple[list[float], DataFrame]:
    """1 - AUC of ``rows`` after each tree from number ``done`` on, and the rows with the sum of
    all trees, from which the next call goes on. A group of one class has an AUC of 0.

    The trees run once, as one model that tells the leaf a row falls into in each of them; the
    leaves' values, a table of trees times leaves, turn these into running sums.
    """
    new = trees[done:]
    numbers = np.arange(len(new))
    values = np.array([*zip_longest(*[_leaf_values(t) for t in new], fillvalue=0.0)]).T * STEP
    model = _ensemble(GBTRegressionModel, new, [STEP] * len(new)).setLeafCol("_leaf")
    tasks = max(-(-rows.count() // LOSS_ROWS), 1)
    leaves = model.setPredictionCol("").transform(
        rows.repartition(tasks).withColumn("features", array_to_vector("_x"))).select(
        "_x", "_y", "_margin", vector_to_array("_leaf").alias("_leaf"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                leaf = part.column(3).flatten().to_numpy().reshape(-1, len(numbers)).astype(int)
                steps = np.column_stack([part.column(2).to_numpy(), values[numbers, leaf]])
                sums = np.cumsum(steps, axis=1)[:, 1:]
                ends = np.arange(len(sums) + 1, dtype=np.int32) * len(numbers)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(sums.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), lists], ["_x", "_y", "_sums"])

    rows = written_once(
        leaves.mapInArrow(run, "_x ARRAY<DOUBLE>, _y DOUBLE, _sums ARRAY<DOUBLE>"), "margins")
    losses = [1 - (auc or 0.0) for auc in _aucs(rows, len(new))]
    return losses, rows.select("_x", "_y", F.element_at("_sums", -1).alias("_margin"))


def _aucs(rows: DataFrame, n: int) -> list[float | None]:
    """The exact AUC of each of the ``n`` scores in ``_sums``; none where ``_y`` has one class.

    Tasks count the equal scores of a batch, and a (tree, cell) of scores is put in order by one
    task. Some rows' scores are the cells' bounds, so that a cell holds about ``CELL_ROWS`` of
    them; the result does not hang on the bounds.
    """
    total = rows.count()
    cells = -(-total // CELL_ROWS)
    bounds = np.zeros((n, 0))
    if cells > 1:
        share = min(1.0, CUT_ROWS * cells / total)
        some = np.array([r[0] for r in rows.select("_sums").sample(share, seed=SEED).collect()])
        if len(some):
            bounds = np.quantile(some, np.arange(1, cells) / cells, axis=0).T

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            y = part.column(0).to_numpy(zero_copy_only=False)
            sums = part.column(1).flatten().to_numpy().reshape(-1, n)
            out = []
            for tree in range(n):
                score, of = np.unique(sums[:, tree], return_inverse=True)
                counts = [np.bincount(of[y == v], minlength=len(score)) for v in (1, 0)]
                ends = [0, *np.searchsorted(score, bounds[tree]), len(score)]
                out += [(tree, cell, *(v[i:j].tobytes() for v in (score, *counts)))
                        for cell, (i, j) in enumerate(zip(ends, ends[1:])) if i < j]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), COUNTED.types)], COUNTED.names)

    def ranked(counted: pa.Table) -> pa.Table:
        score, pos, neg = (np.concatenate([np.frombuffer(v, t) for v in counted[c].to_pylist()])
                           for c, t in (("score", np.float64), ("pos", np.int64), ("neg", np.int64)))
        _, of = np.unique(score, return_inverse=True)
        # Sums of up to 2^53 rows, so they are exact.
        pos, neg = np.bincount(of, pos).astype(int), np.bincount(of, neg).astype(int)
        pairs = (pos * (2 * (np.cumsum(neg) - neg) + neg)).sum()  # a tie is half a pair
        return pa.table({"tree": counted["tree"][:1], "cell": counted["cell"][:1],
                         "pos": [pos.sum()], "neg": [neg.sum()], "pairs": [pairs]})

    found = rows.select("_y", "_sums").mapInArrow(
        cut, "tree INT, cell INT, score BINARY, pos BINARY, neg BINARY"
    ).groupBy("tree", "cell").applyInArrow(
        ranked, "tree INT, cell INT, pos LONG, neg LONG, pairs LONG").collect()
    pos, neg, pairs = [0] * n, [0] * n, [0] * n
    for r in sorted(found):  # twice the pairs that are in the right order, cell by cell
        pairs[r["tree"]] += r["pairs"] + 2 * r["pos"] * neg[r["tree"]]
        pos[r["tree"]] += r["pos"]
        neg[r["tree"]] += r["neg"]
    return [t / (2 * p * q) if p and q else None for t, p, q in zip(pairs, pos, neg)]


COUNTED = pa.schema([("tree", pa.int32()), ("cell", pa.int32()), ("score", pa.binary()),
                     ("pos", pa.binary()), ("neg", pa.binary())])


def _leaf_values(tree: DecisionTreeRegressionModel) -> list[float]:
    """The values of a tree's leaves in their order, as the tree's description lists them."""
    return [float(v) for v in re.findall(r"Predict: (\S+)", tree.toDebugString)]


def best_round(losses: Sequence[float], patience: int) -> int:
    """The round, from 1, of the least loss before ``patience`` rounds without a lesser one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def scored(model: PropensityModel, df: DataFrame, name: str = PROBA) -> DataFrame:
    """Add the model's probability; features become doubles without nulls."""
    return with_probability(model, imputed(df, model.medians, model.features), name)


def with_probability(model: PropensityModel, filled: DataFrame, name: str) -> DataFrame:
    """Add the model's probability to a table with all features imputed."""
    probability = vector_to_array("probability")[1]
    return model.pipeline.transform(filled).withColumn(name, probability).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def fit_folds(table: DataFrame, k: int = FOLDS, trees: int = TREES, seed: int = SEED,
              patience: int = PATIENCE) -> tuple[DataFrame, dict[int, PropensityModel]]:
    """The rows with their fold, and for every fold the model of all others, stopped by it.

    A fold's model has seen neither its rows nor their medians. Folds are independent, so their
    jobs run side by side.
    """
    features = get_feature_cols(table)
    folded = written_once(stratified_folds(table, k, seed), "folds")

    def one(fold: int) -> PropensityModel:
        return fit(folded.where(F.col(FOLD) != fold), features, folded.where(F.col(FOLD) == fold),
                   trees, seed, patience)

    folds = range(1, k + 1)
    with ThreadPoolExecutor(k) as pool:
        models = list(pool.map(inheritable_thread_target(table.sparkSession)(one), folds))
    return folded, dict(zip(folds, models))


def out_of_fold(folded: DataFrame, models: dict[int, PropensityModel]
                ) -> tuple[DataFrame, DataFrame]:
    """Out-of-fold scores ``(person_id, fold, y_true, y_pred_proba)`` and, per fold, the best
    number of trees, the trees that were fitted, and the loss (1 - AUC) after each."""
    out = reduce(DataFrame.unionByName, [
        scored(model, folded.where(F.col(FOLD) == fold)).select(
            USER, FOLD, F.col(LABEL).cast("int").alias("y_true"), PROBA)
        for fold, model in models.items()])
    iterations = folded.sparkSession.createDataFrame(
        [(fold, m.n_trees, len(m.losses), list(m.losses)) for fold, m in models.items()],
        "fold INT, best_iteration INT, rounds INT, losses ARRAY<DOUBLE>")
    return written_once(out, "out-of-fold"), iterations


def cross_validate(table: DataFrame, k: int = FOLDS, trees: int = TREES, seed: int = SEED,
                   patience: int = PATIENCE) -> tuple[DataFrame, DataFrame]:
    """``out_of_fold`` of the models of ``fit_folds``."""
    return out_of_fold(*fit_folds(table, k, trees, seed, patience))


def as_scored(oof: DataFrame) -> DataFrame:
    """Out-of-fold scores in the form the metrics take."""
    return oof.select(USER, FOLD, F.col("y_true").alias("y"), F.col(PROBA).alias("p"))


def median_iteration(iterations: DataFrame) -> int:
    value = iterations.agg(F.percentile("best_iteration", F.lit(0.5)).alias("m")).first()["m"]
    return max(1, int(value))


def refit(table: DataFrame, trees: int, seed: int = SEED) -> PropensityModel:
    """Fit on train and validation rows together."""
    rows = table.where(F.col(SPLIT).isin("train", "validation"))
    return fit(rows, get_feature_cols(table), trees=trees, seed=seed)


def score_split(model: PropensityModel, table: DataFrame, split: str = "test") -> DataFrame:
    rows = scored(model, table.where(F.col(SPLIT) == split))
    return rows.select(USER, F.col(LABEL).cast("int").alias("y"), F.col(PROBA).alias("p"))


def predict_batch(model: PropensityModel, feature_store: DataFrame) -> DataFrame:
    """Add probability (four digits), tier and action to every row of a table.

    The tier goes by the unrounded probability. The table keeps its rows and its own columns as
    they are, which travel along while features it lacks are imputed; columns with the names of
    the added ones give way. Nothing is joined but the one row of medians.
    """
    added = ("upgrade_probability", "upgrade_risk_tier", "recommended_action")
    own = F.struct(*[c for c in feature_store.columns if c not in added]).alias("_row")
    present = [f for f in model.features if f in feature_store.columns]
    filled = imputed(feature_store.select(own, *present), model.medians, model.features)
    tiers = metrics.lead_tiers(with_probability(model, filled, "_p").select("_row", "_p"), "_p")
    return tiers.withColumn("upgrade_probability", F.round("_p", 4)).select("_row.*", *added)


def feature_importance(model: PropensityModel, spark: SparkSession) -> DataFrame:
    """Importance per feature with its rank and its share of the whole."""
    weights = model.trees.featureImportances.toArray()
    ranked = sorted(zip(model.features, map(float, weights)), key=lambda r: (-r[1], r[0]))
    total = float(sum(weights)) or 1.0
    rows = [(i, f, w, w / total) for i, (f, w) in enumerate(ranked, start=1)]
    return spark.createDataFrame(
        rows, "rank INT, feature STRING, importance DOUBLE, share DOUBLE"
    )


def top_features(model: PropensityModel, feature_store: DataFrame, n: int = 3) -> DataFrame:
    """Every user's values (imputed) of the model's most important features."""
    names = [
        r["feature"]
        for r in feature_importance(model, feature_store.sparkSession).where(F.col("rank") <= n)
        .orderBy("rank").collect()
    ]
    filled = imputed(feature_store, model.medians, model.features)
    pairs = [part for name in names for part in (F.lit(name), F.col(name))]
    return filled.select(USER, F.create_map(*pairs).alias("top_features"))


def seeded_sample(df: DataFrame, n: int = SAMPLE_ROWS, seed: int = SEED) -> DataFrame:
    """``n`` rows without replacement, the same for the same seed."""
    order = F.md5(F.concat(F.col(USER), F.lit(str(seed))))
    return df.orderBy(order, USER).limit(n)


def permutation_importance(model: PropensityModel, table: DataFrame, n: int | None = None,
                           seed: int = SEED) -> DataFrame:
    """Fall in ROC-AUC when one feature's values are shuffled, over all rows of ``table``.

    The rows should be such as the model has not seen. ``n`` takes a seeded sample of them. All
    shuffled copies are scored in one pass.
    """
    features = list(model.features)
    rows = imputed(table if n is None else seeded_sample(table, n, seed), model.medians, features)
    numbered = rows.select(USER, LABEL, *features)
    for name in ("own", "other"):
        digest = F.md5(F.concat(F.col(USER), F.lit(f"{seed}/{name}")))
        numbered = spread_row_number(
            numbered.withColumn("_digest", digest), [], "_digest", f"_{name}").drop("_digest")
    donors = numbered.select(
        F.col("_other").alias("_own"), F.struct(*features).alias("_donor")
    )
    copies = numbered.join(donors, "_own").withColumn(
        "shuffled", F.explode(F.array(*[F.lit(f) for f in ("", *features)]))
    )
    mixed = copies.withColumns({
        f: F.when(F.col("shuffled") == f, F.col(f"_donor.{f}")).otherwise(F.col(f))
        for f in features
    }).select(USER, LABEL, "shuffled", *features)
    scores = scored(model, mixed, "p").select(
        "shuffled", F.col(LABEL).cast("int").alias("y"), "p"
    )
    aucs = metrics.rank_metrics(scores, ["shuffled"]).select("shuffled", "roc_auc")
    base = aucs.where("shuffled = ''").select(F.col("roc_auc").alias("base_auc"))
    return aucs.where("shuffled <> ''").crossJoin(F.broadcast(base)).select(
        F.col("shuffled").alias("feature"), "base_auc", F.col("roc_auc").alias("shuffled_auc"),
        (F.col("base_auc") - F.col("roc_auc")).alias("auc_drop"),
    )


def model_metadata(table: DataFrame, oof: DataFrame, iterations: DataFrame,
                   test_scores: DataFrame) -> DataFrame:
    """One row that describes a training run: sizes, scores per fold and over all."""
    overall = metrics.rank_metrics(as_scored(oof)).select(
        F.round("roc_auc", 4).alias("oof_auc"), F.round("pr_auc", 4).alias("oof_pr_auc")
    )
    test = metrics.rank_metrics(test_scores).select(
        F.round("roc_auc", 4).alias("test_auc"), F.round("pr_auc", 4).alias("test_pr_auc")
    )
    sizes = table.agg(*[
        F.count_if(F.col(SPLIT) == split).alias(name)
        for split, name in (("train", "n_train"), ("validation", "n_val"), ("test", "n_test"))
    ])
    folds = metrics.fold_scores(as_scored(oof), iterations).agg(
        F.sort_array(F.collect_list(F.struct(
            "fold", "n_val", "n_pos", "auc", "pr_auc", "best_iteration"
        ))).alias("fold_scores"),
        F.percentile("best_iteration", F.lit(0.5)).cast("int").alias("median_best_iter"),
    )
    best = metrics.best_threshold(test_scores).select(
        F.col("threshold").alias("threshold_at_max_f1")
    )
    row = overall
    for part in (test, sizes, folds, best):
        row = row.crossJoin(F.broadcast(part))
    return row.withColumns({
        "n_features": F.lit(len(get_feature_cols(table))),
        "trained_at": F.current_timestamp(),
    })
