from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from stridelog.functions import ordered
from stridelog.functions.ordered import exact_quantiles, spread_row_number
from stridelog.operators import metrics, propensity


@pytest.fixture
def scored(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), "y INT, p DOUBLE")
    return build


def brute_auc(rows):
    pairs = [(a, b) for ya, a in rows if ya for yb, b in rows if not yb]
    return sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs)


def brute_ap(rows):
    hits = [p for y, p in rows if y]
    return sum(
        sum(1 for y, q in rows if y and q >= p) / sum(1 for _, q in rows if q >= p) for p in hits
    ) / len(hits)


def test_tied_scores_give_half(scored):
    got = metrics.rank_metrics(scored((0, 0.3), (1, 0.3), (0, 0.3), (1, 0.3))).first()
    assert got["roc_auc"] == 0.5 and got["pr_auc"] == 0.5


def test_one_class_gives_null(scored):
    got = metrics.full_eval_report(scored((0, 0.3), (0, 0.9))).first()
    assert got["roc_auc"] is None and got["pr_auc"] is None and got["precision"] == 0.0


@pytest.mark.parametrize("digits", [1, 2, 12])
def test_auc_and_ap_match_brute_force(spark, digits):
    rng = random.Random(digits)
    rows = []
    for _ in range(400):
        y = int(rng.random() < 0.3)
        p = min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * y, 0.2)))
        rows.append((y, round(p, digits)))
    rows += [(1, 1.0), (0, 0.0), (0, 1.0), (1, 0.0)]
    # Scores that differ only far behind the point share a cell and are told apart in it.
    rows += [(i % 2, 0.5 + i * 1e-12) for i in range(20)]
    got = metrics.rank_metrics(spark.createDataFrame(rows, "y INT, p DOUBLE")).first()
    assert got["roc_auc"] == pytest.approx(brute_auc(rows), abs=1e-12)
    assert got["pr_auc"] == pytest.approx(brute_ap(rows), abs=1e-12)


def test_metrics_per_group_match_single_runs(spark):
    rng = random.Random(5)
    rows = [(f"g{rng.randrange(3)}", int(rng.random() < 0.4), round(rng.random(), 3))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "fold STRING, y INT, p DOUBLE")
    grouped = {r["fold"]: r for r in metrics.full_eval_report(df, ["fold"]).collect()}
    for g in ("g0", "g1", "g2"):
        alone = metrics.full_eval_report(df.where(F.col("fold") == g)).first().asDict()
        assert {k: v for k, v in grouped[g].asDict().items() if k != "fold"} == alone


def test_threshold_edge_counts_as_flagged(scored):
    got = {r["threshold"]: r for r in metrics.threshold_analysis(
        scored((1, 0.5), (0, 0.1), (1, 0.9))).collect()}
    assert len(got) == 17
    assert got[0.5]["n_flagged"] == 2 and got[0.55]["n_flagged"] == 1
    assert got[0.5]["precision"] == 1.0 and got[0.1]["recall"] == 1.0


def test_confusion_matrix_has_empty_cells(scored):
    got = {(r[0], r[1]): r[2] for r in metrics.confusion_matrix(scored((1, 0.9))).collect()}
    assert got == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 1}


def test_tiers_use_inclusive_bounds(scored):
    got = metrics.lead_tiers(scored((0, 0.75), (0, 0.7499), (0, 0.5), (0, 0.25), (0, 0.0)))
    tiers = [r["upgrade_risk_tier"] for r in got.orderBy(F.desc("p")).collect()]
    assert tiers == ["HOT_LEAD", "WARM_LEAD", "WARM_LEAD", "NURTURE", "COLD"]


def test_histogram_of_one_value(scored):
    got = metrics.score_histogram(scored((1, 0.4), (1, 0.4)))
    assert got.count() == 50 and got.agg(F.sum("n")).first()[0] == 2
    assert got.agg(F.sum(F.col("density") / 50)).first()[0] == pytest.approx(1.0)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 101])
def test_small_quantiles(spark, n):
    rng = random.Random(n)
    rows = [(g, rng.choice([1.0, 2.5, rng.random() * 9])) for g in "ab" for _ in range(n)]
    rows.append(("c", None))
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    probs = {"q0": 0.0, "q1": 0.25, "q5": 0.5, "q7": 0.7, "q10": 1.0}
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    want = {r["g"]: r for r in df.where("v IS NOT NULL").groupBy("g").agg(
        *[F.percentile("v", F.lit(p)).alias(k) for k, p in probs.items()]).collect()}
    assert set(got) == set(want) == {"a", "b"}
    for g, row in want.items():
        for k in probs:
            assert got[g][k] == pytest.approx(row[k], abs=1e-9)


def test_large_quantiles_are_exact(spark):
    df = spark.range(300_000).selectExpr(
        "CAST(id % 3 = 0 AS INT) AS g", "xxhash64(id) % 1000003 / 7.0 AS v")
    probs = {"a": 0.1, "b": 0.5, "c": 0.999}
    got = exact_quantiles(df, [], "v", probs).first()
    want = df.agg(*[F.percentile("v", F.lit(p)).alias(k) for k, p in probs.items()]).first()
    assert [round(x, 9) for x in got] == [round(x, 9) for x in want]
    per_group = sorted(exact_quantiles(df, ["g"], "v", {"m": 0.5}).collect())
    plain = sorted(df.groupBy("g").agg(F.percentile("v", F.lit(0.5))).collect())
    assert [(r[0], round(r[1], 9)) for r in per_group] == [(r[0], round(r[1], 9)) for r in plain]


def test_folds_are_even_per_class(spark):
    df = spark.range(1001).selectExpr(
        "CAST(id AS STRING) AS person_id", "CAST(id % 10 = 0 AS INT) AS will_upgrade_in_7d")
    sizes = propensity.stratified_folds(df).groupBy("will_upgrade_in_7d", "fold").count().collect()
    for label in (0, 1):
        counts = [r["count"] for r in sizes if r["will_upgrade_in_7d"] == label]
        assert len(counts) == 3 and max(counts) - min(counts) <= 1


def test_row_numbers_are_those_of_a_plain_window(spark):
    df = spark.range(5000).selectExpr("md5(CAST(id AS STRING)) AS h")
    numbered = spread_row_number(df, [], "h", "rn").orderBy("rn").collect()
    assert [r["rn"] for r in numbered] == list(range(1, 5001))
    assert [r["h"] for r in numbered] == sorted(r["h"] for r in numbered)


def test_model_round_trip(spark, tmp_path):
    df = spark.range(400).selectExpr(
        "CAST(id AS STRING) AS person_id", "CAST(id % 4 = 0 AS INT) AS will_upgrade_in_7d",
        "CAST(IF(id % 4 = 0, 5 + id % 3, id % 5) AS DOUBLE) AS a",
        "IF(id % 9 = 0, NULL, CAST(id % 7 AS DOUBLE)) AS b")
    model = propensity.fit(df, ["a", "b"], trees=3)
    scores = propensity.predict_batch(model, df)
    assert scores.count() == 400
    assert scores.agg(F.count_if(F.col("upgrade_probability").isNull())).first()[0] == 0
    model.save(str(tmp_path / "m"))
    again = propensity.predict_batch(propensity.PropensityModel.load(spark, str(tmp_path / "m")), df)
    assert sorted(again.collect(), key=lambda r: r["person_id"]) == sorted(
        scores.collect(), key=lambda r: r["person_id"])
    twice = propensity.predict_batch(model, df.limit(3).unionAll(df.limit(3)))
    assert twice.count() == 6 and twice.columns[:4] == df.columns
    assert "Exchange hash" not in twice._jdf.queryExecution().executedPlan().toString()
    lacking = propensity.predict_batch(model, df.drop("b"))
    assert lacking.count() == 400
    drops = {r["feature"]: r["auc_drop"] for r in propensity.permutation_importance(
        model, df).collect()}
    assert drops["a"] > drops["b"]


def test_best_round_waits_with_patience():
    losses = [5.0, 4.0, 4.5, 4.2, 3.0, 3.5, 3.6, 3.7, 1.0]
    assert propensity.best_round(losses, 2) == 2
    assert propensity.best_round(losses, 3) == 5
    assert propensity.best_round(losses, 9) == 9


def test_early_stopping_cuts_the_trees(spark):
    df = spark.range(600).selectExpr(
        "CAST(id AS STRING) AS person_id", "CAST(xxhash64(id) % 3 = 0 AS INT) AS will_upgrade_in_7d",
        "CAST(xxhash64(id, 1) % 50 AS DOUBLE) AS a")  # nothing to learn
    model = propensity.fit(df.where("CAST(person_id AS INT) < 400"), ["a"],
                           df.where("CAST(person_id AS INT) >= 400"), trees=8, patience=2)
    assert model.n_trees == propensity.best_round(model.losses, 2) < 8
    assert len(model.losses) in (8, model.n_trees + 2)  # no tree beyond those patience asks for


def test_boosting_goes_on_from_stored_margins(spark):
    rows = spark.range(500).selectExpr(
        "CAST(xxhash64(id, 1) % 50 AS DOUBLE) AS a", "CAST(xxhash64(id, 2) % 9 AS DOUBLE) AS b",
        "1.0D AS _weight", "0.0D AS _margin").selectExpr("*", "CAST(a + b > 3 AS DOUBLE) AS _y")
    rows = propensity.VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    boosting = propensity.Boosting(rows)
    boosting.grow(propensity.STORE_TREES + propensity.ROUND_TREES)
    before = boosting.trees[:]
    boosting.grow(propensity.STORE_TREES + 2 * propensity.ROUND_TREES)
    assert boosting.trees[:len(before)] == before  # earlier trees stay as they are
    n = len(boosting.trees)
    margins = boosting._with_margin().select("features", "_margin")
    model = boosting.classifier(n, 2)
    both = model.transform(margins).select(
        "_margin", (propensity.vector_to_array("rawPrediction")[1] * 2).alias("m"))
    assert both.where(F.abs(F.col("_margin") - F.col("m")) > 1e-9).count() == 0
    assert model.getNumTrees == n


def test_steps_are_kept_with_the_margins(spark):
    """A round's passes read its steps from memory, and do not work them out of the margins."""
    rows = spark.range(300).selectExpr(
        "CAST(id % 50 AS DOUBLE) AS a", "2.0D AS _weight", "0.0D AS _margin",
        "CAST(id % 50 > 30 AS DOUBLE) AS _y")
    rows = propensity.VectorAssembler(inputCols=["a"], outputCol="features").transform(rows)
    boosting = propensity.Boosting(rows)
    boosting.grow(propensity.STORE_TREES + propensity.ROUND_TREES)
    kept = boosting._rows
    assert kept.storageLevel.useMemory and kept.columns[:len(rows.columns)] == rows.columns
    for r in kept.select("_y", "_weight", "_margin", "_slope_weight", "_target").collect():
        p = 1.0 / (1.0 + math.exp(-r["_margin"]))
        slope = max(p * (1.0 - p), 1e-6)
        assert r["_slope_weight"] == pytest.approx(2.0 * slope)
        assert r["_target"] == pytest.approx(min(max((r["_y"] - p) / slope, -4.0), 4.0))
    boosting.close()


def test_boosting_goes_on_until_patience_runs_out_by_auc(spark):
    df = spark.range(600).selectExpr(
        "CAST(id AS STRING) AS person_id", "CAST(xxhash64(id, 1) % 50 AS DOUBLE) AS a",
        "CAST(xxhash64(id, 2) % 50 AS DOUBLE) AS b").selectExpr(
        "*", "CAST(a + b + pmod(xxhash64(person_id), 20) > 10 AS INT) AS will_upgrade_in_7d")
    train, held = (df.where(f"CAST(person_id AS INT) {c} 400") for c in ("<", ">="))
    model = propensity.fit(train, ["a", "b"], held, trees=70, patience=3)
    n = len(model.losses)
    assert n == 70 or n - model.n_trees >= 3
    scores = propensity.scored(model, held).selectExpr("will_upgrade_in_7d AS y", f"{propensity.PROBA} AS p")
    auc = metrics.rank_metrics(scores).first()["roc_auc"]
    assert abs(1 - auc - model.losses[model.n_trees - 1]) < 1e-9
    assert (propensity.TREES, propensity.PATIENCE) == (1000, 100)


def test_losses_are_exact_however_their_scores_are_cut(spark, monkeypatch):
    rows = spark.range(900).selectExpr(
        "IF(id % 7 = 0, 1.0D, 0.0D) AS _y",
        "array(floor(id % 50 / 3), xxhash64(id) / 1e18, id % 7 + xxhash64(id, 1) / 1e18, 1.0D) AS _sums")
    each = rows.select(F.col("_y").alias("y"), F.posexplode("_sums").alias("tree", "p"))
    want = dict(metrics.rank_metrics(each, ["tree"]).select("tree", "roc_auc").collect())
    for size in (propensity.CELL_ROWS, 100):
        monkeypatch.setattr(propensity, "CELL_ROWS", size)
        assert propensity._aucs(rows, 4) == pytest.approx([want[i] for i in range(4)], abs=1e-12)
    assert propensity._aucs(rows.where("_y = 1"), 4) == [None] * 4


def test_boosting_spreads_rows_over_tasks(spark):
    rows = spark.range(120_000).selectExpr("0.0D AS _margin").coalesce(1)
    placed = propensity.Boosting._placed(rows)
    assert placed.rdd.getNumPartitions() >= 3
    placed.unpersist()


@pytest.mark.parametrize("few_groups", [True, False])
def test_quantiles_order_a_bounded_number_of_values(spark, monkeypatch, few_groups):
    """However large a group, no task orders more than the bound; several rounds are needed."""
    monkeypatch.setattr(ordered, "SMALL_GROUP", 20)
    tasks = []

    def narrowed(*args):
        rows, group = plain_narrowed(*args)
        tasks.append((rows.groupBy(*group).count().agg(F.max("count")).first()[0], group))
        return rows, group

    plain_narrowed = ordered.narrowed
    monkeypatch.setattr(ordered, "narrowed", narrowed)
    df = spark.range(100_000).selectExpr(
        "CASE WHEN id % 10 < 8 THEN 'hot' WHEN id < 50 THEN 'few' ELSE 'rest' END AS g",
        "IF(id % 7 = 0, 3.0, pow(xxhash64(id) % 100003 / 1000.0, 3)) AS v")
    probs = {"least": 0.0, "low": 0.001, "mid": 0.5, "also": 0.5, "high": 0.99, "most": 1.0}
    got = exact_quantiles(df, ["g"], "v", probs, few_groups, "n").collect()
    want = df.groupBy("g").agg(*[F.percentile("v", F.lit(p)).alias(k) for k, p in probs.items()],
                               F.count("v").alias("n")).collect()
    assert {r["g"]: [pytest.approx(x) for x in r[1:]] for r in want} == {
        r["g"]: list(r[1:]) for r in got}
    assert tasks[0][0] <= 20 and tasks[0][1] == ["g", "_all", "_i"]


def test_quantiles_of_nothing_and_of_odd_groups(spark):
    df = spark.createDataFrame([("a", None), (None, 1.0)], "g STRING, v DOUBLE")
    assert exact_quantiles(df, ["g"], "v", {"m": 0.5}).count() == 0
    assert exact_quantiles(df.where("v > 1"), [], "v", {"m": 0.5}).count() == 0
    assert exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"] == 1.0


def test_a_group_of_equal_values_is_one_row(spark):
    df = spark.range(200_000).selectExpr("CAST(IF(id % 10 = 0, id, 7) AS DOUBLE) AS v")
    got = exact_quantiles(df, [], "v", {"low": 0.05, "mid": 0.5, "high": 0.99}).first()
    want = [df.agg(F.percentile("v", F.lit(p))).first()[0] for p in (0.05, 0.5, 0.99)]
    assert [round(x, 9) for x in got] == [round(x, 9) for x in want]
