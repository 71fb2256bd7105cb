from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from stridelog.operators import clustering, report, segments, transitions

ZEROS = dict.fromkeys(segments.REQUIRED_COLUMNS, 0.0)


@pytest.fixture
def store(spark):
    def build(*rows):
        full = [{**ZEROS, "person_id": f"u{i}", **r} for i, r in enumerate(rows)]
        return spark.createDataFrame(full)
    return build


def names(df):
    return [r["funnel_segment"] for r in df.orderBy("person_id").collect()]


def test_first_matching_rule_wins(store):
    power = dict(hit_aha_moment=1.0, feature_breadth=4.0, ai_generation_count=10.0,
                 run_block_count=3.0, agent_chat_count=2.0, unique_event_types=20.0)
    df = store(
        power, {**power, "unique_event_types": 19.0}, dict(run_block_count=1.0, total_events=5.0,
                                                           unique_event_types=3.0),
        dict(total_events=29.0), dict(total_events=50.0, days_since_last_event=15.0),
        dict(total_events=50.0),
    )
    assert names(segments.with_segment(df)) == [
        "Power User", "AI Builder", "Creator", "Onboarding", "Dormant", "Unclassified"]


def test_too_many_unclassified_raise(store):
    df = store(*[dict(total_events=50.0)] * 2, *[dict(total_events=1.0)] * 8)
    with pytest.raises(ValueError, match="match no segment rule"):
        segments.assign_segments(df)
    assert segments.assign_segments(df, limit_pct=20.0).count() == 10


def test_missing_columns_raise(store):
    with pytest.raises(KeyError, match="active_days"):
        segments.with_segment(store(dict()).drop("active_days"))


def test_own_rules(store):
    rules = segments.rules_from({"big": "total_events>=10", "small": "total_events==1"})
    df = store(dict(total_events=12.0), dict(total_events=1.0), dict(total_events=2.0))
    assert names(segments.with_segment(df, rules)) == ["big", "small", "Unclassified"]


def test_short_log_has_no_transitions(log):
    events = log(("a", "2024-01-01 00:00:00", "x"), ("a", "2024-01-14 00:00:00", "x"))
    assert transitions.snapshot_boundaries(events).count() == 0
    assert transitions.transition_counts(events).count() == 0
    assert transitions.compute_transition_matrix(events).count() == 0


def test_boundaries(log):
    events = log(("a", "2024-01-01 10:00:00", "x"), ("a", "2024-01-20 12:00:00", "x"))
    got = [r["boundary"] for r in transitions.snapshot_boundaries(events).orderBy("place").collect()]
    assert got == [dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 21)]


def test_event_on_a_boundary_counts_for_it(log):
    events = log(
        ("a", "2024-01-01 00:00:00", "x"), ("a", "2024-01-08 00:00:00", "x"),
        ("a", "2024-01-08 00:00:00.000001", "y"), ("a", "2024-01-20 00:00:00", None),
        ("b", "2024-01-16 00:00:00", "agent_x"),
    )
    got = {(r["person_id"], r["place"]): r for r in transitions.snapshot_features(events).collect()}
    assert got["a", 1]["total_events"] == 2 and got["a", 2]["total_events"] == 3
    assert got["a", 3]["total_events"] == 3 and got["a", 3]["unique_event_types"] == 2
    assert got["a", 3]["active_days"] == 3 and ("b", 2) not in got
    assert got["b", 3]["agent_chat_count"] == 1 and got["b", 3]["feature_breadth"] == 1
    assert got["a", 1]["days_since_last_event"] == 0.0


def test_rows_of_the_matrix_add_up_to_one(log):
    rows = []
    for u in range(12):
        for day in range(1, 29, 1 + u % 4):
            rows.append((f"u{u}", f"2024-01-{day:02d} 01:00:00", f"e{(u * day) % 9}"))
    probs = transitions.transition_probabilities(log(*rows))
    for r in probs.groupBy("from_segment").agg(F.sum("prob").alias("s")).collect():
        assert r["s"] == pytest.approx(1.0, abs=1e-3)
    matrix = transitions.active_targets(transitions.compute_transition_matrix(log(*rows)))
    assert set(matrix.columns) - {"from_segment"} == {
        r["to_segment"] for r in probs.collect()}


def test_scaling_leaves_a_constant_column_alone(spark):
    df = spark.createDataFrame([(str(i), float(i), 3.0) for i in range(5)],
                               "person_id STRING, a DOUBLE, b DOUBLE")
    got = clustering.robust_scaled(df, ["a", "b"]).orderBy("person_id").collect()
    assert [r["a"] for r in got] == [-1.0, -0.5, 0.0, 0.5, 1.0]
    assert [r["b"] for r in got] == [0.0] * 5


def test_clusters_find_two_groups(spark):
    df = spark.range(60).selectExpr(
        "CAST(id AS STRING) AS person_id", "CAST(IF(id < 30, 0, 100) + id % 3 AS DOUBLE) AS total_events",
        "CAST(IF(id < 30, 0, 50) + id % 2 AS DOUBLE) AS active_days")
    with pytest.warns(UserWarning):
        found, _ = clustering.run_clustering(df, starts=2)
    groups = found.groupBy((F.col("total_events") > 50).alias("far")).agg(
        F.count_distinct("cluster_id").alias("n")).collect()
    assert [r["n"] for r in groups] == [1, 1] and found.select("cluster_id").distinct().count() == 2


def test_tiny_tables_use_the_given_number_of_clusters(spark):
    df = spark.range(8).selectExpr("CAST(id AS STRING) AS person_id", "CAST(id AS DOUBLE) AS total_events")
    with pytest.warns(UserWarning):
        found, model = clustering.run_clustering(df, n_clusters=3, starts=1)
    assert found.count() == 8 and len(model.clusterCenters()) == 3
    with pytest.raises(ValueError):
        clustering.cluster_columns(spark.range(1))


@pytest.fixture(scope="module")
def blobs(spark):
    """1,200 points about six places of a plane, some more than once."""
    rng = np.random.default_rng(5)
    places = rng.uniform(-50, 50, (6, 2))
    rows = [(str(i), Vectors.dense(places[i % 6] + rng.normal(size=2).round(1))) for i in range(1200)]
    return spark.createDataFrame(rows, ["person_id", "scaled"]).repartition(3).persist()


def test_all_fits_share_their_scans_and_cost_no_more_than_single_fits(blobs, monkeypatch):
    scans = []
    sums = clustering._nearest_sums

    def counted(points, fits):
        scans.append(len(fits))
        return sums(points, fits)

    monkeypatch.setattr(clustering, "_nearest_sums", counted)
    found = clustering.fit_all(blobs, range(2, 8), starts=5)
    # Three scans for the candidates, one for their weights, then one a step for all fits left.
    steps = scans[4:]
    assert steps[0] == 30 and steps == sorted(steps, reverse=True) and len(scans) < 60
    for k in (2, 4, 6):
        single = [KMeans(k=k, seed=s, featuresCol="scaled", maxIter=100).fit(blobs)
                  .summary.trainingCost for s in range(5)]
        assert found[k].cost <= min(single) * 1.0001
        placed = found[k].transform(blobs).select("scaled", clustering.CLUSTER).collect()
        cost = sum(((r["scaled"].toArray() - found[k].centres[r[1]]) ** 2).sum() for r in placed)
        assert cost == pytest.approx(found[k].cost)
        assert {r[1] for r in placed} == set(range(k))


def test_fits_do_not_hang_on_partitions_and_can_be_saved(blobs, tmp_path):
    one = clustering.best_of(blobs.coalesce(1), 6, 3)
    other = clustering.best_of(blobs.repartition(7, "person_id"), 6, 3)
    assert np.allclose(one.centres, other.centres) and one.cost == pytest.approx(other.cost)
    one.save(str(tmp_path / "model"))
    one.save(str(tmp_path / "model"))
    again = clustering.KMeansModel.load(str(tmp_path / "model"))
    assert (again.centres == one.centres).all() and again.cost == one.cost


def test_fewer_kinds_of_users_than_clusters(spark):
    df = spark.createDataFrame([(str(i), Vectors.dense([float(i % 2), 1.0])) for i in range(50)],
                               ["person_id", "scaled"])
    model = clustering.best_of(df, 4, 2)
    assert sorted(c.tolist() for c in model.centres) == [[0.0, 1.0], [1.0, 1.0]] and model.cost == 0


def test_report_without_predictions_has_nulls(store):
    df = segments.with_segment(store(dict(total_events=1.0), dict(total_events=2.0)))
    got = report.generate_full_report(df, features=["total_events", "active_days"]).first()
    assert got["mean_upgrade_prob"] is None and got["actual_conversion_rate"] is None
    assert [t["feature"] for t in got["top_diagnostic_features"]] == ["active_days", "total_events"]


def test_scans_spread_users_over_tasks(spark, monkeypatch):
    """Users that come in one partition are dealt out, and the fit stays that of one task."""
    df = spark.range(400).selectExpr(
        "CAST(id AS STRING) AS person_id", "array(CAST(id % 4 * 10 AS DOUBLE), id % 7 / 70D) AS x")
    points = df.select("person_id", array_to_vector("x").alias("scaled")).coalesce(1)
    whole, sums, tasks = clustering.best_of(points, 4, 2), clustering._nearest_sums, set()

    def counting(rows, fits):
        tasks.add(rows.rdd.getNumPartitions())
        return sums(rows, fits)

    monkeypatch.setattr(clustering, "TASK_USERS", 100)
    monkeypatch.setattr(clustering, "SCAN_ROWS", 30)
    monkeypatch.setattr(clustering, "_nearest_sums", counting)
    spread = clustering.best_of(points, 4, 2)
    assert tasks == {4}
    assert abs(spread.cost - whole.cost) < 1e-9
