from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stridelog.config import FEATURES, SkewPolicy
from stridelog.functions import skew
from stridelog.operators import features, labels
from stridelog.sources.events import session_of, without_banned


def row(df, user):
    return df.where(F.col("person_id") == user).first()


def test_cutoff_is_first_upgrade_else_last_event(log):
    events = log(
        ("a", "2024-01-01 00:00:00", "sign_in"),
        ("a", "2024-01-02 00:00:00", "subscription_upgraded"),
        ("a", "2024-01-05 00:00:00", "subscription_upgraded"),
        ("b", "2024-01-03 00:00:00", "sign_in"),
        ("b", "2024-01-04 00:00:00", "credits_exceeded"),
    )
    found = {r["person_id"]: r["user_cutoff_ts"] for r in labels.user_cutoffs(events).collect()}
    assert found == {"a": dt.datetime(2024, 1, 2), "b": dt.datetime(2024, 1, 4)}


def test_event_at_cutoff_counts_and_one_after_does_not(log, cutoffs):
    events = log(
        ("a", "2024-01-10 00:00:00", "x"),
        ("a", "2024-01-10 00:00:00.000001", "y"),
    )
    clean = labels.clean_events(events, cutoffs(a="2024-01-10 00:00:00"))
    assert [r["event"] for r in clean.collect()] == ["x"]


def test_null_events_go_in_sql_form_and_stay_in_labelled_form(log, cutoffs):
    events = log(("a", "2024-01-01 00:00:00", None), ("a", "2024-01-01 00:00:00", "x"))
    cut = cutoffs(a="2024-01-02 00:00:00")
    assert labels.clean_events(events, cut).count() == 1
    assert labels.clean_events(events, cut, keep_null_events=True).count() == 2
    assert without_banned(events).count() == 2
    assert without_banned(events, keep_null=False).count() == 1


def test_window_edges_are_half_open(log, cutoffs):
    events = log(
        ("a", "2024-01-31 00:00:00", "x"),
        ("a", "2024-01-24 00:00:00", "x"),  # exactly 7 days before
        ("a", "2024-01-24 00:00:00.000001", "x"),
        ("a", "2024-01-01 00:00:00", "x"),  # exactly 30 days before
    )
    got = features.compute_velocity(events, cutoffs(a="2024-01-31 00:00:00")).first()
    assert (got["events_last_7d"], got["events_last_14d"], got["events_last_30d"]) == (2, 3, 3)
    assert got["events_last_14_to_7d"] == 1
    assert got["wow_growth"] == (2 - 1) / 2.0 and got["is_accelerating"] == 1


def test_users_without_events_get_zeros(log, cutoffs, spark):
    events = log(
        ("a", "2024-01-01 00:00:00", "x", "s1"),
        ("banned", "2024-01-01 00:00:00", "credits_exceeded"),
    )
    known = cutoffs(a="2024-01-02 00:00:00", banned="2024-01-02 00:00:00",
                    silent="2024-01-02 00:00:00").withColumn("will_upgrade_in_7d", F.lit(0))
    store = features.build_feature_store(events, known)
    assert store.count() == 3
    for user in ("banned", "silent"):
        found = row(store, user)
        assert all(found[c] == 0 for c in FEATURES)
    assert row(store, "a")["total_sessions"] == 1
    assert store.select([F.count_if(F.col(c).isNull()) for c in FEATURES]).first() == (0,) * 22


def test_sessions_in_each_layout(log, cutoffs, spark):
    flat = log(("a", "2024-01-01 00:00:00", "x", "s1"), ("a", "2024-01-01 00:00:00", "x", "s2"),
               ("a", "2024-01-01 00:00:00", "x", None))
    cut = cutoffs(a="2024-01-02 00:00:00")
    bare = flat.drop("canvas_id")
    layouts = [
        flat,
        bare.withColumn("properties.canvas_id", F.lit("s1")),
        flat.withColumn("properties", F.struct("canvas_id")).drop("canvas_id"),
        flat.withColumn("properties", F.create_map(F.lit("canvas_id"), "canvas_id"))
        .drop("canvas_id"),
        flat.withColumn("properties", F.to_json(F.struct("canvas_id"))).drop("canvas_id"),
        bare,
    ]
    found = [features.compute_engagement(e, cut).first()["total_sessions"] for e in layouts]
    assert found == [2, 1, 2, 2, 2, 0]
    assert bare.select(session_of(bare)).schema[0].dataType.typeName() == "string"


def test_no_sessions_means_no_events_per_session(log, cutoffs):
    got = features.compute_engagement(log(("a", "2024-01-01 00:00:00", "x")),
                                      cutoffs(a="2024-01-02 00:00:00")).first()
    assert got["avg_events_per_session"] == 0.0


def test_account_age_falls_back_to_first_event(log, cutoffs):
    events = log(
        ("a", "2024-01-01 00:00:00", "x"), ("a", "2024-01-05 00:00:00", "new_user_created"),
        ("b", "2024-01-01 12:00:00", "x"),
    )
    cut = cutoffs(a="2024-01-11 00:00:00", b="2024-01-11 00:00:00")
    got = features.compute_recency(events, cut)
    assert row(got, "a")["account_age_days"] == 6.0
    assert row(got, "b")["account_age_days"] == 9.5
    assert features.tenure_fallbacks(events, cut).first() == (2, 1)


def test_later_events_change_nothing(log, cutoffs):
    before = [("a", f"2024-01-0{i} 10:00:00", e) for i, e in
              enumerate(["run_block", "$ai_generation", "$exception", "new_user_created"], 1)]
    after = [("a", "2024-02-01 00:00:00", e) for e in ("run_block", "agent_new_chat", "z")]
    cut = cutoffs(a="2024-01-05 00:00:00").withColumn("will_upgrade_in_7d", F.lit(1))
    one = features.build_feature_store(log(*before), cut).first()
    two = features.build_feature_store(log(*before, *after), cut).first()
    assert one == two


def test_bad_cutoff_aborts(log, cutoffs):
    broken = cutoffs(a="2024-01-01 00:00:00").withColumn("user_cutoff_ts", F.lit("not a time"))
    with pytest.raises(ValueError, match="no usable"):
        features.build_feature_store(log(("a", "2024-01-01 00:00:00", "x")),
                                     broken.withColumn("will_upgrade_in_7d", F.lit(0)))


def test_social_events_are_counted_once_named(log, cutoffs):
    events = log(("a", "2024-01-01 00:00:00", "invited"), ("b", "2024-01-01 00:00:00", "x"))
    cut = cutoffs(a="2024-01-02 00:00:00", b="2024-01-02 00:00:00")
    found = features.compute_social(events, cut, ["invited"])
    assert {r[0]: r[1] for r in found.collect()} == {"a": 1, "b": 0}
    assert features.compute_social(events, cut).agg(F.sum("is_social_user")).first()[0] == 0


@pytest.fixture
def skewed(log):
    """One user owns two thirds of the log."""
    names = ["run_block", "$ai_generation", "x", "y", None, "$exception", "new_user_created"]
    rows = []
    for i in range(300):
        user = "hot" if i % 3 else f"u{i % 10}"
        rows.append((user, f"2024-01-{1 + i % 28:02d} {i % 24:02d}:{i % 60:02d}:00",
                     names[i % 7], f"s{i % 11}"))
    return log(*rows)


def test_hot_user_is_cut_into_pieces_without_changing_results(skewed, monkeypatch):
    cut = labels.user_cutoffs(skewed)
    plain = features.event_features(skewed, cut)
    expected = sorted(plain.collect())
    counts = sorted(labels.event_counts(skewed, cut).collect())
    assert skew.hot_users(skewed).count() == 0

    monkeypatch.setattr(skew, "SKEW", SkewPolicy(rows_per_piece=20, max_hot_users=1000))
    hot = skew.hot_users(skewed).collect()
    assert [r["person_id"] for r in hot] == ["hot"] and hot[0]["_pieces"] == 10
    joined = skew.attach_per_user(skewed, cut)
    assert joined.where("person_id = 'hot'").select("_piece").distinct().count() > 5
    assert joined.count() == skewed.count()
    assert sorted(features.event_features(skewed, cut).collect()) == expected
    assert sorted(labels.event_counts(skewed, cut).collect()) == counts


def test_hot_list_is_bounded(skewed, monkeypatch):
    monkeypatch.setattr(skew, "SKEW", SkewPolicy(rows_per_piece=1, max_hot_users=2))
    assert skew.hot_users(skewed).count() <= 2


def test_both_feature_tables_agree_on_shared_columns(skewed):
    named = skewed.where("event IS NOT NULL")
    cut = labels.user_cutoffs(named)
    mine = features.event_features(named, cut).select(
        "person_id", "total_events", "active_days", F.col("unique_event_types").alias("t"))
    other = features.unlabelled_features(named).select(
        "person_id", "total_events", "active_days", F.col("distinct_event_types").alias("t"))
    assert sorted(mine.collect()) == sorted(other.collect())


def test_min_activity_and_promo_exclusion(log):
    rows = []
    for user, last in (("up", "subscription_upgraded"), ("promo", "promo_code_redeemed"),
                       ("plain", "x"), ("both", "subscription_upgraded")):
        rows += [(user, f"2024-01-0{i} 00:00:00", "x") for i in range(1, 6)]
        rows.append((user, "2024-01-06 00:00:00", last))
    rows.append(("both", "2024-01-02 00:00:00", "promo_code_redeemed"))
    rows += [("few", f"2024-01-0{i} 00:00:00", "x") for i in range(1, 5)]
    events = log(*rows)
    found = {r[0]: r[1] for r in labels.build_labels(events).collect()}
    assert found == {"up": 1, "both": 1, "plain": 0}
    assert labels.label_diagnostics(events).first().asDict() == {
        "positives_before": 2, "positives_after": 2, "negatives_before": 2, "negatives_after": 1}


def test_splits_are_disjoint_and_complete(spark):
    known = spark.range(1000).selectExpr(
        "CAST(id AS STRING) AS person_id", "CAST(id % 7 = 0 AS INT) AS will_upgrade_in_7d",
        "timestamp_seconds(1700000000 + id * 3600)::timestamp_ntz AS user_cutoff_ts")
    summary = labels.assign_splits(known.unionByName(
        spark.range(1).selectExpr("NULL::STRING AS person_id", "NULL::INT AS will_upgrade_in_7d",
                                  "NULL::TIMESTAMP_NTZ AS user_cutoff_ts")))
    sizes = {r["split"]: r["count"] for r in summary.groupBy("split").count().collect()}
    assert sizes == {"train": 700, "validation": 150, "test": 150}
