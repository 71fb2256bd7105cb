from __future__ import annotations

import random
import statistics
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stridelog.functions.pieces import with_next
from stridelog.operators import sequences

START = datetime(2024, 3, 1)


def some_log(spark, seed, users=12, hot=400, events=600):
    """Events of several users, of which one owns most; some events share a time."""
    draw, rows = random.Random(seed), []
    names = ["open", "click", "run_block", "$exception", None, "credits_exceeded",
             "subscription_upgraded"]
    for i in range(events):
        user = "hot" if i < hot else f"u{draw.randint(1, users)}"
        at = START + timedelta(minutes=draw.randint(0, 40 * 24 * 6) * 10)
        weights = [30, 30, 20, 5, 5, 5, 0.3]
        rows.append((i, user, at, draw.choices(names, weights)[0]))
    rows += [(events, None, START, "open"), (events + 1, "u1", None, "open")]
    return rows, spark.createDataFrame(
        rows, "event_id LONG, person_id STRING, timestamp TIMESTAMP_NTZ, event STRING")


def by_user(rows, keep):
    users = {}
    for i, user, at, event in sorted((r for r in rows if r[1] and r[2] and keep(r[3])),
                                     key=lambda r: (r[2], r[0])):
        users.setdefault(user, []).append((at, event, i))
    return users


BANNED = {"credits_exceeded", "subscription_upgraded"}


@pytest.mark.parametrize("pieces", [1, 4, 150, 700])
@pytest.mark.parametrize("n", [2, 4])
def test_ngrams_are_those_of_whole_users(spark, pieces, n):
    rows, log = some_log(spark, 1)
    want, users = Counter(), {}
    for user, events in by_user(rows, lambda e: e is not None and e not in BANNED).items():
        names = [e for _, e, _ in events]
        for i in range(len(names) - n + 1):
            want[tuple(names[i:i + n])] += 1
            users.setdefault(tuple(names[i:i + n]), set()).add(user)
    got = sequences.event_ngrams(log, n, pieces=pieces).collect()
    assert {tuple(r["ngram"]): r["n_times"] for r in got} == want
    assert all(r["n_users"] == len(users[tuple(r["ngram"])]) for r in got)


def test_a_hot_user_is_spread_over_tasks(spark):
    rows, log = some_log(spark, 2, hot=600, events=900)
    named = log.where("person_id IS NOT NULL AND timestamp IS NOT NULL")
    out = with_next(named, "person_id", ["timestamp", "event_id"], ["event_id"], 2, pieces=40)
    largest = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    following = {r["event_id"]: [x["event_id"] for x in r["_next"]] for r in out.collect()}
    assert len(following) == 900 and largest < 600
    for events in by_user(rows, lambda e: True).values():
        ids = [i for _, _, i in events]
        assert all(following[i] == ids[k + 1:k + 3] for k, i in enumerate(ids))


@pytest.mark.parametrize("pieces, small", [(1, 100_000), (60, 5)])
def test_session_gaps_are_those_of_a_plain_walk(spark, pieces, small, monkeypatch):
    monkeypatch.setattr(sequences.group_medians, "__defaults__", (small,))
    rows, log = some_log(spark, 3)
    want = {}
    for user, events in by_user(rows, lambda e: e not in BANNED).items():
        times = [at for at, _, _ in events]
        gaps = [(b - a).total_seconds() / 3600 for a, b in zip(times, times[1:])]
        gaps = [g for g in gaps if g > 0.5]
        want[user] = (len(gaps) + 1, round(statistics.median(gaps), 6) if gaps else None)
    got = sequences.session_gaps(log, pieces=pieces).collect()
    assert {r["person_id"]: (r["n_sessions"], r["median_gap_hours"] and round(
        r["median_gap_hours"], 6)) for r in got} == want


def test_horizon_labels_are_those_of_every_anchor(spark):
    rows, log = some_log(spark, 4)
    end = max(r[2] for r in rows if r[2] and r[1]).date()
    want = {}
    for user, events in by_user(rows, lambda e: True).items():
        ups = [at for at, e, _ in events if e == "subscription_upgraded"]
        for day in {at.date() for at, e, _ in events if e not in BANNED}:
            if any(u.date() <= day for u in ups):
                continue
            after = [u for u in ups if u.date() > day]
            label = 0 if day + timedelta(days=7) <= end else None
            if after and min(after).date() <= day + timedelta(days=7):
                label = 1
            n = sum(at.date() == day and e not in BANNED for at, e, _ in events)
            want[user, day] = (n, min(after, default=None), label)
    got = {(r["person_id"], r["anchor_day"]): (r["n_events"], r["next_upgrade_ts"],
                                               r["will_upgrade_in_7d"])
           for r in sequences.horizon_labels(log).collect()}
    assert got == want and {v[2] for v in want.values()} >= {0, 1, None}


def test_empty_logs(spark):
    _, log = some_log(spark, 5)
    none = log.where("false")
    assert sequences.event_ngrams(none).count() == 0
    assert sequences.session_gaps(none).count() == 0
    assert sequences.horizon_labels(none).count() == 0


def test_empty_days_and_weeks_count_as_zeros(spark):
    days = [0, 0, 0, 1, 9, 9, 20]
    rows = [(i, "a", START + timedelta(days=d), "$ai_generation" if d == 9 else "open")
            for i, d in enumerate(days)] + [(50, "b", START + timedelta(days=27), "open")]
    log = spark.createDataFrame(
        rows, "event_id LONG, person_id STRING, timestamp TIMESTAMP_NTZ, event STRING")
    got = {r["person_id"]: r for r in sequences.activity_shape(log).collect()}
    counts = [days.count(d) for d in range(28)]
    weekly = [sum(counts[7 * w:7 * w + 7]) for w in range(4)]
    slope = statistics.linear_regression(range(4), weekly).slope
    assert abs(got["a"]["engagement_trend"] - slope) < 1e-12
    assert abs(got["a"]["activity_consistency"] - statistics.pstdev(counts) / statistics.mean(counts)) < 1e-12
    assert (got["a"]["days_to_first_ai"], got["a"]["calendar_days"]) == (9.0, 28)
    assert got["b"]["engagement_trend"] is None and got["b"]["days_to_first_ai"] is None
    assert got["b"]["activity_consistency"] == 0
    assert sequences.activity_shape(log.where("false")).count() == 0
