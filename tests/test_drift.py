from __future__ import annotations

import datetime as dt
import random

import pytest

from stridelog.operators import drift

DAYS = [dt.date(2024, 5, 1), dt.date(2024, 5, 8), dt.date(2024, 5, 15), dt.date(2024, 5, 16)]


def scores(spark, values):
    return spark.createDataFrame([(v,) for v in values], "p DOUBLE")


def test_drift_is_that_of_whole_distributions(spark, tmp_path):
    draw, path, days = random.Random(1), str(tmp_path / "history"), {}
    for i, day in enumerate(DAYS):
        days[day] = [round(draw.random() ** (1 + i), 2) for _ in range(200 + 50 * i)]
        drift.record_scores(scores(spark, [*days[day], None]), path, day)
    got = {r["day"]: r for r in drift.score_drift(drift.score_history(spark, path)).collect()}
    assert set(got) == set(DAYS[1:3])
    for day in DAYS[1:3]:
        now, then = days[day], days[day - dt.timedelta(days=7)]
        ks = max(abs(sum(x >= v for x in now) / len(now) - sum(x >= v for x in then) / len(then))
                 for v in {*now, *then})
        shift = (sum(now) / len(now)) / (sum(then) / len(then)) - 1
        assert abs(got[day]["ks"] - ks) < 1e-12 and abs(got[day]["mean_shift"] - shift) < 1e-12
        assert got[day]["drifted"] == (abs(shift) > 0.2)
        assert (got[day]["n_scores"], got[day]["n_before"]) == (len(now), len(then))


def test_a_day_done_again_replaces_that_day_alone(spark, tmp_path):
    path = str(tmp_path / "history")
    for day, values in zip([*DAYS[:2], DAYS[1]], [[0.1] * 5, [0.9] * 7, [0.5] * 3]):
        drift.record_scores(scores(spark, values), path, day)
    rows = drift.score_history(spark, path).groupBy("day").count().collect()
    assert {r["day"]: r["count"] for r in rows} == {DAYS[0]: 5, DAYS[1]: 3}


def test_no_history_and_zero_means(spark, tmp_path):
    with pytest.raises(ValueError, match="no score history"):
        drift.score_history(spark, str(tmp_path / "none")).count()
    zero = spark.createDataFrame([(0.0, DAYS[0]), (0.5, DAYS[1])], "p DOUBLE, day DATE")
    row = drift.score_drift(zero).first()
    assert row["mean_shift"] is None and row["drifted"] is False and row["ks"] == 1.0
    assert drift.score_drift(zero.where("false")).count() == 0
