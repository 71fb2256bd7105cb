from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stridelog.catalog.testdata import events
from stridelog.config import CUTOFF, FEATURES, TS, USER
from stridelog.functions.columns import day_of
from stridelog.operators import propensity
from stridelog.operators.feature_state import DailyState, counted, merged, state_features
from stridelog.operators.features import build_feature_store
from stridelog.streaming.scoring import ADAPTIVE, LEAST_TASKS, PARTITIONS, ArrivalScoring, settings

SF_DIR = "/root/testdata/sf0.001"


def rows(df, columns=(USER, *FEATURES)):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                  for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def log(spark):
    """The test log, with one user who owns a third of it."""
    raw = events(spark, SF_DIR)
    hot = F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col(USER))
    out = raw.withColumn(USER, hot).select("event_id", USER, TS, "event", "canvas_id")
    return spark.createDataFrame(out.collect(), out.schema)


@pytest.fixture(scope="module")
def model(spark):
    drawn = spark.range(200).selectExpr(
        "CAST(id AS STRING) AS person_id", "CAST(id % 3 = 0 AS INT) AS will_upgrade_in_7d",
        "CAST(id % 50 AS DOUBLE) AS total_events", "CAST(id % 9 AS DOUBLE) AS active_days",
        "CAST(pmod(xxhash64(id), 30) AS DOUBLE) AS days_since_last_event")
    return propensity.fit(drawn, ["total_events", "active_days", "days_since_last_event"], trees=3)


def as_of_end(log, users, day):
    end = dt.datetime.combine(day, dt.time.max)
    cutoffs = users.select(USER).distinct().withColumn(
        CUTOFF, F.lit(end).cast(log.schema[TS].dataType))
    return build_feature_store(log, cutoffs)


def test_state_of_days_equals_the_whole_log(spark, log, tmp_path):
    last = log.agg(F.max(day_of(TS))).first()[0]
    daily = DailyState(spark, str(tmp_path))
    daily.start(log, last - dt.timedelta(days=3))
    for i in (2, 1, 0):
        daily.advance(log, last - dt.timedelta(days=i))
    daily.advance(log, last)  # again: nothing counts twice
    got = state_features(daily.state(last), last)
    assert rows(got) == rows(as_of_end(log, got, last))
    assert got.where("person_id = 'hot'").count() == 1
    active = daily.active_features(last)
    seen = {r[0] for r in log.where(day_of(TS) == F.lit(last)).select(USER).distinct().collect()}
    assert {r[USER] for r in active.collect()} <= seen
    with pytest.raises(ValueError, match="no state"):
        daily.advance(log, last + dt.timedelta(days=5))


def test_a_day_reads_its_own_events_only(spark, log, tmp_path):
    log.write.parquet(f"{tmp_path}/log")
    stored, day = spark.read.parquet(f"{tmp_path}/log"), dt.date(2024, 1, 9)
    daily = DailyState(spark, f"{tmp_path}/state")
    daily.start(stored, dt.date(2024, 1, 8))
    from stridelog.operators.feature_state import _within

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = counted(_within(stored, day, day))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(timestamp,2024-01-09" in plan
    assert "LessThan(timestamp,2024-01-10" in plan


def test_states_merge_in_any_order(log):
    parts = [counted(log.where(f"event_id % 3 = {i}")) for i in range(3)]
    one, other = merged(*parts), merged(merged(parts[2], parts[0]), parts[1])
    whole = counted(log)
    assert sorted(map(str, one.collect())) == sorted(map(str, other.select(one.columns).collect())) \
        == sorted(map(str, whole.select(one.columns).collect()))


def test_daily_scores_are_written_once(spark, log, model, tmp_path):
    last = log.agg(F.max(day_of(TS))).first()[0]
    daily = DailyState(spark, str(tmp_path))
    daily.start(log, last)
    first, again = daily.score(model, last).count(), daily.score(model, last).count()
    assert first == again == spark.read.parquet(f"{tmp_path}/scores").count() > 0


def test_scores_on_arrival_equal_the_batch(spark, log, model, tmp_path):
    scoring = ArrivalScoring(model, f"{tmp_path}/live", compact=2)
    cuts = [dt.date(2024, 1, 5), dt.date(2024, 1, 12), dt.date(2024, 1, 20), dt.date(2024, 1, 31)]

    def run():
        stream = spark.readStream.schema(log.schema).parquet(f"{tmp_path}/in")
        scoring.start(stream).awaitTermination()

    first = None
    for cut in cuts:
        part = log.where(day_of(TS) <= F.lit(cut))
        part = part if first is None else part.where(day_of(TS) > F.lit(first))
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        run()
        first = cut
    part.limit(5).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")  # delivered again
    run()
    before = scoring.scores(spark).count()
    run()  # a restart without new events
    assert scoring.scores(spark).count() == before
    latest = scoring.latest(spark)
    cutoffs = latest.select(USER, F.col("as_of").alias(CUTOFF))
    batch = propensity.predict_batch(model, build_feature_store(log, cutoffs))
    both = (USER, "total_events", "active_days", "upgrade_probability", "upgrade_risk_tier")
    assert rows(latest, both) == rows(batch, both)
    assert latest.count() == latest.select(USER).distinct().count()


def test_a_batch_done_again_counts_once(spark, log, model, tmp_path):
    scoring = ArrivalScoring(model, str(tmp_path), compact=2)
    parts = [log.where(f"event_id % 4 = {i}") for i in range(4)]
    for i, part in enumerate(parts):
        scoring.process(part, i)
        scoring.process(part, i)
    scoring.process(log.where("false"), 4)
    whole = counted(log).where("kind = 'event'").agg(F.sum("n")).first()[0]
    last = scoring.latest(spark)
    assert scoring.scores(spark).groupBy("batch", USER).count().where("count > 1").isEmpty()
    state = merged(scoring._state(spark.read.parquet(f"{tmp_path}/added/batch=4"), 4))
    assert state.where("kind = 'event'").agg(F.sum("n")).first()[0] == whole
    assert last.count() == counted(log).select(USER).distinct().count()


def test_a_stream_has_few_state_tasks_and_plans_batches_as_a_batch_job(
        spark, log, model, tmp_path, monkeypatch):
    seen, process = [], ArrivalScoring.process

    def spied(self, events, batch):
        conf = events.sparkSession.conf
        seen.append((conf.get(ADAPTIVE), conf.get(PARTITIONS), events.rdd.getNumPartitions()))
        process(self, events, batch)

    monkeypatch.setattr(ArrivalScoring, "process", spied)
    scoring = ArrivalScoring(model, f"{tmp_path}/live")
    days = [dt.date(2024, 1, 12), dt.date(2024, 1, 31)]
    for first, stop, partitions in zip([dt.date(2024, 1, 1), days[0]], days, ("200", "3")):
        part = log.where((day_of(TS) <= F.lit(stop)) & (day_of(TS) > F.lit(first)))
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(log.schema).parquet(f"{tmp_path}/in")
        with settings(spark, {PARTITIONS: partitions}):
            scoring.start(stream).awaitTermination()
            assert (spark.conf.get(ADAPTIVE), spark.conf.get(PARTITIONS)) == ("true", partitions)
        # The second run keeps the checkpoint's tasks.
        assert set(seen) == {("true", partitions, LEAST_TASKS)}
        seen.clear()
    latest = scoring.latest(spark)
    batch = propensity.predict_batch(model, build_feature_store(
        log.where(day_of(TS) > F.lit(dt.date(2024, 1, 1))),
        latest.select(USER, F.col("as_of").alias(CUTOFF))))
    both = (USER, "total_events", "active_days", "upgrade_probability", "upgrade_risk_tier")
    assert rows(latest, both) == rows(batch, both)


def test_hot_users_count_the_log_in_one_pass(spark, log, tmp_path):
    from stridelog.functions.skew import SkewPolicy, hot_users

    log.withColumn(USER, F.expr(f"IF(event_id % 5 = 0, NULL, {USER})")).write.parquet(
        f"{tmp_path}/log")
    hot = hot_users(spark.read.parquet(f"{tmp_path}/log"), SkewPolicy(100, 50))
    hot.collect()
    assert "ReusedExchange" in hot._jdf.queryExecution().executedPlan().toString()
    assert [r[USER] for r in hot.collect()] == ["hot"]
