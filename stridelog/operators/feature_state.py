"""Features from a state that grows day by day, so that a day's scores read one day of the log.

The state is a long table, one row per user, kind and key, where the kind is ``event``, ``session``
or ``day``: how many events it has, the first and the last. Such tables merge by adding up and by
least and largest, in any order, so days (or batches of a stream) can be counted apart and late
events come in later. A user with a third of all events is spread over its keys, and nothing
grows inside a row.

A day ends with its last microsecond. Seen from there the trailing windows of 7, 14 and 30 days are
whole days, so that the features equal those of ``features.build_feature_store`` with that cutoff.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelog.config import (
    CORE_EVENTS, EVENT, FEATURES, FRICTION_EVENTS, SOCIAL_EVENTS, TENURE_EVENT, TS, USER,
)
from stridelog.functions.columns import day_of, flag, is_known_in
from stridelog.operators import propensity
from stridelog.operators.features import EVENT_COUNTS, WINDOW_DAYS, with_derived
from stridelog.sources.events import clean_raw, session_of
from stridelog.sources.sinks import write_parquet

STATE_KEY = (USER, "kind", "key")


def _totals() -> list[Column]:
    return [F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts")]


def counted(events: DataFrame, *by: str) -> DataFrame:
    """The state of some events alone; banned ones and those without a user do not count.

    ``by`` are further columns of the events to count apart by.
    """
    narrow = clean_raw(events.withColumn("_session", session_of(events))).where(
        F.col(USER).isNotNull())
    kinds = F.array(*[F.struct(F.lit(kind).alias("kind"), key.alias("key")) for kind, key in (
        ("event", F.col(EVENT)), ("session", F.col("_session")),
        ("day", day_of(TS).cast("string")))])
    each = narrow.select(*by, USER, TS, F.explode(kinds).alias("_at")).where("_at.key IS NOT NULL")
    return each.groupBy(*by, USER, F.col("_at.kind").alias("kind"), F.col("_at.key").alias("key")
                        ).agg(F.count(F.lit(1)).alias("n"), F.min(TS).alias("first_ts"),
                              F.max(TS).alias("last_ts"))


def merged(*states: DataFrame) -> DataFrame:
    """One state of several that were counted apart."""
    return reduce(DataFrame.unionByName, states).groupBy(*STATE_KEY).agg(*_totals())


def state_features(state: DataFrame, day: dt.date) -> DataFrame:
    """All features of the state's users at the end of ``day``, with that time as ``_cutoff``.

    The state must not hold later events.
    """
    kind, key, n = F.col("kind"), F.col("key"), F.col("n")
    event, is_day = kind == "event", kind == "day"

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    def since(days: int) -> Column:
        return key > F.lit(str(day - dt.timedelta(days=days)))

    end = F.lit(dt.datetime.combine(day, dt.time.max)).cast(state.schema["last_ts"].dataType)
    sums = state.groupBy(USER).agg(
        F.min(F.when(is_day, F.col("first_ts"))).alias("_first"),
        F.max(F.when(is_day, F.col("last_ts"))).alias("_last"),
        F.min(F.when(event & (key == TENURE_EVENT), F.col("first_ts"))).alias("_tenure"),
        total(event).alias("total_events"),
        F.count_if(event).alias("unique_event_types"),
        F.count_if(kind == "session").alias("total_sessions"),
        F.count_if(is_day).alias("active_days"),
        *[total(is_day & since(d)).alias(f"events_last_{d}d") for d in WINDOW_DAYS],
        F.count_if(event & key.isin(list(CORE_EVENTS))).alias("feature_breadth"),
        *[total(event & (key == e)).alias(name) for name, e in EVENT_COUNTS.items()],
        total(event & is_known_in(key, FRICTION_EVENTS)).alias("friction_events"),
        F.max(flag(event & is_known_in(key, SOCIAL_EVENTS))).alias("is_social_user"),
    ).withColumn("_cutoff", end)
    return with_derived(sums).select(USER, *FEATURES).withColumn("_cutoff", end)


def active_on(state: DataFrame, day: dt.date) -> DataFrame:
    """The state of users with an event on ``day``."""
    users = state.where((F.col("kind") == "day") & (F.col("key") == str(day))).select(USER)
    return state.join(users, USER, "left_semi")


@dataclass(frozen=True)
class DailyState:
    """States and scores by day in a folder. Doing a day again overwrites that day alone."""

    spark: SparkSession
    folder: str

    def path(self, name: str, day: dt.date) -> str:
        return f"{self.folder}/{name}/day={day}"

    def state(self, day: dt.date) -> DataFrame:
        """The state at the end of ``day``; raises when the day was not done."""
        try:
            return self.spark.read.parquet(self.path("state", day))
        except AnalysisException as missing:
            raise ValueError(f"there is no state of {day}") from missing

    def start(self, events: DataFrame, day: dt.date) -> DataFrame:
        """Count the whole log up to ``day``."""
        return write_parquet(counted(_within(events, None, day)), self.path("state", day))

    def advance(self, events: DataFrame, day: dt.date) -> DataFrame:
        """The state of the day before, and the events of ``day`` alone."""
        before = self.state(day - dt.timedelta(days=1))
        return write_parquet(
            merged(before, counted(_within(events, day, day))), self.path("state", day))

    def active_features(self, day: dt.date) -> DataFrame:
        return state_features(active_on(self.state(day), day), day)

    def score(self, model: propensity.PropensityModel, day: dt.date) -> DataFrame:
        """Scores of the users active on ``day``, written by day."""
        scores = propensity.predict_batch(model, self.active_features(day).drop("_cutoff"))
        return write_parquet(scores, self.path("scores", day))


def _within(events: DataFrame, first: dt.date | None, last: dt.date) -> DataFrame:
    """Events of some days, by bounds on the time that the scan can push down."""
    kind = events.schema[TS].dataType

    def bound(day: dt.date) -> Column:
        return F.lit(dt.datetime.combine(day, dt.time.min)).cast(kind)

    kept = events.where(F.col(TS) < bound(last + dt.timedelta(days=1)))
    return kept if first is None else kept.where(F.col(TS) >= bound(first))
