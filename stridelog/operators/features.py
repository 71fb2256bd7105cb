"""Per-user features up to each user's cutoff.

All groups come from one pass: clean events are first reduced to one row per (user,
piece, event, day, session), on the key the cutoff join has already partitioned by.
Distinct counts and sums are taken from these rows, never from the raw events.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelog.config import (
    ACCELERATION_LIMIT, CORE_EVENTS, CUTOFF, DEPTH, ENGAGEMENT, EVENT, FEATURES, FRICTION,
    FRICTION_EVENTS, RECENCY, SOCIAL, SOCIAL_EVENTS, TENURE_EVENT, TS, USER, VELOCITY,
)
from stridelog.functions.columns import (
    clipped_at_zero, day_of, flag, frac_days, is_known_in, safe_ratio,
)
from stridelog.functions.skew import PIECE
from stridelog.operators.labels import clean_events, user_history
from stridelog.sources.events import clean_raw, session_of, with_timestamps

WINDOW_DAYS = (7, 14, 30)

# Feature column -> the event it counts.
EVENT_COUNTS = {
    "ai_generation_count": "$ai_generation",
    "run_block_count": "run_block",
    "agent_chat_count": "agent_new_chat",
}

# The same for the depth columns of the unlabelled feature table.
DEPTH_COUNTS = {
    "depth_agent_new_chat_count": "agent_new_chat",
    "depth_ai_generation_count": "$ai_generation",
    "depth_run_block_count": "run_block",
    "depth_tool_create_block_count": "agent_tool_call_create_block_tool",
    "depth_tool_run_block_count": "agent_tool_call_run_block_tool",
    "depth_tool_get_block_count": "agent_tool_call_get_block_tool",
}


def _sum_where(condition: Column, n: str = "n") -> Column:
    return F.sum(F.when(condition, F.col(n)).otherwise(F.lit(0)))


def _grains(events: DataFrame, cutoffs: DataFrame, keep_null_events: bool) -> DataFrame:
    """Clean events counted per user, piece, event, day and session.

    Counts for the trailing windows are taken here, as these need the exact time: a
    window reaches back from the cutoff and leaves out its far end.
    """
    narrow = events.select(USER, TS, EVENT, session_of(events).alias("session"))
    clean = clean_events(narrow, cutoffs, keep_null_events, keep_piece=True)
    age = frac_days(CUTOFF, TS)
    return clean.groupBy(USER, PIECE, CUTOFF, EVENT, day_of(TS).alias("day"), "session").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(TS).alias("first_ts"),
        F.max(TS).alias("last_ts"),
        *[F.count_if((age >= 0) & (age < d)).alias(f"n{d}") for d in WINDOW_DAYS],
    )


def event_features(events: DataFrame, cutoffs: DataFrame,
                   social_events: Sequence[str] = SOCIAL_EVENTS) -> DataFrame:
    """All features of users with at least one clean event, plus ``no_tenure_event``.

    ``cutoffs`` has ``person_id`` and ``user_cutoff_ts``, one row per user. Selecting
    some of the columns leaves the others uncomputed.
    """
    event = F.col(EVENT)
    fired = {e: F.max(flag(event == e)) for e in CORE_EVENTS}
    sums = _grains(events, cutoffs, keep_null_events=True).groupBy(USER).agg(
        F.max(CUTOFF).alias("_cutoff"),
        F.min("first_ts").alias("_first"),
        F.max("last_ts").alias("_last"),
        F.min(F.when(event == TENURE_EVENT, F.col("first_ts"))).alias("_tenure"),
        _sum_where(event.isNotNull()).alias("total_events"),
        F.count_distinct(EVENT).alias("unique_event_types"),
        F.count_distinct("session").alias("total_sessions"),
        F.count_distinct("day").alias("active_days"),
        *[F.sum(f"n{d}").alias(f"events_last_{d}d") for d in WINDOW_DAYS],
        reduce(add, fired.values()).cast("long").alias("feature_breadth"),
        *[_sum_where(event == e).alias(name) for name, e in EVENT_COUNTS.items()],
        _sum_where(is_known_in(event, FRICTION_EVENTS)).alias("friction_events"),
        F.max(flag(is_known_in(event, social_events))).alias("is_social_user"),
    )
    return with_derived(sums)


def with_derived(sums: DataFrame) -> DataFrame:
    """The features that follow from a user's counts and from the times ``_cutoff``, ``_first``,
    ``_last`` and ``_tenure``."""
    total, sessions = F.col("total_events"), F.col("total_sessions")
    previous_week = F.col("events_last_14d") - F.col("events_last_7d")
    growth = (F.col("events_last_7d") - previous_week) / (previous_week + F.lit(1.0))
    anchor = F.coalesce("_tenure", "_first")
    derived = {
        "avg_events_per_session": safe_ratio(total, F.nullif(sessions, F.lit(0)), 0.0),
        "events_last_14_to_7d": previous_week,
        "wow_growth": growth,
        "is_accelerating": flag(growth > ACCELERATION_LIMIT),
        "days_since_last_event": clipped_at_zero(frac_days("_cutoff", "_last")),
        "days_since_first_event": clipped_at_zero(frac_days("_cutoff", "_first")),
        "account_age_days": clipped_at_zero(frac_days(F.col("_cutoff"), anchor)),
        "hit_aha_moment": flag(F.col("feature_breadth") >= 2),
        "friction_ratio": safe_ratio(F.col("friction_events"), F.nullif(total, F.lit(0)), 0.0),
        "no_tenure_event": flag(F.col("_tenure").isNull()),
    }
    return sums.withColumns(derived).select(USER, *FEATURES, "no_tenure_event")


def _on_spine(events: DataFrame, cutoffs: DataFrame, columns: Sequence[str]) -> DataFrame:
    found = event_features(events, cutoffs).select(USER, *columns)
    return cutoffs.select(USER).join(found, USER, "left").na.fill(0, list(columns))


def compute_engagement(events: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Totals, event types, sessions and active days of every user in ``cutoffs``."""
    return _on_spine(events, cutoffs, ENGAGEMENT)


def compute_velocity(events: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Counts in the 7, 14 and 30 days before the cutoff, and week-over-week growth."""
    return _on_spine(events, cutoffs, VELOCITY)


def compute_recency(events: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Days from the last and first event and from account creation to the cutoff."""
    return _on_spine(events, cutoffs, RECENCY)


def compute_depth(events: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """How many core events a user has used, and how often the main ones."""
    return _on_spine(events, cutoffs, DEPTH)


def compute_friction(events: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Friction events and their share of all events."""
    return _on_spine(events, cutoffs, FRICTION)


def compute_social(events: DataFrame, cutoffs: DataFrame,
                   social_events: Sequence[str] = SOCIAL_EVENTS) -> DataFrame:
    """1 for users with one of ``social_events``; 0 for all while none is known."""
    if not social_events:
        return cutoffs.select(USER, F.lit(0).alias("is_social_user"))
    found = event_features(events, cutoffs, social_events).select(USER, *SOCIAL)
    return cutoffs.select(USER).join(found, USER, "left").na.fill(0, list(SOCIAL))


def tenure_fallbacks(events: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Users with clean events, and those whose account age starts at their first event."""
    return event_features(events, cutoffs).agg(
        F.count(F.lit(1)).alias("n_users"),
        F.count_if(F.col("no_tenure_event") == 1).alias("n_fallback"),
    )


def depth_merge(events: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Breadth and per-event counts of users with any core event."""
    counts = [c for c in DEPTH if c != "hit_aha_moment"]
    return event_features(events, cutoffs).select(USER, *counts).where("feature_breadth > 0")


def bad_cutoffs(labels: DataFrame) -> DataFrame:
    """How many labels have no usable cutoff."""
    return with_timestamps(labels, CUTOFF).agg(
        F.count(F.lit(1)).alias("n_labels"), F.count_if(F.col(CUTOFF).isNull()).alias("n_bad")
    )


def build_feature_store(events: DataFrame, labels: DataFrame,
                        check_cutoffs: bool = True) -> DataFrame:
    """One row per labelled user: the labels' columns and all features, gaps filled with 0.

    Raises when a label has no usable cutoff; ``check_cutoffs=False`` leaves out that
    check, which runs a job, for labels known to be sound.
    """
    labels = with_timestamps(labels, CUTOFF)
    if check_cutoffs:
        n_bad = bad_cutoffs(labels).first()["n_bad"]
        if n_bad:
            raise ValueError(f"{n_bad} labels have no usable {CUTOFF}")
    return joined_features(events, labels).na.fill(0, list(FEATURES))


def joined_features(events: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels with their users' features, nulls where a user has no clean event."""
    found = event_features(clean_raw(events), labels.select(USER, CUTOFF))
    return labels.join(found.select(USER, *FEATURES), USER, "left")


def null_audit(before: DataFrame, after: DataFrame) -> DataFrame:
    """Null cells of the features before and after filling."""
    def nulls(df: DataFrame, name: str) -> DataFrame:
        return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).select(
            reduce(add, [F.col(c) for c in df.columns]).alias(name)
        )
    return nulls(before, "nulls_before").crossJoin(F.broadcast(nulls(after, "nulls_after")))


def unlabelled_features(events: DataFrame) -> DataFrame:
    """Features of every user with a clean event, whether labelled or not.

    Differs from ``build_feature_store`` as follows: the cutoff comes from the log,
    events without a name are left out, days are counted by midnights crossed, and
    account age starts at ``new_user_created`` anywhere in the raw log, without a
    fallback.
    """
    history = user_history(events).select(USER, CUTOFF, "first_tenure_ts")
    event = F.col(EVENT)
    sums = _grains(events, history, keep_null_events=False).groupBy(USER).agg(
        F.sum("n").alias("total_events"),
        F.count_distinct("day").alias("active_days"),
        F.count_distinct(F.trunc("day", "week")).alias("active_weeks"),
        F.count_distinct(EVENT).alias("distinct_event_types"),
        F.min("first_ts").alias("first_event_ts"),
        F.max("last_ts").alias("last_event_ts"),
        *[_sum_where(event == e).alias(name) for name, e in DEPTH_COUNTS.items()],
        _sum_where(event.isin(list(DEPTH_COUNTS.values()))).alias("depth_total_ai_tool_events"),
        _sum_where(event.isin(list(FRICTION_EVENTS))).alias("friction_exception_count"),
    )
    cutoff_day = day_of(CUTOFF)
    return sums.join(history, USER).select(
        USER, CUTOFF, *[c for c in sums.columns if c != USER],
        F.datediff(cutoff_day, day_of("first_tenure_ts")).cast("long").alias("account_age_days"),
        F.datediff(cutoff_day, day_of("last_event_ts")).cast("long")
        .alias("days_since_last_event"),
    )


def account_ages(events: DataFrame) -> DataFrame:
    """Days from ``new_user_created`` to the cutoff for all users; null where it never fired."""
    return user_history(events).select(
        USER,
        F.datediff(day_of(CUTOFF), day_of("first_tenure_ts")).cast("long")
        .alias("account_age_days"),
    )
