"""Weekly moves between funnel segments.

A snapshot holds each user's features over all events up to a weekly boundary. Events
are never copied per boundary: each is counted in the first boundary it falls under,
and only these small per-user increments are repeated for the later boundaries. For
distinct counts the increment is a value's first appearance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelog.config import EVENT, SEGMENT, TS, USER
from stridelog.functions.columns import (
    MICROS_PER_DAY, day_of, flag, frac_days, is_known_in, safe_ratio,
)
from stridelog.operators.segments import SEGMENT_ORDER, UNCLASSIFIED, with_segment
from stridelog.sources.events import clean_raw

WINDOW_WEEKS = 4
MIN_DAYS = 14
WEEK_MICROS = 7 * MICROS_PER_DAY

# Which events a snapshot counts as what.
AI_EVENTS = ("$ai_generation", "ai_generation")
BLOCK_EVENTS = ("run_block", "block_executed", "block_run")
AGENT_PATTERN = "agent|chat"
AHA_EVENTS = (
    "$ai_generation",
    "ai_generation",
    "run_block",
    "block_executed",
    "block_run",
    "agent_chat",
    "notebook_shared",
    "deployment_created",
    "query_executed",
)

ALL_SEGMENTS = (*SEGMENT_ORDER, UNCLASSIFIED)


def is_agent_event(event: Column) -> Column:
    return F.coalesce(F.lower(event).rlike(AGENT_PATTERN), F.lit(False))


def _span(events: DataFrame, window_weeks: int) -> DataFrame:
    """One row: first and last day of the log and how many weekly boundaries it takes."""
    days = events.agg(F.min(day_of(TS)).alias("first_day"), F.max(day_of(TS)).alias("last_day"))
    length = F.datediff("last_day", "first_day")
    return days.where(length >= MIN_DAYS).select(
        "first_day", "last_day",
        F.least(F.lit(window_weeks + 1), F.floor(length / 7).cast("int")).alias("n_weeks"),
    )


def snapshot_boundaries(events: DataFrame, window_weeks: int = WINDOW_WEEKS) -> DataFrame:
    """The boundaries (place, timestamp): weekly from the first day, then the end of the log.

    Empty for a log of less than two weeks.
    """
    clean = clean_raw(events)
    kind = clean.schema[TS].dataType.typeName()
    span = _span(clean, window_weeks)
    boundary = F.when(
        F.col("place") <= F.col("n_weeks"), F.date_add("first_day", F.col("place") * 7)
    ).otherwise(F.date_add("last_day", 1))
    return span.select(
        "*", F.explode(F.sequence(F.lit(1), F.col("n_weeks") + 1)).alias("place")
    ).select("place", boundary.cast(kind).alias("boundary"))


def _placed_events(events: DataFrame, window_weeks: int) -> DataFrame:
    """Clean events with the first boundary each falls under, and the number of the last one."""
    clean = clean_raw(events.select(USER, TS, EVENT)).where(F.col(USER).isNotNull())
    start = F.col("first_day").cast("timestamp")
    since = F.unix_micros(F.col(TS).cast("timestamp")) - F.unix_micros(start)
    week = F.ceil(since / F.lit(WEEK_MICROS)).cast("int")
    place = F.when(week > F.col("n_weeks"), F.col("n_weeks") + 1).otherwise(
        F.greatest(week, F.lit(1))
    )
    return clean.crossJoin(F.broadcast(_span(clean, window_weeks))).select(
        USER, TS, EVENT, place.alias("place"), (F.col("n_weeks") + 1).alias("last_place")
    )


def _increments(placed: DataFrame) -> DataFrame:
    """What each user adds at each boundary, from counts per (user, event, day, boundary)."""
    grains = placed.groupBy(USER, EVENT, day_of(TS).alias("day"), "place").agg(
        F.count(F.lit(1)).alias("n"), F.min(TS).alias("first_ts"), F.max(TS).alias("last_ts"),
        F.max("last_place").alias("last_place"),
    ).withColumn("seen", F.col("place"))
    named = F.col(EVENT).isNotNull()
    rows = grains.withColumns({
        "named": F.when(named, F.col("n")).otherwise(0),
        "ai": F.when(is_known_in(F.col(EVENT), AI_EVENTS), F.col("n")).otherwise(0),
        "block": F.when(is_known_in(F.col(EVENT), BLOCK_EVENTS), F.col("n")).otherwise(0),
        "agent": F.when(is_agent_event(F.col(EVENT)), F.col("n")).otherwise(0),
        "aha": flag(is_known_in(F.col(EVENT), AHA_EVENTS)),
        "is_named": flag(named),
    })
    # One expansion serves all three: first boundary of each event type, first boundary of
    # each day, and the plain sums per boundary.
    sets = rows.groupingSets(
        [[F.col(USER), F.col(EVENT)], [F.col(USER), F.col("day")], [F.col(USER), F.col("place")]],
        USER, EVENT, "day", "place",
    ).agg(
        F.grouping_id().alias("gid"),
        F.min("seen").alias("seen"), F.max("last_place").alias("last_place"),
        F.max("is_named").alias("is_named"),
        F.sum("n").alias("n"), F.sum("named").alias("named"), F.sum("ai").alias("ai"),
        F.sum("block").alias("block"), F.sum("agent").alias("agent"), F.max("aha").alias("aha"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
    )
    # Grouping bits, high to low: user, event, day, place; a set bit marks a column left out.
    by_event, by_day, by_place = (F.col("gid") == g for g in (0b0011, 0b0101, 0b0110))
    sums = ("n", "named", "ai", "block", "agent", "aha")
    return sets.select(
        USER, "last_place", F.col("seen").alias("place"),
        F.when(by_event, F.col("is_named")).otherwise(0).alias("new_types"),
        F.when(by_day, 1).otherwise(0).alias("new_days"),
        *[F.when(by_place, F.col(c)).otherwise(0).alias(c) for c in sums],
        *[F.when(by_place, F.col(c)).alias(c) for c in ("first_ts", "last_ts")],
    )


def snapshot_features(events: DataFrame, window_weeks: int = WINDOW_WEEKS) -> DataFrame:
    """Features per user and boundary, over all of the user's events up to the boundary.

    Breadth and the aha flag are the snapshot's own: a score from 0 to 6, and the use of
    any of nine events.
    """
    increments = _increments(_placed_events(events, window_weeks))
    spread = increments.withColumn(
        "place", F.explode(F.sequence(F.col("place"), F.col("last_place")))
    )
    totals = spread.groupBy(USER, "place").agg(
        F.sum("n").alias("n_rows"),
        F.sum("named").alias("total_events"),
        F.sum("new_types").alias("unique_event_types"),
        F.sum("ai").alias("ai_generation_count"),
        F.sum("block").alias("run_block_count"),
        F.sum("agent").alias("agent_chat_count"),
        F.sum("new_days").alias("active_days"),
        F.max("aha").alias("hit_aha_moment"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
    )
    types = F.col("unique_event_types")
    breadth = (
        flag(F.col("ai_generation_count") > 0) + flag(F.col("run_block_count") > 0)
        + flag(F.col("agent_chat_count") > 0) + flag(F.col("n_rows") >= 20)
        + flag(types >= 10) + flag(types >= 20)
    )
    boundaries = F.broadcast(snapshot_boundaries(events, window_weeks))  # few weeks
    return totals.join(boundaries, "place").select(
        USER, "place", "boundary", "total_events", "unique_event_types",
        breadth.alias("feature_breadth"), "hit_aha_moment", "ai_generation_count",
        "run_block_count", "agent_chat_count", "active_days",
        frac_days("boundary", "last_ts").alias("days_since_last_event"),
        frac_days("boundary", "first_ts").alias("days_since_first_event"),
    )


def snapshot_segments(events: DataFrame, window_weeks: int = WINDOW_WEEKS) -> DataFrame:
    """Each user's segment at each boundary; sparse snapshots may stay unclassified."""
    return with_segment(snapshot_features(events, window_weeks)).select(USER, "place", SEGMENT)


def segment_moves(events: DataFrame, window_weeks: int = WINDOW_WEEKS) -> DataFrame:
    """Each user's segment at a boundary and at the next one.

    A user's snapshots are gathered in one row, at most one per boundary, and paired
    there: a snapshot is cumulative, so none is missing after the first.
    """
    paths = snapshot_segments(events, window_weeks).groupBy(USER).agg(
        F.sort_array(F.collect_list(F.struct("place", SEGMENT))).alias("path")
    )
    length = F.size("path")
    pairs = F.arrays_zip(
        F.slice("path", F.lit(1), length - 1).alias("a"),
        F.slice("path", F.lit(2), length - 1).alias("b"),
    )
    return paths.where(length > 1).select(USER, F.explode(pairs).alias("pair")).select(
        USER, F.col("pair.a.place").alias("place"),
        F.col(f"pair.a.{SEGMENT}").alias("from_segment"),
        F.col(f"pair.b.{SEGMENT}").alias("to_segment"),
    )


def transition_counts(events: DataFrame, window_weeks: int = WINDOW_WEEKS) -> DataFrame:
    return segment_moves(events, window_weeks).groupBy("from_segment", "to_segment").agg(
        F.count(F.lit(1)).alias("n")
    )


def transition_probabilities(events: DataFrame, window_weeks: int = WINDOW_WEEKS) -> DataFrame:
    """``(from_segment, to_segment, n, prob)`` of the moves that occur."""
    # A window over a row per pair of segments; it spares the snapshots a second run.
    leaving = F.sum("n").over(Window.partitionBy("from_segment"))
    return transition_counts(events, window_weeks).select(
        "from_segment", "to_segment", "n",
        F.round(safe_ratio(F.col("n"), leaving), 4).alias("prob"),
    )


def compute_transition_matrix(events: DataFrame, window_weeks: int = WINDOW_WEEKS) -> DataFrame:
    """The probabilities as a matrix: a row per segment users leave, a column per segment.

    A move that never occurs has probability 0. ``active_targets`` drops the columns that
    are 0 throughout.
    """
    long = transition_probabilities(events, window_weeks)
    return long.groupBy("from_segment").pivot("to_segment", list(ALL_SEGMENTS)).agg(
        F.max("prob")
    ).na.fill(0.0)


def active_targets(matrix: DataFrame) -> DataFrame:
    """The matrix without columns no one moves to (looks at one row of column sums)."""
    targets = [c for c in matrix.columns if c != "from_segment"]
    sums = matrix.agg(*[F.sum(c).alias(c) for c in targets]).first()
    return matrix.select("from_segment", *[c for c in targets if sums[c]])


def matrix_cells(matrix_long: DataFrame, least: float = 0.005) -> DataFrame:
    """Cell texts in whole percent; blank below ``least``."""
    text = F.when(
        F.col("prob") >= least, F.format_string("%.0f%%", F.col("prob") * 100)
    ).otherwise("")
    return matrix_long.select("from_segment", "to_segment", text.alias("cell"))
