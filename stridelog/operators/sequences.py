"""What users do in order: event n-grams, sessions by inactivity, and labels on daily anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stridelog.config import EVENT, LABEL, TS, UPGRADE_EVENT, USER
from stridelog.functions.columns import day_of, frac_days, safe_ratio
from stridelog.functions.ordered import SMALL_GROUP, exact_quantiles
from stridelog.functions.pieces import with_next
from stridelog.sources.events import clean_raw, without_banned
from stridelog.session import written_once

HORIZON_DAYS = 7
SESSION_GAP_MINUTES = 30
AI_EVENT = "$ai_generation"


def event_ngrams(events: DataFrame, n: int = 2, tie: str = "event_id",
                 pieces: int | None = None) -> DataFrame:
    """How often ``n`` events follow each other directly: ``ngram`` (array of names), occurrences
    ``n_times`` and users ``n_users``.

    Banned events and those without a name are left out first. Events of one time go by ``tie``.
    """
    named = without_banned(clean_raw(events), keep_null=False).select(USER, TS, EVENT, tie)
    ahead = with_next(named, USER, [TS, tie], [EVENT], n - 1, pieces)
    grams = ahead.where(F.size("_next") == n - 1).select(
        USER, F.concat(F.array(EVENT), F.transform("_next", lambda x: x[EVENT])).alias("ngram"))
    per_user = grams.groupBy("ngram", USER).agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("ngram").agg(
        F.sum("n").alias("n_times"), F.count(F.lit(1)).alias("n_users"))


def session_gaps(events: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES,
                 pieces: int | None = None) -> DataFrame:
    """Per user the sessions by inactivity and the median time between them.

    A session ends where no event follows for more than ``gap_minutes``. ``n_sessions`` counts them
    and ``median_gap_hours`` is the exact median from the end of one to the start of the next,
    null for a user with one session. Banned events do not count, those without a name do.
    """
    times = clean_raw(events).select(USER, TS)
    ahead = with_next(times, USER, [TS], [TS], 1, pieces)
    gap = F.timestamp_diff("MICROSECOND", F.col(TS), F.get("_next", F.lit(0))[TS])
    gaps = written_once(ahead.select(USER, F.when(
        gap > gap_minutes * 60_000_000, gap / F.lit(3.6e9)).alias("gap")), "gaps")
    counts = gaps.groupBy(USER).agg((F.count("gap") + 1).alias("n_sessions"))
    medians = group_medians(gaps.where("gap IS NOT NULL"), USER, "gap")
    return counts.join(medians, USER, "left").select(
        USER, "n_sessions", F.col("median").alias("median_gap_hours"))


def group_medians(df: DataFrame, by: str, value: str, small: int = SMALL_GROUP) -> DataFrame:
    """Exact medians of very many groups in one aggregation; groups of over ``small`` rows, which
    would fill a task's memory, are ranked by parts instead. ``df`` is read more than once."""
    sizes = df.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    large = sizes.where(F.col("_n") > small).select(by)  # at most total / small rows
    if total <= small:
        return df.groupBy(by).agg(F.percentile(value, F.lit(0.5)).alias("median"))
    large = written_once(large, "large-groups")
    rest = df.join(large, by, "left_anti").groupBy(by).agg(
        F.percentile(value, F.lit(0.5)).alias("median"))
    return rest.unionByName(exact_quantiles(
        df.join(large, by, "left_semi"), [by], value, {"median": 0.5}).select(by, "median"))


def horizon_labels(events: DataFrame, days: int = HORIZON_DAYS) -> DataFrame:
    """One row per user and day with behaviour before the user's first upgrade: does an upgrade
    come within ``days`` days of that day's end?

    ``anchor_day``, ``n_events`` of that day, ``next_upgrade_ts``, and the label: 1, 0, or null
    where the log ends before the horizon does and no upgrade was seen.

    Events meet their anchors in cells of a day: a user's day becomes one row with its first
    upgrade, and the frame that looks ahead runs over such rows. Users with many events have no
    more of them than others.
    """
    timed = events.where(F.col(USER).isNotNull() & F.col(TS).isNotNull())
    upgrade = F.col(EVENT) == UPGRADE_EVENT
    behaviour = without_banned(timed.select(USER, TS, EVENT)).select(
        USER, TS, F.lit(1).alias("_clean"), F.lit(None).cast(timed.schema[TS].dataType).alias("_up"))
    upgrades = timed.where(upgrade).select(
        USER, TS, F.lit(0).alias("_clean"), F.col(TS).alias("_up"))
    cells = behaviour.unionByName(upgrades).groupBy(USER, day_of(TS).alias("anchor_day")).agg(
        F.sum("_clean").alias("n_events"), F.min("_up").alias("_up"))
    end = timed.agg(F.max(day_of(TS)).alias("_end"))

    number = F.datediff("anchor_day", F.lit("1970-01-01").cast("date"))
    per_user = Window.partitionBy(USER).orderBy("_day")
    looked = cells.withColumn("_day", number).withColumns({
        "next_upgrade_ts": F.min("_up").over(per_user.rangeBetween(1, Window.unboundedFollowing)),
        "_within": F.min("_up").over(per_user.rangeBetween(1, days)),
        "_past": F.min("_up").over(per_user.rangeBetween(Window.unboundedPreceding, 0)),
    }).where("n_events > 0 AND _past IS NULL")
    seen = F.date_add("anchor_day", days) <= F.col("_end")
    label = F.when(F.col("_within").isNotNull(), 1).when(seen, 0)
    return looked.crossJoin(F.broadcast(end)).select(
        USER, "anchor_day", "n_events", "next_upgrade_ts", label.cast("int").alias(LABEL))


def activity_shape(events: DataFrame, ai_event: str = AI_EVENT) -> DataFrame:
    """How evenly and in which direction users are active, from their first day to the log's last.

    ``activity_consistency`` is the standard deviation of daily counts over their mean,
    ``engagement_trend`` the least-squares slope of weekly counts (weeks from the user's first day;
    null with a single one), ``exploration_rate`` event types per event, and
    ``days_to_first_ai`` the days from the first event to the first ``ai_event``.

    Days and weeks without events count as zeros and are never made: their number, and the sums
    over week numbers, follow from the length of the calendar. Banned events do not count.
    """
    timed = clean_raw(events).where(F.col(USER).isNotNull())
    end = timed.agg(F.max(day_of(TS)).alias("_end"))
    types = timed.groupBy(USER, EVENT, day_of(TS).alias("_day")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(TS).alias("_first"),
        F.min(F.when(F.col(EVENT) == ai_event, F.col(TS))).alias("_ai"))
    firsts = types.groupBy(USER).agg(
        F.min("_first").alias("_start"), F.min("_ai").alias("_ai"),
        F.count_distinct(EVENT).alias("_types"), F.min("_day").alias("_first_day"))
    daily = types.groupBy(USER, "_day").agg(F.sum("_n").alias("_n"))
    week = F.floor(F.datediff("_day", "_first_day") / 7)
    sums = daily.join(firsts, USER).groupBy(USER).agg(
        F.count(F.lit(1)).alias("active_days"), F.sum("_n").alias("total_events"),
        F.sum(F.col("_n") * F.col("_n")).alias("_squares"),
        F.sum(F.col("_n") * week).alias("_weighted"),
        *[F.first(c).alias(c) for c in ("_start", "_ai", "_types", "_first_day")])

    span = F.datediff("_end", "_first_day") + 1
    weeks = F.floor((F.col("_days") - 1) / 7) + 1
    mean = F.col("total_events") / F.col("_days")
    spread = F.sqrt(F.greatest(F.col("_squares") / F.col("_days") - mean * mean, F.lit(0.0)))
    w = F.col("_weeks").cast("double")
    middle = (w - 1) / 2
    slope = safe_ratio(F.col("_weighted") - middle * F.col("total_events"),
                       (w - 1) * w * (2 * w - 1) / 6 - w * middle * middle)
    return sums.crossJoin(F.broadcast(end)).withColumn("_days", span).withColumn(
        "_weeks", weeks).select(
        USER, "total_events", "active_days", F.col("_days").cast("long").alias("calendar_days"),
        safe_ratio(spread, mean).alias("activity_consistency"), slope.alias("engagement_trend"),
        safe_ratio(F.col("_types"), F.col("total_events")).alias("exploration_rate"),
        frac_days("_ai", "_start").alias("days_to_first_ai"))
