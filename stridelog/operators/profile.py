"""Profiling the event log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelog.config import BANNED_EVENTS, EVENT, PROMO_EVENT, TS, UPGRADE_EVENT, USER
from stridelog.functions.columns import flag, frac_days, is_known_in, share_pct
from stridelog.functions.ordered import exact_quantiles
from stridelog.functions.skew import attach_per_user

TOP_EVENTS = 10
KEY_COLUMNS = (USER, EVENT, TS)


def _ts_text(col: Column) -> Column:
    """A timestamp as text, with as many decimals as it needs."""
    return col.cast("string")


def _users_with(event: str) -> Column:
    return F.count_distinct(F.when(F.col(EVENT) == event, F.col(USER)))


def _positive_rate(positives: Column, users: Column) -> Column:
    return F.round(F.try_divide(F.lit(100.0) * positives, users.cast("double")), 2)


def total_rows(events: DataFrame) -> DataFrame:
    return events.agg(F.count(F.lit(1)).alias("total_rows"))


def distinct_users(events: DataFrame) -> DataFrame:
    return events.agg(F.count_distinct(USER).alias("distinct_users"))


def distinct_event_types(events: DataFrame) -> DataFrame:
    return events.agg(F.count_distinct(EVENT).alias("distinct_event_types"))


def time_range(events: DataFrame) -> DataFrame:
    """Earliest and latest timestamp, as two rows."""
    ends = events.agg(F.min(TS).alias("timestamp_min"), F.max(TS).alias("timestamp_max"))
    return ends.unpivot([], ["timestamp_min", "timestamp_max"], "metric", "value")


def users_with_event(events: DataFrame, event: str) -> DataFrame:
    """Number of users who have the event."""
    return events.where(F.col(EVENT) == event).agg(F.count_distinct(USER).alias("users"))


def positive_rate(events: DataFrame) -> DataFrame:
    """Share of users with the target event, in percent; null for an empty log."""
    return events.agg(
        _positive_rate(_users_with(UPGRADE_EVENT), F.count_distinct(USER))
        .alias("positive_rate_pct")
    )


def null_counts(events: DataFrame, columns: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    counts = events.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "n_null")


def top_events(events: DataFrame, n: int = TOP_EVENTS) -> DataFrame:
    """The ``n`` most frequent events with their rank; ties go by name."""
    counts = events.groupBy(EVENT).agg(F.count(F.lit(1)).alias("cnt"))
    order = [F.desc("cnt"), F.asc_nulls_last(EVENT)]
    # The window runs over the n rows that are left.
    rank = F.row_number().over(Window.orderBy(*order)).cast("long")
    return counts.orderBy(*order).limit(n).select(rank.alias("rank"), EVENT, "cnt")


def top_event_labels(events: DataFrame, n: int = TOP_EVENTS) -> DataFrame:
    """``top_events`` as (metric, value) text."""
    return top_events(events, n).select(
        F.concat(F.lit("08_top_event_"), F.col("rank").cast("string")).alias("metric"),
        F.concat(F.col(EVENT), F.lit(" ("), F.col("cnt").cast("string"), F.lit(")"))
        .alias("value"),
    )


def full_profile(events: DataFrame) -> DataFrame:
    """All profile metrics as (metric, value) text, in metric order.

    Users are first reduced to one row each with their flags, so the figures over users
    need no distinct counts of the whole log; event types come from the event counts.
    """
    per_user = events.groupBy(USER).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(TS).alias("first"), F.max(TS).alias("last"),
        F.max(flag(F.col(EVENT) == UPGRADE_EVENT)).alias("upgraded"),
        F.max(flag(F.col(EVENT) == PROMO_EVENT)).alias("promo"),
        F.count_if(F.col(EVENT).isNull()).alias("null_event"),
        F.count_if(F.col(TS).isNull()).alias("null_ts"),
    )
    known = F.col(USER).isNotNull()

    def users(condition: Column) -> Column:
        return F.count_if(known & condition)

    def total(col: Column) -> Column:
        return F.coalesce(F.sum(col), F.lit(0))

    metrics = {
        "01_total_rows": total(F.col("n")),
        "02_distinct_users": users(F.lit(True)),
        "04_timestamp_min": _ts_text(F.min("first")),
        "04_timestamp_max": _ts_text(F.max("last")),
        "05_users_with_subscription_upgraded": users(F.col("upgraded") == 1),
        "06_positive_rate_pct": _positive_rate(
            users(F.col("upgraded") == 1), users(F.lit(True))
        ),
        "07_null_person_id": total(F.when(~known, F.col("n"))),
        "07_null_event": total(F.col("null_event")),
        "07_null_timestamp": total(F.col("null_ts")),
        "09_users_promo_code_redeemed": users(F.col("promo") == 1),
    }
    wide = per_user.agg(*[m.cast("string").alias(name) for name, m in metrics.items()])
    counts = events.groupBy(EVENT).agg(F.count(F.lit(1)).alias("cnt"))
    types = counts.agg(
        F.count_if(F.col(EVENT).isNotNull() & (F.col("cnt") > 0)).cast("string").alias("value")
    ).select(F.lit("03_distinct_event_types").alias("metric"), "value")
    return (
        wide.unpivot([], list(metrics), "metric", "value")
        .unionByName(types)
        .unionByName(top_event_labels(events))
        .orderBy("metric")
    )


def value_frequency(events: DataFrame, column: str = EVENT, n: int = 30) -> DataFrame:
    """The ``n`` most frequent values of a column with their share of all rows."""
    counts = events.groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    total = counts.agg(F.sum("cnt").alias("_total"))
    return (
        counts.orderBy(F.desc("cnt"), F.asc_nulls_last(column)).limit(n)
        .crossJoin(F.broadcast(total))
        .select(column, "cnt", share_pct(F.col("cnt"), F.col("_total"), 2).alias("pct"))
    )


def event_name_check(events: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows and users per expected event name; names that never occur show as FAIL."""
    expected = events.sparkSession.createDataFrame(
        [(n,) for n in names], T.StructType([T.StructField(EVENT, T.StringType())])
    )
    found = (
        events.where(F.col(EVENT).isin(list(names)))
        .groupBy(EVENT)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(USER).alias("n_users"))
    )
    return expected.join(found, EVENT, "left").select(
        EVENT,
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("n_users", F.lit(0)).alias("n_users"),
        F.when(F.col("n_rows") > 0, "PASS").otherwise("FAIL").alias("status"),
    )


def property_scan(events: DataFrame, allowed: dict[str, Sequence[str]]) -> DataFrame:
    """Value counts per property column, nulls included.

    ``leaks`` is 1 for every value of a property that has a non-null value outside its
    allow-list, as such a property gives something away.
    """
    props = list(allowed)
    long = events.select(*[F.col(f"`{p}`").cast("string").alias(p) for p in props]).unpivot(
        [], [F.col(f"`{p}`") for p in props], "property", "value"
    )
    counts = long.groupBy("property", "value").agg(F.count(F.lit(1)).alias("cnt"))
    outside = F.lit(False)
    for prop, values in allowed.items():
        outside = outside | (
            (F.col("property") == prop)
            & F.col("value").isNotNull()
            & ~is_known_in(F.col("value"), values)
        )
    leaks = counts.groupBy("property").agg(
        F.max(flag(outside & (F.col("cnt") > 0))).alias("leaks")
    )
    # One row per property asked for.
    return counts.join(F.broadcast(leaks), "property").select("property", "value", "cnt", "leaks")


def upgrade_timing(events: DataFrame, near_hours: float = 3.0) -> DataFrame:
    """Median hours from each event type to its user's upgrade, over users who upgraded.

    An event that comes at the upgrade, or after it (negative hours), is a leak; so is
    one within ``near_hours`` before it.
    """
    upgrades = (
        events.where(F.col(EVENT) == UPGRADE_EVENT).groupBy(USER)
        .agg(F.min(TS).alias("_upgrade_ts"))
    )
    hours = attach_per_user(events.select(USER, TS, EVENT), upgrades).where(
        F.col(EVENT).isNotNull() & F.col(TS).isNotNull()
    ).select(EVENT, (frac_days("_upgrade_ts", TS) * 24).alias("hours"))
    median = exact_quantiles(
        hours, [EVENT], "hours", {"median_hours": 0.5}, size_name="n_events"
    )
    return median.select(
        EVENT, "n_events", "median_hours",
        flag(F.col("median_hours") <= near_hours).alias("suspect"),
        flag(is_known_in(F.col(EVENT), BANNED_EVENTS)).alias("is_banned"),
    )


def dataset_summary(events: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: events, users, median events per user, labelled users and who is left out."""
    per_user = events.where(F.col(USER).isNotNull()).groupBy(USER).agg(
        F.count(F.lit(1)).alias("n")
    )
    median = exact_quantiles(per_user, [], "n", {"median_events_per_user": 0.5})
    totals = per_user.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_events"),
        F.count(F.lit(1)).alias("unique_users"),
    )
    labelled = labels.agg(
        F.count(F.lit(1)).alias("labelled_users"),
        F.count_if(F.col("will_upgrade_in_7d") == 1).alias("upgraded_users"),
    )
    n, users = F.col("labelled_users"), F.col("unique_users")
    return (
        totals.crossJoin(F.broadcast(labelled)).crossJoin(F.broadcast(median))
        .select(
            "total_events", "unique_users", "median_events_per_user", "labelled_users",
            share_pct(n, users, 1).alias("labelled_pct"),
            "upgraded_users", share_pct(F.col("upgraded_users"), n, 2).alias("upgraded_pct"),
            (users - n).alias("excluded_users"),
        )
    )
