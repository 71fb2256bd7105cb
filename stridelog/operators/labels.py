"""Cutoffs, clean events, labels and time-based splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelog.config import (
    BANNED_EVENTS, CUTOFF, EVENT, LABEL, MIN_EVENTS, PROMO_EVENT, SPLIT, SPLIT_QUANTILES,
    TENURE_EVENT, TS, UPGRADE_EVENT, USER,
)
from stridelog.functions.columns import flag, share_pct
from stridelog.functions.ordered import exact_quantiles
from stridelog.functions.skew import PIECE, attach_per_user
from stridelog.sources.events import without_banned

DIAGNOSTICS = (
    "_diag_positives_before", "_diag_positives_after",
    "_diag_negatives_before", "_diag_negatives_after",
)


def _first(event: str):
    return F.min(F.when(F.col(EVENT) == event, F.col(TS)))


def user_history(events: DataFrame) -> DataFrame:
    """One row per user with all that labels need from the raw log, in one aggregation.

    ``user_cutoff_ts`` is the first upgrade, or else the last event. The flags say
    whether the user ever upgraded or redeemed a promotion.
    """
    return events.where(F.col(USER).isNotNull()).groupBy(USER).agg(
        F.coalesce(_first(UPGRADE_EVENT), F.max(TS)).alias(CUTOFF),
        F.max(flag(F.col(EVENT) == UPGRADE_EVENT)).alias("upgraded"),
        F.max(flag(F.col(EVENT) == PROMO_EVENT)).alias("redeemed_promo"),
        _first(TENURE_EVENT).alias("first_tenure_ts"),
    )


def user_cutoffs(events: DataFrame) -> DataFrame:
    return user_history(events).select(USER, CUTOFF)


def clean_events(events: DataFrame, cutoffs: DataFrame, keep_null_events: bool = False,
                 keep_piece: bool = False) -> DataFrame:
    """Events that may count as behaviour: not banned, and not after the user's cutoff.

    Users without a cutoff drop out. With ``keep_piece`` the skew piece stays as a
    column, for a first aggregation on (user, piece).
    """
    allowed = without_banned(events, BANNED_EVENTS, keep_null=keep_null_events)
    clean = attach_per_user(allowed, cutoffs.select(USER, CUTOFF)).where(
        F.col(TS) <= F.col(CUTOFF)
    )
    return clean if keep_piece else clean.drop(PIECE)


def cutoff_filter_counts(events: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Events a cutoff map keeps and drops; users outside the map count as dropped."""
    allowed = without_banned(events)
    kept = clean_events(allowed, cutoffs, keep_null_events=True).agg(
        F.count(F.lit(1)).alias("n_kept")
    )
    total = allowed.agg(F.count(F.lit(1)).alias("n_events"))
    return total.crossJoin(F.broadcast(kept)).select(
        "n_events", "n_kept", (F.col("n_events") - F.col("n_kept")).alias("n_dropped")
    )


def event_counts(events: DataFrame, per_user: DataFrame) -> DataFrame:
    """Clean events per user up to the cutoff, next to the user's other columns."""
    allowed = without_banned(events.select(USER, TS, EVENT), keep_null=False)
    clean = attach_per_user(allowed, per_user).where(F.col(TS) <= F.col(CUTOFF))
    others = [c for c in per_user.columns if c != USER]
    pieces = clean.groupBy(USER, PIECE).agg(
        F.count(F.lit(1)).alias("n"), *[F.max(c).alias(c) for c in others]
    )
    return pieces.groupBy(USER).agg(
        F.sum("n").alias("pre_cutoff_events"), *[F.max(c).alias(c) for c in others]
    )


def positive_users(history: DataFrame) -> DataFrame:
    return history.where("upgraded = 1").select(USER, F.lit(1).alias(LABEL))


def promo_users(history: DataFrame) -> DataFrame:
    return history.where("redeemed_promo = 1").select(USER)


def negative_users(history: DataFrame) -> DataFrame:
    """Users who neither upgraded nor redeemed a promotion.

    Each is one flag of the user's history row, so the exclusions are filters and
    need no anti-joins.
    """
    return history.where("upgraded = 0 AND redeemed_promo = 0").select(
        USER, F.lit(0).alias(LABEL)
    )


def labelled_classes(history: DataFrame) -> DataFrame:
    """Both classes before the activity filter."""
    return history.where("upgraded = 1 OR redeemed_promo = 0").select(
        USER, F.col("upgraded").alias(LABEL), CUTOFF
    )


def build_labels(events: DataFrame, min_events: int = MIN_EVENTS) -> DataFrame:
    """``person_id, will_upgrade_in_7d, user_cutoff_ts`` of users with enough clean events.

    A user's label travels with the cutoff through the counting, so the counts need not
    be joined to the classes again.
    """
    counts = event_counts(events, labelled_classes(user_history(events)))
    active = counts.where(F.col("pre_cutoff_events") >= min_events)
    return active.select(USER, LABEL, CUTOFF)


def label_diagnostics(events: DataFrame, min_events: int = MIN_EVENTS) -> DataFrame:
    """Class sizes before and after the activity filter, as one row."""
    def sizes(labelled: DataFrame, when: str) -> DataFrame:
        return labelled.agg(
            F.count_if(F.col(LABEL) == 1).alias(f"positives_{when}"),
            F.count_if(F.col(LABEL) == 0).alias(f"negatives_{when}"),
        )
    before = sizes(labelled_classes(user_history(events)), "before")
    return before.crossJoin(F.broadcast(sizes(build_labels(events, min_events), "after")))


def labels_with_diagnostics(events: DataFrame, min_events: int = MIN_EVENTS) -> DataFrame:
    """The labels with the class sizes appended as a row without a user."""
    diagnostics = label_diagnostics(events, min_events)
    summary = diagnostics.select(
        *[F.col(name.removeprefix("_diag_")).alias(name) for name in DIAGNOSTICS]
    )
    return (
        build_labels(events, min_events)
        .unionByName(summary, allowMissingColumns=True)
        .orderBy(F.asc_nulls_last(USER))
    )


def assign_splits(labels: DataFrame,
                  quantiles: tuple[float, float] = SPLIT_QUANTILES) -> DataFrame:
    """Train, validation and test by cutoff time, at interpolated quantiles of it.

    Rows without a user or a cutoff (such as a summary row) take no part.
    """
    usable = labels.where(F.col(USER).isNotNull() & F.col(CUTOFF).isNotNull()).select(
        USER, LABEL, CUTOFF
    )
    timed = usable.withColumn("_epoch", F.unix_micros(F.col(CUTOFF).cast("timestamp")) / 1e6)
    ends = exact_quantiles(
        timed.select("_epoch"), [], "_epoch", {"_train_end": quantiles[0], "_val_end": quantiles[1]}
    )
    split = (
        F.when(F.col("_epoch") <= F.col("_train_end"), "train")
        .when(F.col("_epoch") <= F.col("_val_end"), "validation")
        .otherwise("test")
    )
    return timed.crossJoin(F.broadcast(ends)).select(USER, LABEL, CUTOFF, split.alias(SPLIT))


def split_summary(splits: DataFrame) -> DataFrame:
    return splits.groupBy(SPLIT).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(LABEL) == 1).alias("n_positives"),
        share_pct(F.count_if(F.col(LABEL) == 1), F.count(F.lit(1)), 2).alias("positive_pct"),
    )
