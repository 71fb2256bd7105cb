"""Joins that stay even when one user, or one group, owns much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelog.config import SKEW, USER, SkewPolicy

PIECE = "_piece"
GROUP_PIECES = 64


def hot_users(events: DataFrame, policy: SkewPolicy | None = None) -> DataFrame:
    """Users with more events than one task should take, and into how many pieces to cut them.

    Holds at most ``policy.max_hot_users`` rows: each of them owns more than that share
    of all events. Events without a user are left out of the counts, so that these and their total
    come from one pass.
    """
    policy = policy or SKEW
    counts = events.where(F.col(USER).isNotNull()).groupBy(USER).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))
    limit = F.greatest(
        F.lit(policy.rows_per_piece), F.ceil(F.col("_total") / F.lit(policy.max_hot_users))
    )
    return (
        counts.crossJoin(F.broadcast(total))
        .where(F.col("_n") > limit)
        .select(USER, F.ceil(F.col("_n") / limit).cast("int").alias("_pieces"))
    )


def attach_per_user(events: DataFrame, per_user: DataFrame,
                    policy: SkewPolicy | None = None) -> DataFrame:
    """Inner join of events with a one-row-per-user table, safe against hot users.

    The events of a hot user are spread over pieces and the user's row is repeated for
    each piece, so the join key is (user, piece). The piece stays in the result for a
    first aggregation on the same key; the pieces then meet as partial results only. Pieces go by
    all columns, so that events of one time and name part if anything else differs.
    """
    hot = F.broadcast(hot_users(events, policy))
    spread = events.join(hot, USER, "left").withColumn(
        PIECE,
        F.coalesce(F.pmod(F.xxhash64(*events.columns), F.col("_pieces")).cast("int"), F.lit(0)),
    ).drop("_pieces")
    repeated = per_user.join(hot, USER, "left").withColumn(
        PIECE, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))
    ).drop("_pieces")
    return spread.join(repeated, [USER, PIECE])


def attach_per_group(df: DataFrame, per_group: DataFrame, by: Sequence[str],
                     spread_by: str, few_groups: bool = False) -> DataFrame:
    """Inner join with a one-row-per-group table; for no groups, with its only row.

    Each group's rows are spread over pieces by the hash of ``spread_by``, of which a group
    should hold no value in many rows, and the group's row is repeated for each, so that no group has to pass through one task. Where the
    number of groups is bounded, ``few_groups``, the table is broadcast instead.
    """
    if not by:
        return df.crossJoin(F.broadcast(per_group))
    if few_groups:
        return df.join(F.broadcast(per_group), list(by))
    spread = df.withColumn(PIECE, F.pmod(F.xxhash64(spread_by), F.lit(GROUP_PIECES)).cast("int"))
    repeated = per_group.withColumn(
        PIECE, F.explode(F.sequence(F.lit(0), F.lit(GROUP_PIECES - 1)))
    )
    return spread.join(repeated, [*by, PIECE]).drop(PIECE)
