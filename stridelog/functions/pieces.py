"""Looking ahead in each user's events, in order, when one user may own much of the log.

A window per user brings all of a user's events into one task. Here the log is cut into ranges of
(user, time), however many of them a user fills, and the first events of a range are carried back
to the ranges before it that need them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelog.session import written_once


def _ordered(by: str, piece: str, order: Sequence[str]):
    return Window.partitionBy(by, piece).orderBy(*order)


def with_next(df: DataFrame, by: str, order: Sequence[str], columns: Sequence[str], ahead: int,
              pieces: int | None = None) -> DataFrame:
    """Add ``_next``: an array of the following ``ahead`` rows (structs of ``columns``) of the same
    group in the given order, fewer at its end.

    Rows without a group are dropped. The order should be total, else rows of equal place come in
    any order. ``pieces`` is the number of ranges (default: the session's shuffle partitions).
    """
    spark = df.sparkSession
    pieces = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written, as the numbers of the ranges must not change between the jobs below.
    cut = written_once(
        df.where(F.col(by).isNotNull()).repartitionByRange(pieces, by, *order)
        .withColumn("_piece", F.spark_partition_id()), "pieces")

    # Groups that fill several ranges: at most as many rows as twice the ranges.
    sizes = cut.groupBy(by, "_piece").agg(F.count(F.lit(1)).alias("_size"))
    whole = Window.partitionBy(by)
    along = whole.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    several = written_once(sizes.withColumns({
        "_i": F.row_number().over(whole.orderBy("_piece")), "_parts": F.count(F.lit(1)).over(whole),
        "_before": F.coalesce(F.sum("_size").over(along), F.lit(0)),
    }).where("_parts > 1"), "piece-sizes")

    heads = cut.join(several.where("_i > 1"), [by, "_piece"]).withColumn(
        "_rank", F.row_number().over(_ordered(by, "_piece", order))).where(F.col("_rank") <= ahead)
    back = F.explode(F.sequence(F.greatest(F.col("_i") - ahead, F.lit(1)), F.col("_i") - 1))
    earlier = several.select(by, F.col("_i").alias("_to"), F.col("_piece").alias("_target"),
                             (F.col("_before") + F.col("_size")).alias("_end"))
    carried = heads.withColumn("_to", back).join(earlier, [by, "_to"]).where(
        F.col("_before") - F.col("_end") + F.col("_rank") <= ahead).withColumn(
        "_piece", F.col("_target"))

    names = [*df.columns, "_piece"]
    rows = cut.select(*names, F.lit(True).alias("_own")).unionByName(
        carried.select(*names, F.lit(False).alias("_own")))
    following = _ordered(by, "_piece", order).rowsBetween(1, ahead)
    row: Column = F.struct(*columns)
    return rows.withColumn("_next", F.collect_list(row).over(following)).where("_own").drop(
        "_own", "_piece")
