"""Running totals, exact quantiles and row numbers that need no single sorted task.

A plain window or ``percentile`` brings a whole table, or a whole group, into one task.
The functions here first cut the data by value, so that a task only ever orders a small
part of it. The results are those of the plain forms.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelog.functions.skew import attach_per_group
from stridelog.session import written_once

# Values are cut into CELLS parts of about equal size.
CELL_BITS = 10
CELLS = 1 << CELL_BITS

# Rank error of the approximate quantiles that cut the values.
ACCURACY = 10_000

# Distinct values that one task may put in order; a group with more is narrowed first.
SMALL_GROUP = 100_000


def _bounds(value: str) -> Column:
    """The values that cut a group into cells of about equal size."""
    shares = ", ".join(f"{i / CELLS}D" for i in range(1, CELLS))  # one parse, not 1023 calls
    return F.expr(f"percentile_approx(`{value}`, array({shares}), {ACCURACY})")


def _cell(bounds: str, value: str) -> Column:
    """A value's cell: the number of bounds below it, found by halving."""
    steps = F.array(*[F.lit(CELLS >> i) for i in range(1, CELL_BITS + 1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(
        F.element_at(bounds, at + step) < F.col(value), step).otherwise(F.lit(0)))


def running_totals(df: DataFrame, by: Sequence[str], value: str,
                   totals: Sequence[str]) -> DataFrame:
    """Add ``cum_<t>`` for each column of ``totals``: its sum over this and all higher values.

    ``df`` holds one row per (``by``, ``value``), both never null. Approximate quantiles
    cut each group into cells; the cells' totals are added up over at most ``CELLS`` rows,
    and only the rows of one cell meet in a window of their own. As the cells follow the
    data and a value is one row, none of them grows out of proportion.
    """
    by = list(by)
    bounds = df.groupBy(*by).agg(_bounds(value).alias("_bounds"))
    placed = attach_per_group(df, bounds, by, value).select(
        *df.columns, _cell("_bounds", value).alias("_cell")
    )
    cells = placed.groupBy(*by, "_cell").agg(*[F.sum(t).alias(f"_sum_{t}") for t in totals])
    higher = Window.partitionBy(*by).orderBy(F.desc("_cell")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = cells.select(*by, "_cell", *[
        F.coalesce(F.sum(f"_sum_{t}").over(higher), F.lit(0)).alias(f"_before_{t}")
        for t in totals
    ])
    within = Window.partitionBy(*by, "_cell").orderBy(F.desc(value)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return placed.join(offsets, [*by, "_cell"]).select(
        *df.columns,
        *[(F.col(f"_before_{t}") + F.sum(t).over(within)).alias(f"cum_{t}") for t in totals],
    )


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, names: dict[str, float],
                    few_groups: bool = False, size_name: str | None = None) -> DataFrame:
    """Interpolated quantiles of ``value`` per group, one column per entry of ``names``.

    The counts of distinct values are written once. While a group has more of them than one
    task may order (``SMALL_GROUP``), each wanted rank is narrowed to the one cell of values that
    holds it, a thousandth of them. So the largest task is the same whatever the table. Rows with
    a null or NaN value, or a null in ``by``, are left out; a group without values gives no row.
    ``few_groups`` says that the number of groups is bounded (columns, classes), so that a table
    of them broadcasts; ``size_name`` adds a column with the number of values.
    """
    by = list(by)
    keys = [*by, "_all"]  # also where there are no groups there is a key to join by
    counted = written_once(
        df.na.drop(subset=[*by, value])
        .select(*by, F.lit(0).alias("_all"), F.col(value).cast("double").alias("_v"))
        .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_times")), "value-counts")

    # Ranks from 0: those at or below and above each quantile's place.
    def ranks(total: Column) -> list[Column]:
        return [side(F.lit(p) * (total - 1)).cast("long")
                for p in names.values() for side in (F.floor, F.ceil)]

    rows, group = narrowed(counted, keys, ranks, few_groups)
    per_value = Window.partitionBy(*group)
    up_to = per_value.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = rows.withColumn("_cum", F.sum("_times").over(up_to))
    if group == keys:
        ranked = ranked.withColumn("_total", F.sum("_times").over(per_value))
        found = [F.col("_cum") > k for k in ranks(F.col("_total"))]
    else:
        found = [(F.col("_i") == i) & (F.col("_before") + F.col("_cum") > k)
                 for i, k in enumerate(ranks(F.col("_total")))]
    # The k-th smallest value is the least one with more than k rows up to it.
    per_group = ranked.groupBy(*keys).agg(F.max("_total").alias("_total"), *[
        F.min(F.when(at, F.col("_v"))).alias(f"_rank_{i}") for i, at in enumerate(found)])
    picks = []
    for i, (name, p) in enumerate(names.items()):
        lo, hi = F.col(f"_rank_{2 * i}"), F.col(f"_rank_{2 * i + 1}")
        place = F.lit(p) * (F.col("_total") - 1)
        picks.append((lo + (hi - lo) * (place - F.floor(place))).alias(name))
    if size_name is not None:
        picks.append(F.col("_total").alias(size_name))
    return per_group.select(*by, *picks)


def narrowed(counted: DataFrame, keys: Sequence[str], ranks: Callable[[Column], list[Column]],
             few_groups: bool = False) -> tuple[DataFrame, list[str]]:
    """The rows among which each wanted rank must be sought, and the key of those sets of rows.

    ``counted`` has a row per distinct value ``_v`` of a group, with ``_times``. If no group has
    more than ``SMALL_GROUP`` of them, it is returned as it is. Otherwise there is a set of at
    most that many rows for each group and number ``_i`` of a rank, with the group's ``_total``
    and how many values are below the set (``_before``).
    """
    keys, rows = list(keys), counted
    group = keys
    # All rows together are counted from the files' footers, and mostly that is enough to know.
    while rows.count() > SMALL_GROUP and _largest(rows, group) > SMALL_GROUP:
        first = group == keys
        total = F.sum("_times") if first else F.max("_total")
        before = F.lit(0).cast("long") if first else F.max("_before")
        bounds = rows.groupBy(*group).agg(
            _bounds("_v").alias("_bounds"), total.alias("_sum"), before.alias("_below"))
        placed = attach_per_group(rows, bounds, group, "_v", few_groups).select(
            *group, "_v", "_times", "_sum", "_below", _cell("_bounds", "_v").alias("_cell"))
        up_to = Window.partitionBy(*group).orderBy("_cell").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        cells = placed.groupBy(*group, "_cell").agg(
            F.sum("_times").alias("_n"), F.max("_sum").alias("_sum"),
            F.max("_below").alias("_below")
        ).withColumn("_end", F.col("_below") + F.sum("_n").over(up_to)).withColumn(
            "_start", F.col("_end") - F.col("_n"))
        wanted = [F.when((F.col("_start") <= k) & (k < F.col("_end"))
                         & (F.lit(True) if first else F.col("_i") == i),
                         F.struct(F.lit(i).alias("i"), F.col("_cell").alias("cell"),
                                  F.col("_start").alias("start")))
                  for i, k in enumerate(ranks(F.col("_sum")))]
        # A list of at most as many entries as ranks for each set.
        picked = cells.select(*group, F.explode(F.filter(
            F.array(*wanted), lambda x: x.isNotNull())).alias("_pick")).groupBy(*group).agg(
            F.collect_list("_pick").alias("_picks"))
        # Values that several ranks share are in the set of each.
        kept = attach_per_group(placed, picked, group, "_v", few_groups).select(
            *keys, "_v", "_times", F.col("_sum").alias("_total"), F.explode(F.filter(
                "_picks", lambda x: x["cell"] == F.col("_cell"))).alias("_pick"))
        rows = written_once(kept.select(
            *keys, F.col("_pick.i").alias("_i"), "_v", "_times", "_total",
            F.col("_pick.start").alias("_before")), "narrowed")
        group = [*keys, "_i"]
    return rows, group


def _largest(rows: DataFrame, group: Sequence[str]) -> int:
    return rows.groupBy(*group).count().agg(F.max("count")).first()[0]


def spread_row_number(df: DataFrame, by: Sequence[str], order_key: str, name: str) -> DataFrame:
    """Number the rows of each group from 1 in the order of a hex digest column.

    The first three digits cut a group into 4096 even parts, which are numbered apart
    and shifted by the sizes of the parts before them.
    """
    by = list(by)
    cut = df.withColumn("_part", F.substring(order_key, 1, 3))
    sizes = cut.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_size"))
    ahead = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        *by, "_part", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_shift")
    )
    within = Window.partitionBy(*by, "_part").orderBy(order_key)
    return cut.join(shifts, [*by, "_part"]).select(
        *df.columns, (F.row_number().over(within) + F.col("_shift")).alias(name)
    )
