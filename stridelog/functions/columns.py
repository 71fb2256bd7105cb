"""Small column expressions. All are built-in functions, so they stay inside code generation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000


def frac_days(later: str | Column, earlier: str | Column) -> Column:
    """Days between two timestamps, with their fraction."""
    later = F.col(later) if isinstance(later, str) else later
    earlier = F.col(earlier) if isinstance(earlier, str) else earlier
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(float(MICROS_PER_DAY))


def day_of(ts: str | Column) -> Column:
    return F.to_date(F.col(ts) if isinstance(ts, str) else ts)


def safe_ratio(num: Column, den: Column, default: float | None = None) -> Column:
    """``num / den``; ``default`` where the denominator is zero or a side is null."""
    ratio = F.try_divide(num.cast("double"), den.cast("double"))
    return ratio if default is None else F.coalesce(ratio, F.lit(default))


def share_pct(part: Column, whole: Column, digits: int) -> Column:
    return F.round(safe_ratio(F.lit(100.0) * part, whole), digits)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is null)."""
    return F.when(condition, 1).otherwise(0)


def is_known_in(col: Column, values: Iterable[str]) -> Column:
    """Membership that is false, not null, for a null value."""
    values = list(values)
    if not values:
        return F.lit(False)
    return F.coalesce(col.isin(values), F.lit(False))


def clipped_at_zero(col: Column) -> Column:
    return F.greatest(col, F.lit(0.0))


def first_match(rules: Sequence[tuple[str, Column]], default: str) -> Column:
    """The name of the first rule whose condition is true."""
    chain = None
    for name, condition in rules:
        chain = (F.when if chain is None else chain.when)(condition, F.lit(name))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def pearson(x: Column, y: Column) -> Column:
    """Correlation over the rows where both sides are present; null for a constant side."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def numeric_columns(df: DataFrame, skip: Iterable[str] = ()) -> list[str]:
    skip = set(skip)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def rounded(df: DataFrame, columns: Iterable[str], digits: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def long_form(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
              name: str = "feature", value: str = "value") -> DataFrame:
    """One row per (keys, column) with the column's value as a double."""
    cast = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return cast.unpivot(list(keys), list(columns), name, value)
