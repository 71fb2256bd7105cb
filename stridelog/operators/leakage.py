"""Audits of a feature table for columns and rows that give the label away."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from itertools import combinations
from math import isnan

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelog.config import (
    AUDIT_NAME_PATTERNS, BANNED_COLUMN_PATTERNS, CORRELATION_LIMIT, CUTOFF, LABEL, TS,
)
from stridelog.functions.columns import numeric_columns, pearson

MIN_PAIRS = 10
FINDING = ("layer", "column", "reason", "severity")


def _any_of(patterns: Sequence[str]) -> str:
    return "(?i)(" + "|".join(re.escape(p) for p in patterns) + ")"


def _finding(layer: int, column: Column, reason: Column, severity: str) -> list[Column]:
    return [
        F.lit(layer).alias("layer"), column.alias("column"), reason.alias("reason"),
        F.lit(severity).alias("severity"),
    ]


def column_catalog(df: DataFrame) -> DataFrame:
    """Every column of the table with the number of values it holds."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return counts.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column", "n_values")


def name_findings(catalog: DataFrame, label: str = LABEL,
                  patterns: Sequence[str] = AUDIT_NAME_PATTERNS) -> DataFrame:
    """Columns, the label aside, whose name contains a pattern in any case."""
    match = F.regexp_extract("column", _any_of(patterns), 1)
    reason = F.concat(F.lit("column name contains banned pattern '"), match, F.lit("'"))
    return catalog.where((F.col("column") != label) & (match != "")).select(
        *_finding(1, F.col("column"), reason, "HIGH")
    )


def _statistics(df: DataFrame, label: str, *more: Column) -> DataFrame:
    """One row of one aggregation: ``pairs``, an entry per numeric column, and ``more``."""
    columns = numeric_columns(df, skip=(label,))
    y = F.col(label)
    stats = df.agg(
        *[pearson(F.col(c), y).alias(f"r|{c}") for c in columns],
        *[F.count_if(F.col(c).isNotNull() & y.isNotNull()).alias(f"n|{c}") for c in columns],
        *more,
    )
    pairs = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.col(f"`r|{c}`").alias("r"),
            F.col(f"`n|{c}`").alias("n_pairs"),
        )
        for c in columns
    ])
    return stats.select(pairs.alias("pairs"), *stats.columns[2 * len(columns):])


def label_correlations(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Correlation of every numeric column with the label, and the pairs it rests on.

    One aggregation for all columns; null where a side is constant.
    """
    return _statistics(df, label).select(F.inline("pairs"))


def correlation_findings(df: DataFrame, label: str = LABEL,
                         threshold: float = CORRELATION_LIMIT) -> DataFrame:
    if label not in df.columns:
        return column_catalog(df).where(F.lit(False)).select(
            *_finding(2, F.col("column"), F.col("column"), "HIGH")
        )
    return _strong(label_correlations(df, label), threshold)


def _strong(correlations: DataFrame, threshold: float) -> DataFrame:
    strength = F.abs("r")
    reason = F.concat(
        F.lit("Pearson |r| = "), F.format_string("%.4f", strength),
        F.lit(f" > {threshold} with label"),
    )
    return correlations.where((F.col("n_pairs") >= MIN_PAIRS) & (strength > threshold)).select(
        *_finding(2, F.col("column"), reason, "HIGH"))


def post_cutoff_findings(df: DataFrame) -> DataFrame | None:
    """A finding when rows lie after their cutoff; None when the table has no such columns."""
    if TS not in df.columns or CUTOFF not in df.columns:
        return None
    return _late(df.agg(F.count_if(F.col(TS) > F.col(CUTOFF)).alias("n")))


def _late(counted: DataFrame) -> DataFrame:
    reason = F.concat(
        F.col("n").cast("string"),
        F.lit(f" row(s) have {TS} > {CUTOFF} (post-cutoff data)"),
    )
    return counted.where("n > 0").select(
        *_finding(3, F.lit(f"{TS} / {CUTOFF}"), reason, "CRITICAL")
    )


def audit_features(df: DataFrame, label_col: str = LABEL,
                   correlation_threshold: float = CORRELATION_LIMIT) -> DataFrame:
    """All findings as (layer, column, reason, severity), from one aggregation of the table."""
    names = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column STRING")
    parts = [name_findings(names, label_col)]
    timed = TS in df.columns and CUTOFF in df.columns
    if label_col in df.columns:
        late = [F.count_if(F.col(TS) > F.col(CUTOFF)).alias("n")] if timed else []
        row = _statistics(df, label_col, *late)
        parts.append(_strong(row.select(F.inline("pairs")), correlation_threshold))
        if timed:
            # Asking for the pairs too lets both parts read one aggregation.
            parts.append(_late(row.where(F.size("pairs") >= 0).select("n")))
    elif timed:
        parts.append(post_cutoff_findings(df))
    return reduce(DataFrame.unionByName, parts)


def banned_columns(df: DataFrame,
                   patterns: Sequence[str] = BANNED_COLUMN_PATTERNS) -> list[str]:
    matcher = re.compile(_any_of(patterns))
    return [c for c in df.columns if matcher.search(c)]


def drop_banned_columns(df: DataFrame, keep: Sequence[str] = (LABEL, CUTOFF),
                        patterns: Sequence[str] = BANNED_COLUMN_PATTERNS) -> DataFrame:
    """The table without the columns whose name contains a pattern."""
    return df.drop(*[c for c in banned_columns(df, patterns) if c not in keep])


def feature_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of every pair of columns, nulls as 0; null for a constant column.

    The matrix is added up on the executors; only its (columns x columns) cells reach the
    driver.
    """
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    vectors = VectorAssembler(inputCols=list(columns), outputCol="v").transform(filled)
    matrix = Correlation.corr(vectors, "v", "pearson").first()[0].toArray()
    rows = [
        (columns[i], columns[j], None if isnan(matrix[i, j]) else float(matrix[i, j]))
        for i, j in combinations(range(len(columns)), 2)
    ]
    return df.sparkSession.createDataFrame(
        rows, "feature_a STRING, feature_b STRING, r DOUBLE"
    )
