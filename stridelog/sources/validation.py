"""Checks of required columns, label values and value ranges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelog.config import CUTOFF, EVENT, LABEL, PREDICTION_RANGES, TS, USER

RAW_EVENT_COLUMNS = (USER, TS, EVENT)
FEATURE_STORE_COLUMNS = (USER, CUTOFF)
LABEL_COLUMNS = (USER, LABEL, CUTOFF)
PREDICTION_COLUMNS = (USER,)


def column_findings(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required column: how many values it has and whether it passes.

    All columns are counted in one pass. A column that is missing has status
    ``missing``; one without any value has ``all_null``.
    """
    present = [c for c in required if c in df.columns]
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{c}`")).alias(c) for c in present],
    ).withColumns({c: F.lit(None).cast("long") for c in required if c not in present})
    status = (
        F.when(F.col("n_values").isNull(), "missing")
        .when(F.col("n_values") == 0, "all_null")
        .otherwise("ok")
    )
    return (
        counts.unpivot("_rows", [F.col(f"`{c}`") for c in required], "column", "n_values")
        .select("column", F.col("_rows").alias("n_rows"), "n_values", status.alias("status"))
    )


def validate(df: DataFrame, required: Sequence[str], name: str) -> DataFrame:
    """Return ``df``, or raise when a required column is missing or has no value."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"[{name}] missing columns: {missing}")
    bad = column_findings(df, required).where("status <> 'ok'").select("column").collect()
    if bad:
        raise ValueError(f"[{name}] columns without values: {[r['column'] for r in bad]}")
    return df


def validate_raw_events(df: DataFrame) -> DataFrame:
    return validate(df, RAW_EVENT_COLUMNS, "raw events")


def validate_feature_store(df: DataFrame) -> DataFrame:
    return validate(df, FEATURE_STORE_COLUMNS, "feature store")


def validate_prediction_input(df: DataFrame) -> DataFrame:
    return validate(df, PREDICTION_COLUMNS, "prediction input")


def label_domain(labels: DataFrame) -> DataFrame:
    """Counts of labelled rows, of null labels and of labels other than 0 and 1."""
    return labels.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(LABEL).isNull()).alias("n_null"),
        F.count_if(~F.col(LABEL).isin(0, 1)).alias("n_outside"),
    )


def validate_labels(df: DataFrame) -> DataFrame:
    validate(df, LABEL_COLUMNS, "labels")
    outside = label_domain(df).first()["n_outside"]
    if outside:
        raise ValueError(f"[labels] {outside} labels are neither 0 nor 1")
    return df


def range_findings(df: DataFrame,
                   ranges: Mapping[str, tuple[float | None, float | None]] = PREDICTION_RANGES,
                   ) -> DataFrame:
    """Rows breaking each rule (``required``, ``min``, ``max``) of each column, in one pass."""
    checks = {}
    for name, (low, high) in ranges.items():
        known = name in df.columns
        value = F.col(name) if known else F.lit(None).cast("double")
        checks[f"{name}|required"] = F.count_if(value.isNull())
        if low is not None:
            checks[f"{name}|min"] = F.count_if(value < low)
        if high is not None:
            checks[f"{name}|max"] = F.count_if(value > high)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[c.alias(key) for key, c in checks.items()]
    )
    parts = F.split("check", r"\|")
    return counts.unpivot(
        "_rows", [F.col(f"`{key}`") for key in checks], "check", "n_bad"
    ).select(parts[0].alias("column"), parts[1].alias("rule"), "n_bad")
