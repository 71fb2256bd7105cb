"""Reports over segments, scores and features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stridelog.config import FEATURES, LABEL, SEGMENT, USER
from stridelog.functions.columns import long_form, safe_ratio, share_pct
from stridelog.functions.ordered import exact_quantiles
from stridelog.operators.segments import UNKNOWN_ACTION, UNKNOWN_LIKELIHOOD, definitions

# The columns that descriptive statistics cover.
DESCRIBED = (
    "total_events", "unique_event_types", "active_days", "events_last_30d",
    "feature_breadth", "friction_ratio", "ai_generation_count", "run_block_count",
)
TOP_FEATURES = 3
TINY = 1e-9


def one_prediction_per_user(predictions: DataFrame,
                            score: str = "upgrade_probability") -> DataFrame:
    """One score per user: the highest, where there are several."""
    return predictions.groupBy(USER).agg(F.max(score).alias(score))


def segment_lifts(segments: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean of each feature per segment, and its relative distance from the overall mean.

    Sums are taken per segment first; all that follows works on that handful of rows.
    """
    sums = segments.groupBy(SEGMENT).agg(*[
        F.struct(F.sum(F.col(f).cast("double")).alias("s"), F.count(f).alias("n")).alias(f)
        for f in features
    ])
    long = sums.select(
        SEGMENT,
        F.inline(F.array(*[
            F.struct(F.lit(f).alias("feature"), F.col(f"{f}.s"), F.col(f"{f}.n"))
            for f in features
        ])),
    )
    overall = long.groupBy("feature").agg(
        safe_ratio(F.sum("s"), F.sum("n")).alias("overall_mean")
    )
    mean = safe_ratio(F.col("s"), F.col("n"))
    lift = (mean - F.col("overall_mean")) / (F.abs("overall_mean") + F.lit(TINY))
    return long.join(F.broadcast(overall), "feature").select(
        SEGMENT, "feature", mean.alias("segment_mean"), "overall_mean", lift.alias("lift")
    )


def top_diagnostic_features(segments: DataFrame, features: Sequence[str] = FEATURES,
                            n: int = TOP_FEATURES) -> DataFrame:
    """The ``n`` features that set each segment apart most; ties go by name."""
    order = Window.partitionBy(SEGMENT).orderBy(F.desc(F.round(F.abs("lift"), 9)), "feature")
    return (
        segment_lifts(segments, features)
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= n)
        .select(SEGMENT, "rank", "feature", F.round("segment_mean", 3).alias("value"), "lift")
    )


def generate_full_report(segments: DataFrame, predictions: DataFrame | None = None,
                         features: Sequence[str] = FEATURES) -> DataFrame:
    """One row per segment: size, mean score, conversion, top features and what to do.

    Mean score and conversion are null where there are no predictions or labels.
    """
    if SEGMENT not in segments.columns:
        raise KeyError(f"no {SEGMENT} column; run assign_segments first")
    score = F.lit(None).cast("double")
    users = segments
    if predictions is not None:
        users = segments.drop("upgrade_probability").join(
            one_prediction_per_user(predictions), USER, "left"
        )
        score = F.col("upgrade_probability")
    converted = F.avg(LABEL) if LABEL in segments.columns else F.lit(None).cast("double")
    sizes = users.groupBy(SEGMENT).agg(
        F.count(F.lit(1)).alias("user_count"), F.avg(score).alias("mean_upgrade_prob"),
        converted.alias("actual_conversion_rate"),
    )
    total = F.sum("user_count").over(Window.partitionBy())  # over a row per segment
    top = top_diagnostic_features(segments, features).groupBy(SEGMENT).agg(
        F.sort_array(F.collect_list(F.struct("rank", "feature", "value"))).alias("_top")
    )
    known = F.broadcast(definitions(segments.sparkSession).drop("rules"))
    return (
        sizes.withColumn("_total", total).join(top, SEGMENT).join(known, SEGMENT, "left")
        .select(
            SEGMENT, "user_count",
            share_pct(F.col("user_count"), F.col("_total"), 2).alias("pct_of_total"),
            "mean_upgrade_prob", "actual_conversion_rate",
            F.coalesce("upgrade_likelihood", F.lit(UNKNOWN_LIKELIHOOD))
            .alias("upgrade_likelihood"),
            F.transform("_top", lambda t: F.struct(t["feature"].alias("feature"),
                                                   t["value"].alias("value")))
            .alias("top_diagnostic_features"),
            F.coalesce("recommended_action", F.lit(UNKNOWN_ACTION)).alias("recommended_action"),
            F.coalesce("description", F.lit("")).alias("description"),
        )
    )


def kpi_row(feature_store: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """Labelled users, upgraders and the upgrade rate in percent.

    With a training run's metadata row, its two ROC-AUCs as well.
    """
    kpis = feature_store.agg(
        F.count(F.lit(1)).alias("labelled_users"),
        F.sum(F.col(LABEL).cast("long")).alias("upgraders"),
        F.round(F.avg(LABEL) * 100, 2).alias("upgrade_rate_pct"),
    )
    if metadata is None:
        return kpis
    return kpis.crossJoin(F.broadcast(metadata.select("oof_auc", "test_auc")))


def quantile_table(df: DataFrame, columns: Sequence[str],
                   quantiles: Mapping[str, float]) -> DataFrame:
    """Exact quantiles of each column, one row per column."""
    long = long_form(df, [], columns)
    return exact_quantiles(long, ["feature"], "value", dict(quantiles), few_groups=True)


def descriptive_stats(df: DataFrame, columns: Sequence[str] = DESCRIBED) -> DataFrame:
    """Mean, median, least and greatest value per column, to two digits."""
    columns = [c for c in columns if c in df.columns]
    spread = long_form(df, [], columns).groupBy("feature").agg(
        F.round(F.avg("value"), 2).alias("mean"), F.round(F.min("value"), 2).alias("min"),
        F.round(F.max("value"), 2).alias("max"),
    )
    medians = quantile_table(df, columns, {"median": 0.5})
    return spread.join(medians, "feature").select(
        "feature", "mean", F.round("median", 2).alias("median"), "min", "max"
    )


def form_features(feature_store: DataFrame) -> DataFrame:
    """The predictor form's own ratio and growth, for every user."""
    previous_week = F.greatest(F.col("events_last_14_to_7d"), F.lit(1))
    growth = F.round(F.col("events_last_7d") / previous_week - F.lit(1.0), 4)
    return feature_store.select(
        USER,
        F.round(F.col("friction_events") / F.greatest("total_events", F.lit(1)), 4)
        .alias("form_friction_ratio"),
        growth.alias("form_wow_growth"),
        F.when(growth > 0.20, 1).otherwise(0).alias("form_is_accelerating"),
    )


def score_minus_base_rate(scored: DataFrame) -> DataFrame:
    """Each user's score and its distance from the share of upgraders."""
    base = scored.agg(F.avg("y").alias("base_rate"))
    return scored.crossJoin(F.broadcast(base)).select(
        USER, "p", "base_rate", (F.col("p") - F.col("base_rate")).alias("delta")
    )
