"""Rule-based funnel segments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelog.config import LABEL, SEGMENT, UNCLASSIFIED_LIMIT_PCT, USER
from stridelog.functions.columns import first_match, safe_ratio, share_pct

UNCLASSIFIED = "Unclassified"

# Segment, rule as shown to readers, likelihood, action, description.
SEGMENT_DEFINITIONS = (
    (
        "Power User",
        "hit_aha_moment==1 AND feature_breadth>=4 AND ai_generation_count>=10 AND "
        "(run_block_count+agent_chat_count)>=5 AND unique_event_types>=20",
        "High",
        "Offer upgrade prompt, personalised plan comparison, priority support",
        "Heaviest platform consumers: multi-feature, high AI generation, agent tool "
        "invocations, block execution, hit AHA moment. Broadest feature footprint — most "
        "likely to upgrade.",
    ),
    (
        "AI Builder",
        "hit_aha_moment==1 AND ai_generation_count>=5 AND run_block_count>=1 AND "
        "unique_event_types>=10",
        "High",
        "Showcase advanced AI features and collaboration tools",
        "Users actively using AI generation and block execution. Have hit the AHA moment "
        "but slightly narrower feature breadth than Power Users.",
    ),
    (
        "Collaborator",
        "agent_chat_count>=3 AND feature_breadth>=2 AND active_days>=3 AND "
        "unique_event_types>=8",
        "Medium",
        "Highlight team collaboration features and deployment capabilities",
        "Users engaged in agent conversations and multi-feature workflows. Consistent "
        "activity across multiple days.",
    ),
    (
        "Explorer",
        "feature_breadth>=2 AND total_events>=20 AND unique_event_types>=8 AND "
        "days_since_last_event<=14",
        "Medium",
        "Guide toward AHA moment — suggest AI features and block execution",
        "Users experimenting across multiple feature types. Good event volume, beginning "
        "to see breadth — AHA not yet triggered.",
    ),
    (
        "Creator",
        "(run_block_count>=1 OR ai_generation_count>=1) AND total_events>=5 AND "
        "unique_event_types>=3",
        "Low",
        "Nurture with tutorials and use-case showcases to deepen engagement",
        "Users who have created content (run blocks or generated AI output). Some platform "
        "depth but limited breadth or recency.",
    ),
    (
        "Onboarding",
        "total_events<30 AND feature_breadth<=1 AND days_since_first_event<=30",
        "Low",
        "Onboarding flow, first-run prompts, activation nudges",
        "New or very early-stage users. Low event counts, narrow feature exposure, joined "
        "recently or hasn't progressed yet.",
    ),
    (
        "Dormant",
        "days_since_last_event>14 OR (total_events<5 AND days_since_first_event>14)",
        "Low",
        "Win-back campaign — re-engagement email with new feature highlight",
        "Users who have not been active recently or have very low lifetime engagement. "
        "Risk of permanent churn.",
    ),
)
SEGMENT_ORDER = tuple(d[0] for d in SEGMENT_DEFINITIONS)

# What a report says about a segment without a definition.
UNKNOWN_ACTION = "Review and classify manually"
UNKNOWN_LIKELIHOOD = "Unknown"

# The columns segmentation needs.
REQUIRED_COLUMNS = (
    "hit_aha_moment", "feature_breadth", "ai_generation_count", "run_block_count",
    "agent_chat_count", "unique_event_types", "total_events", "active_days",
    "days_since_last_event", "days_since_first_event",
)

# The columns whose means describe a segment.
STAT_MEANS = (
    "active_days", "feature_breadth", "friction_ratio", "unique_event_types",
    "total_events", "hit_aha_moment", "ai_generation_count",
)
# Further columns whose means are given where they exist.
OPTIONAL_MEANS = ("upgrade_probability", LABEL)


def _rule(text: str) -> str:
    return text.replace("==", "=")


# The rules as shown are plain predicates over the columns, so they are also what runs.
FUNNEL_RULES = tuple((d[0], _rule(d[1])) for d in SEGMENT_DEFINITIONS)

# A coarser funnel of five stages; deepest stage first.
FIVE_STAGE_RULES = (
    ("Power User", "total_events > 200 AND feature_breadth > 8"),
    ("Code Runner", "run_block_count > 10"),
    ("AI Engaged", "ai_generation_count > 0"),
    ("New User", "total_events < 10"),
    ("Exploring", "total_events >= 10 AND total_events < 50"),
)


def segment_column(rules: Sequence[tuple[str, str]] = FUNNEL_RULES) -> Column:
    """The first rule a row satisfies, as an expression."""
    return first_match([(name, F.expr(rule)) for name, rule in rules], UNCLASSIFIED)


def missing_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> list[str]:
    return [c for c in required if c not in df.columns]


def with_segment(feature_store: DataFrame,
                 rules: Sequence[tuple[str, str]] = FUNNEL_RULES) -> DataFrame:
    """Add ``funnel_segment``, without checking how many users stay unclassified."""
    if rules is FUNNEL_RULES and (missing := missing_columns(feature_store)):
        raise KeyError(f"missing columns for segments: {missing}")
    return feature_store.withColumn(SEGMENT, segment_column(rules))


def unclassified_share(segments: DataFrame,
                       limit_pct: float = UNCLASSIFIED_LIMIT_PCT) -> DataFrame:
    """Users, unclassified users, their share in percent, and whether it is within the limit."""
    share = safe_ratio(F.lit(100.0) * F.col("n_unclassified"), F.col("n_users"), 0.0)
    return segments.agg(
        F.count(F.lit(1)).alias("n_users"),
        F.count_if(F.col(SEGMENT) == UNCLASSIFIED).alias("n_unclassified"),
    ).select(
        "n_users", "n_unclassified", F.round(share, 1).alias("pct_unclassified"),
        F.when(share > limit_pct, "FAIL").otherwise("PASS").alias("status"),
    )


def assign_segments(feature_store: DataFrame,
                    rules: Sequence[tuple[str, str]] = FUNNEL_RULES,
                    limit_pct: float = UNCLASSIFIED_LIMIT_PCT) -> DataFrame:
    """Add ``funnel_segment``; raises when too many users match no rule."""
    segments = with_segment(feature_store, rules)
    result = unclassified_share(segments, limit_pct).first()
    if result["status"] == "FAIL":
        raise ValueError(
            f"{result['n_unclassified']} of {result['n_users']} users match no segment rule "
            f"({result['pct_unclassified']}% > {limit_pct}%)"
        )
    return segments


def segment_order(spark: SparkSession, names: Sequence[str] = SEGMENT_ORDER) -> DataFrame:
    """All segments with their place in the funnel, ``Unclassified`` last."""
    rows = [(name, i) for i, name in enumerate((*names, UNCLASSIFIED))]
    return spark.createDataFrame(rows, f"{SEGMENT} STRING, place INT")


def definitions(spark: SparkSession) -> DataFrame:
    """The segment definitions as a table."""
    return spark.createDataFrame(
        list(SEGMENT_DEFINITIONS),
        f"{SEGMENT} STRING, rules STRING, upgrade_likelihood STRING, "
        "recommended_action STRING, description STRING",
    )


def described_segments(segments: DataFrame) -> DataFrame:
    """The definition of every segment, with how many users it has now."""
    sizes = segments.groupBy(SEGMENT).agg(F.count(F.lit(1)).alias("user_count"))
    return F.broadcast(definitions(segments.sparkSession)).join(sizes, SEGMENT, "left").select(
        SEGMENT, "rules", "upgrade_likelihood", "recommended_action", "description",
        F.coalesce("user_count", F.lit(0)).alias("user_count"),
    )


def segment_distribution(segments: DataFrame,
                         names: Sequence[str] = SEGMENT_ORDER) -> DataFrame:
    """Users and share per segment, empty segments included."""
    sizes = segments.groupBy(SEGMENT).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n").alias("_total"))
    return (
        segment_order(segments.sparkSession, names)
        .join(sizes, SEGMENT, "left")
        .crossJoin(F.broadcast(total))
        .select(
            SEGMENT, F.coalesce("n", F.lit(0)).alias("user_count"),
            share_pct(F.coalesce("n", F.lit(0)), F.col("_total"), 1).alias("pct"),
        )
    )


def get_segment_stats(segments: DataFrame) -> DataFrame:
    """Size, share and feature means per segment, in funnel order."""
    if SEGMENT not in segments.columns:
        raise KeyError(f"no {SEGMENT} column; run assign_segments first")
    means = [*STAT_MEANS, *[c for c in OPTIONAL_MEANS if c in segments.columns]]
    stats = segments.groupBy(SEGMENT).agg(
        F.count(USER).alias("user_count"), F.count(F.lit(1)).alias("_rows"),
        *[F.round(F.avg(c), 3).alias(c) for c in means],
    )
    total = F.sum("_rows").over(Window.partitionBy())  # over a row per segment
    place = F.broadcast(segment_order(segments.sparkSession))
    return (
        stats.withColumn("_total", total).join(place, SEGMENT, "left")
        .orderBy(F.asc_nulls_last("place"))
        .select(
            SEGMENT, "user_count",
            share_pct(F.col("user_count"), F.col("_total"), 1).alias("pct_of_total"), *means,
        )
    )


def segment_conversion(segments: DataFrame) -> DataFrame:
    """Users, upgraders, conversion and share per segment, largest first."""
    sizes = segments.groupBy(SEGMENT).agg(
        F.count(SEGMENT).alias("user_count"),
        F.sum(F.col(LABEL).cast("long")).alias("upgraders"),
        F.round(F.avg(F.col(LABEL)) * 100, 2).alias("conv_rate_pct"),
    )
    total = F.sum("user_count").over(Window.partitionBy())  # over a row per segment
    return sizes.select(
        SEGMENT, "user_count", "upgraders", "conv_rate_pct",
        share_pct(F.col("user_count"), total, 1).alias("share_pct"),
    ).orderBy(F.desc("user_count"), SEGMENT)


def rules_from(definitions_by_name: Mapping[str, str]) -> tuple[tuple[str, str], ...]:
    """Rules for ``with_segment`` from a name-to-predicate mapping, in its order."""
    return tuple((name, _rule(text)) for name, text in definitions_by_name.items())
