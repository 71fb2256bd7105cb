"""Names, fixed values and thresholds shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

# Columns of the event log and of the tables derived from it.
USER = "person_id"
TS = "timestamp"
EVENT = "event"
CUTOFF = "user_cutoff_ts"
LABEL = "will_upgrade_in_7d"
SPLIT = "split"
SEGMENT = "funnel_segment"

# Events with a meaning of their own.
UPGRADE_EVENT = "subscription_upgraded"
PROMO_EVENT = "promo_code_redeemed"
TENURE_EVENT = "new_user_created"

# Events that never count as behaviour, because they are the
# target, reveal it, or follow it.
BANNED_EVENTS = (
    "subscription_upgraded",
    "promo_code_redeemed",
    "addon_credits_used",
    "offer_declined",
    "credits_exceeded",
    "credits_below_1",
    "credits_below_2",
    "credits_below_3",
    "credits_below_4",
    "notebook_deployment_usage_tracked",
)

# The events that make up feature breadth.
CORE_EVENTS = (
    "agent_new_chat",
    "$ai_generation",
    "run_block",
    "agent_tool_call_create_block_tool",
    "agent_tool_call_run_block_tool",
    "agent_tool_call_get_block_tool",
)

# Events that count as friction.
FRICTION_EVENTS = ("$exception",)

# No sharing or invitation event is known; a caller with such events passes them in.
SOCIAL_EVENTS: tuple[str, ...] = ()

# Column-name patterns the audit reports.
AUDIT_NAME_PATTERNS = (
    "subscription_upgraded",
    "upgrade",
    "will_upgrade",
    "promo_code",
    "addon",
    "notebook_deployment",
)

# The wider pattern list, for dropping columns outright.
BANNED_COLUMN_PATTERNS = (
    "clicked_upgrade",
    "viewed_pricing",
    "started_trial",
    "billing_event",
    "upgrade_initiated",
    "conversion_flag",
    "account_type",
    "plan_type",
    "plan_name",
    "is_premium",
    "subscription_status",
    "post_",
    "_after_",
    "following_",
    "next_",
    "future_",
    "redeem_upgrade",
    "promo_code",
    "addon_credit",
    "credits_awarded",
    "credits_received",
    "total_addon_credits",
    "offer_declined",
    "notebook_deployment",
)

# The feature store's columns, by group.
ENGAGEMENT = (
    "total_events",
    "unique_event_types",
    "total_sessions",
    "avg_events_per_session",
    "active_days",
)
VELOCITY = (
    "events_last_7d",
    "events_last_14d",
    "events_last_30d",
    "events_last_14_to_7d",
    "wow_growth",
    "is_accelerating",
)
RECENCY = ("days_since_last_event", "days_since_first_event", "account_age_days")
DEPTH = (
    "feature_breadth",
    "hit_aha_moment",
    "ai_generation_count",
    "run_block_count",
    "agent_chat_count",
)
FRICTION = ("friction_events", "friction_ratio")
SOCIAL = ("is_social_user",)
FEATURES = ENGAGEMENT + VELOCITY + RECENCY + DEPTH + FRICTION + SOCIAL

# Columns a scoring request carries, with their allowed range (None = unbounded).
FLAGS_AND_RATIOS = ("is_accelerating", "hit_aha_moment", "friction_ratio")
PREDICTION_RANGES = {
    name: (None, None)
    if name == "wow_growth"
    else (0.0, 1.0 if name in FLAGS_AND_RATIOS else None)
    for name in FEATURES
    if name not in SOCIAL
}

# The columns clustering looks at.
CLUSTER_FEATURES = (
    "total_events",
    "unique_event_types",
    "total_sessions",
    "wow_growth",
    "days_since_last_event",
    "feature_breadth",
    "hit_aha_moment",
    "friction_ratio",
    "active_days",
    "is_accelerating",
    "ai_generation_count",
    "run_block_count",
    "agent_chat_count",
)

# Lead tiers, highest bound first, as (lowest score, tier, action).
LEAD_TIERS = (
    (0.75, "HOT_LEAD", "Trigger in-app upgrade modal"),
    (0.50, "WARM_LEAD", "Send personalized feature highlight email"),
    (0.25, "NURTURE", "Enroll in drip campaign"),
    (0.00, "COLD", "Focus on Aha moment activation"),
)

MIN_EVENTS = 5
SPLIT_QUANTILES = (0.70, 0.85)
CORRELATION_LIMIT = 0.95
UNCLASSIFIED_LIMIT_PCT = 10.0
ACCELERATION_LIMIT = 0.20
SEED = 42
FOLDS = 3


@dataclass(frozen=True)
class SkewPolicy:
    """When a user's events are split into pieces, and how many users that may concern.

    A user counts as hot above ``rows_per_piece`` events, or above an equal share
    of ``1 / max_hot_users`` of the log when that is more. At most ``max_hot_users``
    users can pass the second bound, so the list of hot users always broadcasts.
    """

    rows_per_piece: int = 2_000_000
    max_hot_users: int = 20_000


SKEW = SkewPolicy()
