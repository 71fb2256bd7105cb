"""Queries per user: cutoffs, labels, splits, features and the leakage audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from stridelog.catalog.event_queries import FEATURE_DOUBLES
from stridelog.catalog.oracle import BANNED, CORE, text_list
from stridelog.catalog.query import Collection
from stridelog.catalog.testdata import (
    events, feature_store, label_table, leaky_store, split_table,
)
from stridelog.config import (
    AUDIT_NAME_PATTERNS, BANNED_COLUMN_PATTERNS, CUTOFF, DEPTH, ENGAGEMENT, EVENT, FEATURES,
    FRICTION, LABEL, RECENCY, SOCIAL, TS, USER, VELOCITY,
)
from stridelog.operators import features, labels, leakage
from stridelog.sources.events import without_banned

QUERIES = Collection()
add = QUERIES.add


def history(s, d):
    return labels.user_history(events(s, d))


# Cutoffs, labels and splits

add("l01_user_cutoff", lambda s, d: labels.user_cutoffs(events(s, d)), "SELECT * FROM cutoff")

add("l02_banned_filter",
    lambda s, d: without_banned(events(s, d), keep_null=False).select("event_id", USER, EVENT),
    f"SELECT event_id, person_id, event FROM ev WHERE event NOT IN {BANNED}")

add("l03_clean_events",
    lambda s, d: labels.clean_events(events(s, d), history(s, d)).select(
        "event_id", USER, TS, EVENT, CUTOFF),
    "SELECT event_id, person_id, timestamp, event, user_cutoff_ts FROM clean")

add("l04_cutoff_map_filter",
    lambda s, d: labels.cutoff_filter_counts(events(s, d), label_table(s, d)), """
SELECT (SELECT COUNT(*) FROM kept) AS n_events, COUNT(*) AS n_kept,
  (SELECT COUNT(*) FROM kept) - COUNT(*) AS n_dropped FROM lclean""")

add("l05_event_counts",
    lambda s, d: labels.event_counts(events(s, d), labels.user_cutoffs(events(s, d))).drop(CUTOFF),
    "SELECT * FROM counts")

add("l06_positive_users", lambda s, d: labels.positive_users(history(s, d)),
    "SELECT person_id, 1 AS will_upgrade_in_7d FROM pos")

add("l07_promo_users", lambda s, d: labels.promo_users(history(s, d)), "SELECT * FROM promo")

add("l08_negative_users", lambda s, d: labels.negative_users(history(s, d)),
    "SELECT person_id, 0 AS will_upgrade_in_7d FROM neg")

add("l09_labelled_classes",
    lambda s, d: labels.labelled_classes(history(s, d)).select(USER, LABEL),
    "SELECT * FROM classes")

add("l10_min_activity_labels", lambda s, d: labels.build_labels(events(s, d)),
    "SELECT * FROM lab")

DIAG_SQL = """
SELECT (SELECT COUNT(*) FROM pos) AS positives_before,
  COUNT(*) FILTER (WHERE will_upgrade_in_7d = 1) AS positives_after,
  (SELECT COUNT(*) FROM neg) AS negatives_before,
  COUNT(*) FILTER (WHERE will_upgrade_in_7d = 0) AS negatives_after
FROM lab"""

add("l11_label_diagnostics", lambda s, d: labels.label_diagnostics(events(s, d)), DIAG_SQL)

add("l12_labels_with_diagnostics",
    lambda s, d: labels.labels_with_diagnostics(events(s, d)), f"""
SELECT person_id, will_upgrade_in_7d, user_cutoff_ts,
  CAST(NULL AS BIGINT) AS _diag_positives_before, CAST(NULL AS BIGINT) AS _diag_positives_after,
  CAST(NULL AS BIGINT) AS _diag_negatives_before, CAST(NULL AS BIGINT) AS _diag_negatives_after
FROM lab
UNION ALL
SELECT NULL, NULL, NULL, positives_before, positives_after, negatives_before, negatives_after
FROM ({DIAG_SQL})
ORDER BY person_id NULLS LAST""")

add("l13_time_splits", lambda s, d: labels.assign_splits(label_table(s, d)), "SELECT * FROM spl")

add("l14_split_summary", lambda s, d: labels.split_summary(split_table(s, d)), """
SELECT split, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE will_upgrade_in_7d = 1) AS n_positives,
  round(100.0 * COUNT(*) FILTER (WHERE will_upgrade_in_7d = 1) / COUNT(*)::DOUBLE, 2)
    AS positive_pct
FROM spl GROUP BY split""")


# Features of all users

def _unlabelled(*columns):
    return lambda s, d: features.unlabelled_features(events(s, d)).select(USER, *columns)


CORE_COLUMNS = ("total_events", "active_days", "active_weeks", "distinct_event_types",
                "first_event_ts", "last_event_ts")
CORE_SQL = """
SELECT person_id, COUNT(*) AS total_events,
  COUNT(DISTINCT date_trunc('day', timestamp)) AS active_days,
  COUNT(DISTINCT date_trunc('week', timestamp)) AS active_weeks,
  COUNT(DISTINCT event) AS distinct_event_types,
  MIN(timestamp) AS first_event_ts, MAX(timestamp) AS last_event_ts
FROM clean GROUP BY person_id"""

add("f01_core", _unlabelled(*CORE_COLUMNS), CORE_SQL)

DEPTH_COLUMNS = (*features.DEPTH_COUNTS, "depth_total_ai_tool_events")
DEPTH_SQL = (
    "SELECT person_id, "
    + ", ".join(f"COUNT(*) FILTER (WHERE event = '{e}') AS {c}"
                for c, e in features.DEPTH_COUNTS.items())
    + f", COUNT(*) FILTER (WHERE event IN {CORE}) AS depth_total_ai_tool_events"
    " FROM clean GROUP BY person_id"
)

add("f02_depth_counts", _unlabelled(*DEPTH_COLUMNS), DEPTH_SQL)

FRICTION_SQL = """
SELECT person_id, COUNT(*) FILTER (WHERE event = '$exception') AS friction_exception_count
FROM clean GROUP BY person_id"""

add("f03_exception_count", _unlabelled("friction_exception_count"), FRICTION_SQL)

ACCOUNT_SQL = """
SELECT person_id, date_diff('day', MIN(CASE WHEN event = 'new_user_created' THEN timestamp END),
  ANY_VALUE(user_cutoff_ts)) AS account_age_days
FROM ev JOIN cutoff USING (person_id) GROUP BY person_id"""

add("f04_account_age", lambda s, d: features.account_ages(events(s, d)), ACCOUNT_SQL)

RECENCY_SQL = """
SELECT person_id, date_diff('day', MAX(timestamp), ANY_VALUE(user_cutoff_ts))
  AS days_since_last_event
FROM clean GROUP BY person_id"""

add("f05_day_recency", _unlabelled("days_since_last_event"), RECENCY_SQL)

add("f06_user_spine", _unlabelled(), "SELECT DISTINCT person_id FROM clean")

add("f07_unlabelled_features", lambda s, d: features.unlabelled_features(events(s, d)), f"""
SELECT c.person_id, user_cutoff_ts, c.* EXCLUDE (person_id), depth.* EXCLUDE (person_id),
  friction_exception_count, account_age_days, COALESCE(days_since_last_event, 0)
    AS days_since_last_event
FROM ({CORE_SQL}) c JOIN cutoff USING (person_id)
LEFT JOIN ({DEPTH_SQL}) depth USING (person_id)
LEFT JOIN ({FRICTION_SQL}) friction USING (person_id)
LEFT JOIN ({ACCOUNT_SQL}) account USING (person_id)
LEFT JOIN ({RECENCY_SQL}) recency USING (person_id)""")


# Features of labelled users

def _group(compute, *columns):
    return lambda s, d: compute(events(s, d), label_table(s, d)).select(USER, *columns)


def _fs_sql(columns) -> str:
    return f"SELECT person_id, {', '.join(columns)} FROM fs"


def _doubles(columns):
    return [c for c in columns if c in FEATURE_DOUBLES]


def _add_group(name, compute, columns):
    add(name, _group(compute, *columns), _fs_sql(columns), _doubles(columns))


_add_group("f08_engagement_base", features.compute_engagement,
           ("total_events", "unique_event_types", "active_days"))
_add_group("f09_sessions", features.compute_engagement, ("total_sessions",))
_add_group("f10_events_per_session", features.compute_engagement, ENGAGEMENT)
_add_group("f11_trailing_windows", features.compute_velocity,
           ("events_last_7d", "events_last_14d", "events_last_30d"))
_add_group("f12_growth", features.compute_velocity, VELOCITY)
_add_group("f13_recency", features.compute_recency,
           ("days_since_last_event", "days_since_first_event"))
_add_group("f14_account_age_with_fallback", features.compute_recency, RECENCY)

add("f14_tenure_fallbacks",
    lambda s, d: features.tenure_fallbacks(events(s, d), label_table(s, d)), """
SELECT COUNT(*) AS n_users, COUNT(*) FILTER (WHERE n = 0) AS n_fallback
FROM (SELECT person_id, COUNT(*) FILTER (WHERE event = 'new_user_created') AS n
      FROM lclean GROUP BY person_id)""")


def _json_sessions(s, d):
    """Sessions from the JSON layout of the properties: the key ``k`` as session."""
    log = events(s, d).drop("canvas_id").withColumn(
        "properties", F.to_json(F.struct(F.get_json_object("props", "$.k").alias("canvas_id"))))
    return features.compute_engagement(log, label_table(s, d)).select(USER, "total_sessions")


add("f09_sessions_from_json", _json_sessions, """
SELECT lab.person_id, COUNT(DISTINCT regexp_extract(props, '([0-9]+)', 1)) AS total_sessions
FROM lab LEFT JOIN lclean USING (person_id) GROUP BY lab.person_id""")

_add_group("f15_feature_breadth", features.compute_depth, ("feature_breadth",))

PIVOT = ("ai_generation_count", "run_block_count", "agent_chat_count")
_add_group("f16_event_pivot", features.compute_depth, PIVOT)

add("f17_depth_merge", lambda s, d: features.depth_merge(events(s, d), label_table(s, d)), f"""
SELECT COALESCE(b.person_id, p.person_id) AS person_id, COALESCE(feature_breadth, 0)
    AS feature_breadth,
  COALESCE(ai, 0) AS ai_generation_count, COALESCE(run, 0) AS run_block_count,
  COALESCE(chat, 0) AS agent_chat_count
FROM (SELECT person_id, COUNT(DISTINCT event) AS feature_breadth FROM lclean
      WHERE event IN {CORE} GROUP BY person_id) b
FULL JOIN (SELECT person_id, COUNT(*) FILTER (WHERE event = '$ai_generation') AS ai,
    COUNT(*) FILTER (WHERE event = 'run_block') AS run,
    COUNT(*) FILTER (WHERE event = 'agent_new_chat') AS chat
  FROM lclean WHERE event IN ('$ai_generation', 'run_block', 'agent_new_chat')
  GROUP BY person_id) p ON b.person_id = p.person_id""")

_add_group("f18_aha_moment", features.compute_depth, DEPTH)
_add_group("f19_friction", features.compute_friction, FRICTION)
_add_group("f20_social", features.compute_social, SOCIAL)

add("f21_feature_store",
    lambda s, d: features.build_feature_store(events(s, d), label_table(s, d)),
    "SELECT * FROM fs", FEATURE_DOUBLES)


def _sanitation(s, d):
    log = events(s, d)
    times = log.agg(F.count(F.lit(1)).alias("n_events"),
                    F.count_if(F.col(TS).isNull()).alias("n_bad_ts"))
    return times.crossJoin(F.broadcast(features.bad_cutoffs(label_table(s, d))))


add("f22_temporal_sanitation", _sanitation, """
SELECT COUNT(*) AS n_events, COUNT(*) FILTER (WHERE timestamp IS NULL) AS n_bad_ts,
  (SELECT COUNT(*) FROM lab) AS n_labels,
  (SELECT COUNT(*) FROM lab WHERE user_cutoff_ts IS NULL) AS n_bad FROM ev""")


def _null_audit(s, d):
    """Over all users with cutoffs 20 days early, so that some have no events."""
    spine = labels.user_cutoffs(events(s, d)).withColumn(
        CUTOFF, F.col(CUTOFF) - F.expr("INTERVAL 20 DAYS"))
    before = features.joined_features(events(s, d), spine).select(*FEATURES)
    return features.null_audit(before, before.na.fill(0))


add("f23_null_audit", _null_audit, f"""
SELECT {len(FEATURES)} * COUNT(*) FILTER (WHERE n = 0) AS nulls_before, CAST(0 AS BIGINT) AS nulls_after
FROM (
  SELECT c.person_id, COUNT(ev.event_id) AS n
  FROM cutoff c LEFT JOIN ev ON ev.person_id = c.person_id AND event NOT IN {BANNED}
    AND timestamp <= user_cutoff_ts - INTERVAL 20 DAY
  GROUP BY c.person_id)""")


# Leakage audit

def _names_sql(patterns, columns) -> str:
    rows = text_list(columns)[1:-1]
    match = "(?i)(" + "|".join(patterns) + ")"
    return f"""
SELECT 1 AS layer, name AS "column", 'column name contains banned pattern '''
    || regexp_extract(name, '{match}', 1) || '''' AS reason, 'HIGH' AS severity
FROM (SELECT unnest([{rows}]) AS name)
WHERE regexp_matches(name, '{match}') AND (SELECT COUNT(*) FROM leaky) > 0"""


EXTRA = ("addon_credit_uses", "Promo_Code_uses", "post_conversion_flag", "upgrade_total")
LEAKY_COLUMNS = ("person_id", "user_cutoff_ts", *FEATURES, *EXTRA, "timestamp")
LEAKY_NUMERIC = (*FEATURES, *EXTRA)

add("a01_column_names",
    lambda s, d: leakage.name_findings(leakage.column_catalog(leaky_store(s, d))),
    _names_sql(AUDIT_NAME_PATTERNS, LEAKY_COLUMNS))

CORRELATIONS_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", corr("{c}", will_upgrade_in_7d) AS raw_r,
COUNT(*) FILTER (WHERE "{c}" IS NOT NULL) AS n_pairs FROM leaky""" for c in LEAKY_NUMERIC)
CORRELATION_SQL = f"""
SELECT "column", CASE WHEN isnan(raw_r) THEN NULL ELSE raw_r END AS r, n_pairs
FROM ({CORRELATIONS_SQL})"""

add("a02_label_correlations", lambda s, d: leakage.label_correlations(leaky_store(s, d)),
    CORRELATION_SQL, ["r"])

FLAGGED_SQL = f"""
SELECT 2 AS layer, "column", 'Pearson |r| = ' || printf('%.4f', abs(r)) || ' > 0.95 with label'
    AS reason, 'HIGH' AS severity
FROM ({CORRELATION_SQL}) WHERE n_pairs >= 10 AND abs(r) > 0.95"""

add("a02_high_correlation", lambda s, d: leakage.correlation_findings(leaky_store(s, d)),
    FLAGGED_SQL)

LATE_SQL = """
SELECT 3 AS layer, 'timestamp / user_cutoff_ts' AS "column",
  COUNT(*) || ' row(s) have timestamp > user_cutoff_ts (post-cutoff data)' AS reason,
  'CRITICAL' AS severity
FROM leaky WHERE timestamp > user_cutoff_ts HAVING COUNT(*) > 0"""

add("a03_post_cutoff_rows", lambda s, d: leakage.post_cutoff_findings(leaky_store(s, d)),
    LATE_SQL)

add("a04_audit", lambda s, d: leakage.audit_features(leaky_store(s, d)),
    f"{_names_sql(AUDIT_NAME_PATTERNS, LEAKY_COLUMNS)} UNION ALL {FLAGGED_SQL} "
    f"UNION ALL {LATE_SQL}")

add("a05_banned_patterns",
    lambda s, d: leakage.name_findings(leakage.column_catalog(leaky_store(s, d)),
                                       patterns=BANNED_COLUMN_PATTERNS),
    _names_sql(BANNED_COLUMN_PATTERNS, LEAKY_COLUMNS))

add("a05_without_banned_columns",
    lambda s, d: leakage.drop_banned_columns(leaky_store(s, d)).select(
        "*").drop("timestamp", *FEATURE_DOUBLES),
    "SELECT * EXCLUDE (addon_credit_uses, \"Promo_Code_uses\", post_conversion_flag, timestamp, "
    + ", ".join(FEATURE_DOUBLES) + ") FROM leaky")

LONG_SQL = " UNION ALL ".join(
    f"SELECT person_id, {i} AS i, '{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM fs"
    for i, f in enumerate(FEATURES))

add("a06_feature_correlations",
    lambda s, d: leakage.feature_correlations(feature_store(s, d), FEATURES), f"""
WITH long AS ({LONG_SQL})
SELECT feature_a, feature_b, CASE WHEN isnan(r) THEN NULL ELSE r END AS r FROM (
  SELECT a.feature AS feature_a, b.feature AS feature_b, corr(a.v, b.v) AS r
  FROM long a JOIN long b ON a.person_id = b.person_id AND a.i < b.i
  GROUP BY a.feature, b.feature)""", ["r"])
