"""The derived tables in plain SQL, as common table expressions every check starts with.

Written on its own terms: joins, filters and window-free aggregates as one would state
the definitions, not as the operators compute them.
"""

from __future__ import annotations

from stridelog.catalog.testdata import CANVAS, EVENT_NAME, PERSON, SCORE
from stridelog.config import BANNED_EVENTS, CORE_EVENTS, FEATURES


def text_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


BANNED = text_list(BANNED_EVENTS)
CORE = text_list(CORE_EVENTS)
AGE = "date_diff('microsecond', timestamp, user_cutoff_ts) / 86400000000.0"
FEATURE_LIST = ", ".join(FEATURES)

SEGMENT_CASE = """
CASE
  WHEN hit_aha_moment = 1 AND feature_breadth >= 4 AND ai_generation_count >= 10
    AND run_block_count + agent_chat_count >= 5 AND unique_event_types >= 20 THEN 'Power User'
  WHEN hit_aha_moment = 1 AND ai_generation_count >= 5 AND run_block_count >= 1
    AND unique_event_types >= 10 THEN 'AI Builder'
  WHEN agent_chat_count >= 3 AND feature_breadth >= 2 AND active_days >= 3
    AND unique_event_types >= 8 THEN 'Collaborator'
  WHEN feature_breadth >= 2 AND total_events >= 20 AND unique_event_types >= 8
    AND days_since_last_event <= 14 THEN 'Explorer'
  WHEN (run_block_count >= 1 OR ai_generation_count >= 1) AND total_events >= 5
    AND unique_event_types >= 3 THEN 'Creator'
  WHEN total_events < 30 AND feature_breadth <= 1 AND days_since_first_event <= 30
    THEN 'Onboarding'
  WHEN days_since_last_event > 14 OR (total_events < 5 AND days_since_first_event > 14)
    THEN 'Dormant'
  ELSE 'Unclassified'
END
"""

PREFIX = f"""
WITH raw_events AS (
  SELECT event_id, user_id, ts, event_type, props,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, user_id % 8 AS c
  FROM events
),
ev AS (
  SELECT event_id, CAST({PERSON} AS VARCHAR) AS person_id, ts AS "timestamp",
    {EVENT_NAME.format(STR="VARCHAR")} AS event,
    {CANVAS.format(STR="VARCHAR")} AS canvas_id, props
  FROM raw_events
),
cutoff AS (
  SELECT person_id,
    COALESCE(MIN(CASE WHEN event = 'subscription_upgraded' THEN timestamp END),
             MAX(timestamp)) AS user_cutoff_ts
  FROM ev GROUP BY person_id
),
clean AS (
  SELECT ev.*, cutoff.user_cutoff_ts FROM ev JOIN cutoff USING (person_id)
  WHERE event NOT IN {BANNED} AND timestamp <= user_cutoff_ts
),
counts AS (SELECT person_id, COUNT(*) AS pre_cutoff_events FROM clean GROUP BY person_id),
pos AS (SELECT DISTINCT person_id FROM ev WHERE event = 'subscription_upgraded'),
promo AS (SELECT DISTINCT person_id FROM ev WHERE event = 'promo_code_redeemed'),
neg AS (
  SELECT DISTINCT person_id FROM ev
  WHERE person_id NOT IN (SELECT person_id FROM pos)
    AND person_id NOT IN (SELECT person_id FROM promo)
),
classes AS (
  SELECT person_id, 1 AS will_upgrade_in_7d FROM pos
  UNION ALL SELECT person_id, 0 FROM neg
),
lab AS (
  SELECT person_id, will_upgrade_in_7d, user_cutoff_ts
  FROM classes JOIN counts USING (person_id) JOIN cutoff USING (person_id)
  WHERE pre_cutoff_events >= 5
),
ends AS (
  SELECT quantile_cont(epoch(user_cutoff_ts), 0.70) AS train_end,
         quantile_cont(epoch(user_cutoff_ts), 0.85) AS val_end FROM lab
),
spl AS (
  SELECT lab.*, CASE WHEN epoch(user_cutoff_ts) <= train_end THEN 'train'
                     WHEN epoch(user_cutoff_ts) <= val_end THEN 'validation'
                     ELSE 'test' END AS split
  FROM lab CROSS JOIN ends
),
lclean AS (
  SELECT ev.*, lab.user_cutoff_ts, {AGE} AS age FROM ev JOIN lab USING (person_id)
  WHERE (event IS NULL OR event NOT IN {BANNED}) AND timestamp <= user_cutoff_ts
),
sums AS (
  SELECT person_id,
    COUNT(event) AS total_events,
    COUNT(DISTINCT event) AS unique_event_types,
    COUNT(DISTINCT canvas_id) AS total_sessions,
    COUNT(DISTINCT date_trunc('day', timestamp)) AS active_days,
    COUNT(*) FILTER (WHERE age >= 0 AND age < 7) AS events_last_7d,
    COUNT(*) FILTER (WHERE age >= 0 AND age < 14) AS events_last_14d,
    COUNT(*) FILTER (WHERE age >= 0 AND age < 30) AS events_last_30d,
    greatest(MIN(age), 0.0) AS days_since_last_event,
    greatest(MAX(age), 0.0) AS days_since_first_event,
    greatest(COALESCE(MAX(age) FILTER (WHERE event = 'new_user_created'), MAX(age)), 0.0)
      AS account_age_days,
    COUNT(DISTINCT event) FILTER (WHERE event IN {CORE}) AS feature_breadth,
    COUNT(*) FILTER (WHERE event = '$ai_generation') AS ai_generation_count,
    COUNT(*) FILTER (WHERE event = 'run_block') AS run_block_count,
    COUNT(*) FILTER (WHERE event = 'agent_new_chat') AS agent_chat_count,
    COUNT(*) FILTER (WHERE event = '$exception') AS friction_events
  FROM lclean GROUP BY person_id
),
fs AS (
  SELECT lab.person_id, will_upgrade_in_7d, user_cutoff_ts,
    COALESCE(total_events, 0) AS total_events,
    COALESCE(unique_event_types, 0) AS unique_event_types,
    COALESCE(total_sessions, 0) AS total_sessions,
    COALESCE(CAST(total_events AS DOUBLE) / NULLIF(total_sessions, 0), 0.0)
      AS avg_events_per_session,
    COALESCE(active_days, 0) AS active_days,
    COALESCE(events_last_7d, 0) AS events_last_7d,
    COALESCE(events_last_14d, 0) AS events_last_14d,
    COALESCE(events_last_30d, 0) AS events_last_30d,
    COALESCE(events_last_14d - events_last_7d, 0) AS events_last_14_to_7d,
    COALESCE((2 * events_last_7d - events_last_14d) / (events_last_14d - events_last_7d + 1.0),
             0.0)::DOUBLE AS wow_growth,
    CAST(COALESCE((2 * events_last_7d - events_last_14d)
      / (events_last_14d - events_last_7d + 1.0) > 0.20, FALSE) AS INTEGER) AS is_accelerating,
    COALESCE(days_since_last_event, 0.0) AS days_since_last_event,
    COALESCE(days_since_first_event, 0.0) AS days_since_first_event,
    COALESCE(account_age_days, 0.0) AS account_age_days,
    COALESCE(feature_breadth, 0) AS feature_breadth,
    CAST(COALESCE(feature_breadth, 0) >= 2 AS INTEGER) AS hit_aha_moment,
    COALESCE(ai_generation_count, 0) AS ai_generation_count,
    COALESCE(run_block_count, 0) AS run_block_count,
    COALESCE(agent_chat_count, 0) AS agent_chat_count,
    COALESCE(friction_events, 0) AS friction_events,
    COALESCE(CAST(friction_events AS DOUBLE) / NULLIF(total_events, 0), 0.0) AS friction_ratio,
    0 AS is_social_user
  FROM lab LEFT JOIN sums USING (person_id)
),
seg AS (SELECT fs.*, {SEGMENT_CASE} AS funnel_segment FROM fs),
everyone AS (
  SELECT person_id, CAST(MAX(CASE WHEN event = 'subscription_upgraded' THEN 1 ELSE 0 END)
    AS INTEGER) AS y FROM ev GROUP BY person_id
),
scored AS (
  SELECT person_id, y, CAST({SCORE.format(SIXTEEN_TENTHS="160.0")} AS DOUBLE) AS p,
    CAST(CAST(person_id AS INT) % 3 + 1 AS INTEGER) AS fold
  FROM everyone
),
leaks AS (
  SELECT person_id, COUNT(*) FILTER (WHERE event = 'addon_credits_used') AS addon_credit_uses,
    COUNT(*) FILTER (WHERE event = 'promo_code_redeemed') AS "Promo_Code_uses",
    MAX(CASE WHEN event = 'subscription_upgraded' THEN 1 ELSE 0 END) AS post_conversion_flag,
    MAX(timestamp) AS timestamp
  FROM ev GROUP BY person_id
),
leaky AS (
  SELECT fs.*, addon_credit_uses, "Promo_Code_uses", post_conversion_flag, timestamp,
    3 * will_upgrade_in_7d AS upgrade_total
  FROM fs JOIN leaks USING (person_id)
),
kept AS (SELECT * FROM ev WHERE event IS NULL OR event NOT IN {BANNED}),
span AS (
  SELECT date_trunc('day', MIN(timestamp)) AS a, date_trunc('day', MAX(timestamp)) AS z,
    least(5, date_diff('day', date_trunc('day', MIN(timestamp)),
                       date_trunc('day', MAX(timestamp))) // 7) AS n FROM kept
),
bounds AS (
  SELECT CAST(i AS INTEGER) AS place,
    CASE WHEN i <= n THEN CAST(a AS TIMESTAMP) + to_days(CAST(7 * i AS INTEGER))
         ELSE CAST(z AS TIMESTAMP) + to_days(1) END AS boundary
  FROM span, (SELECT unnest(range(1, 8)) AS i)
  WHERE i <= n + 1 AND date_diff('day', a, z) >= 14
),
snap AS (
  SELECT person_id, place, boundary, COUNT(event) AS total_events,
    COUNT(DISTINCT event) AS unique_event_types,
    least(6, MAX(CASE WHEN event IN ('$ai_generation', 'ai_generation') THEN 1 ELSE 0 END)
      + MAX(CASE WHEN event IN ('run_block', 'block_executed', 'block_run') THEN 1 ELSE 0 END)
      + MAX(CASE WHEN lower(event) LIKE '%agent%' OR lower(event) LIKE '%chat%' THEN 1 ELSE 0 END)
      + CASE WHEN COUNT(*) >= 20 THEN 1 ELSE 0 END
      + CASE WHEN COUNT(DISTINCT event) >= 10 THEN 1 ELSE 0 END
      + CASE WHEN COUNT(DISTINCT event) >= 20 THEN 1 ELSE 0 END) AS feature_breadth,
    MAX(CASE WHEN event IN ('$ai_generation', 'ai_generation', 'run_block', 'block_executed',
      'block_run', 'agent_chat', 'notebook_shared', 'deployment_created', 'query_executed')
      THEN 1 ELSE 0 END) AS hit_aha_moment,
    COUNT(*) FILTER (WHERE event IN ('$ai_generation', 'ai_generation')) AS ai_generation_count,
    COUNT(*) FILTER (WHERE event IN ('run_block', 'block_executed', 'block_run'))
      AS run_block_count,
    COUNT(*) FILTER (WHERE lower(event) LIKE '%agent%' OR lower(event) LIKE '%chat%')
      AS agent_chat_count,
    COUNT(DISTINCT date_trunc('day', timestamp)) AS active_days,
    date_diff('microsecond', MAX(timestamp), boundary) / 86400000000.0 AS days_since_last_event,
    date_diff('microsecond', MIN(timestamp), boundary) / 86400000000.0 AS days_since_first_event
  FROM kept JOIN bounds ON timestamp <= boundary
  GROUP BY person_id, place, boundary
),
snapseg AS (SELECT person_id, place, {SEGMENT_CASE} AS funnel_segment FROM snap),
moves AS (
  SELECT a.person_id, a.place, a.funnel_segment AS from_segment, b.funnel_segment AS to_segment
  FROM snapseg a JOIN snapseg b ON a.person_id = b.person_id AND b.place = a.place + 1
),
trans AS (
  SELECT from_segment, to_segment, COUNT(*) AS n,
    round(COUNT(*)::DOUBLE / (SELECT COUNT(*) FROM moves m WHERE m.from_segment = t.from_segment),
          4) AS prob
  FROM moves t GROUP BY from_segment, to_segment
)
"""


def sql(body: str, doubles=()) -> str:
    """A whole query: the shared tables, the body, and its doubles to nine digits."""
    if not doubles:
        return PREFIX + f"SELECT * FROM (\n{body}\n) AS result"
    rounding = ", ".join(f'round("{c}", 9) AS "{c}"' for c in doubles)
    return PREFIX + f"SELECT * REPLACE ({rounding}) FROM (\n{body}\n) AS result"
