"""Queries over segments, their weekly moves and their check by clustering."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelog.catalog.query import Collection
from stridelog.catalog.testdata import events, feature_store, segment_table, stage
from stridelog.config import CLUSTER_FEATURES, SEGMENT, USER
from stridelog.operators import clustering, segments, transitions
from stridelog.operators.segments import SEGMENT_DEFINITIONS
from stridelog.sources import validation

QUERIES = Collection()
add = QUERIES.add

ORDER = [*segments.SEGMENT_ORDER, segments.UNCLASSIFIED]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


DEFINITIONS_SQL = "(VALUES " + ", ".join(
    "(" + ", ".join(_quoted(v) for v in row) + ")" for row in SEGMENT_DEFINITIONS
) + ") AS def(funnel_segment, rules, upgrade_likelihood, recommended_action, description)"
ORDER_SQL = "(VALUES " + ", ".join(f"('{s}', {i})" for i, s in enumerate(ORDER)) \
    + ") AS places(funnel_segment, place)"


# Segments

add("g01_segments", lambda s, d: segment_table(s, d).select(USER, SEGMENT),
    "SELECT person_id, funnel_segment FROM seg")

add("g02_required_columns",
    lambda s, d: validation.column_findings(feature_store(s, d), segments.REQUIRED_COLUMNS),
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) AS n_rows, COUNT({c}) AS n_values, 'ok' AS status FROM fs"
        for c in segments.REQUIRED_COLUMNS))

add("g03_segment_distribution",
    lambda s, d: segments.segment_distribution(segment_table(s, d)), f"""
SELECT places.funnel_segment, COUNT(person_id) AS user_count,
  round(100.0 * COUNT(person_id) / (SELECT COUNT(*) FROM seg)::DOUBLE, 1) AS pct
FROM {ORDER_SQL} LEFT JOIN seg USING (funnel_segment) GROUP BY places.funnel_segment""")

add("g04_coverage_guard",
    lambda s, d: segments.unclassified_share(segments.assign_segments(feature_store(s, d))), """
SELECT COUNT(*) AS n_users,
  COUNT(*) FILTER (WHERE funnel_segment = 'Unclassified') AS n_unclassified,
  round(100.0 * COUNT(*) FILTER (WHERE funnel_segment = 'Unclassified') / COUNT(*)::DOUBLE, 1)
    AS pct_unclassified, 'PASS' AS status
FROM seg""")

MEANS = ("active_days", "feature_breadth", "friction_ratio", "unique_event_types",
         "total_events", "hit_aha_moment", "ai_generation_count", "will_upgrade_in_7d")

add("g05_segment_stats", lambda s, d: segments.get_segment_stats(segment_table(s, d)), f"""
SELECT funnel_segment, COUNT(*) AS user_count,
  round(100.0 * COUNT(*) / (SELECT COUNT(*) FROM seg)::DOUBLE, 1) AS pct_of_total,
  {", ".join(f"round(AVG({c}), 3) AS {c}" for c in MEANS)}
FROM seg JOIN {ORDER_SQL} USING (funnel_segment) GROUP BY funnel_segment ORDER BY MIN(place)""")

add("g06_segment_definitions",
    lambda s, d: segments.described_segments(segment_table(s, d)), f"""
SELECT def.*, (SELECT COUNT(*) FROM seg WHERE seg.funnel_segment = def.funnel_segment)
  AS user_count FROM {DEFINITIONS_SQL}""")

add("g07_segment_conversion",
    lambda s, d: segments.segment_conversion(segment_table(s, d)), """
SELECT funnel_segment, COUNT(*) AS user_count, CAST(SUM(will_upgrade_in_7d) AS BIGINT)
    AS upgraders,
  round(AVG(will_upgrade_in_7d) * 100, 2) AS conv_rate_pct,
  round(100.0 * COUNT(*) / (SELECT COUNT(*) FROM seg)::DOUBLE, 1) AS share_pct
FROM seg GROUP BY funnel_segment ORDER BY user_count DESC, funnel_segment""")

add("g08_five_stage_funnel",
    lambda s, d: segments.with_segment(feature_store(s, d), segments.FIVE_STAGE_RULES).select(
        USER, SEGMENT), """
SELECT person_id, CASE WHEN total_events > 200 AND feature_breadth > 8 THEN 'Power User'
  WHEN run_block_count > 10 THEN 'Code Runner' WHEN ai_generation_count > 0 THEN 'AI Engaged'
  WHEN total_events < 10 THEN 'New User'
  WHEN total_events BETWEEN 10 AND 49 THEN 'Exploring' ELSE 'Unclassified' END AS funnel_segment
FROM fs""")


# Weekly moves

add("t01_boundaries", lambda s, d: transitions.snapshot_boundaries(events(s, d)),
    "SELECT place, boundary FROM bounds")

add("t02_cumulative_counts",
    lambda s, d: transitions.snapshot_features(events(s, d)).groupBy("place", "boundary").agg(
        F.sum("total_events").alias("n_events"), F.count(F.lit(1)).alias("n_users")), """
SELECT place, boundary, COUNT(*) AS n_events, COUNT(DISTINCT person_id) AS n_users
FROM kept JOIN bounds ON timestamp <= boundary GROUP BY place, boundary""")

RECENCY = ["days_since_last_event", "days_since_first_event"]

add("t03_snapshot_features", lambda s, d: transitions.snapshot_features(events(s, d)),
    "SELECT * FROM snap", RECENCY)

add("t04_agent_events",
    lambda s, d: events(s, d).where(transitions.is_agent_event(F.col("event")))
    .groupBy("event").agg(F.count(F.lit(1)).alias("n")), """
SELECT event, COUNT(*) AS n FROM ev
WHERE lower(event) LIKE '%agent%' OR lower(event) LIKE '%chat%' GROUP BY event""")

add("t05_snapshot_breadth",
    lambda s, d: transitions.snapshot_features(events(s, d)).select(
        USER, "place", "feature_breadth"),
    "SELECT person_id, place, feature_breadth FROM snap")

add("t06_snapshot_aha",
    lambda s, d: transitions.snapshot_features(events(s, d)).select(
        USER, "place", "hit_aha_moment"),
    "SELECT person_id, place, hit_aha_moment FROM snap")

add("t07_snapshot_segments", lambda s, d: transitions.snapshot_segments(events(s, d)),
    "SELECT * FROM snapseg")

add("t08_segment_moves", lambda s, d: transitions.segment_moves(events(s, d)),
    "SELECT * FROM moves")

add("t09_transition_counts", lambda s, d: transitions.transition_counts(events(s, d)),
    "SELECT from_segment, to_segment, n FROM trans")

add("t10_transition_probabilities",
    lambda s, d: transitions.transition_probabilities(events(s, d)), "SELECT * FROM trans")

add("t10_transition_matrix", lambda s, d: transitions.compute_transition_matrix(events(s, d)),
    "SELECT from_segment, " + ", ".join(
        f"COALESCE(MAX(prob) FILTER (WHERE to_segment = '{g}'), 0.0) AS \"{g}\"" for g in ORDER
    ) + " FROM trans GROUP BY from_segment")



def _active_cells(s, d):
    """The cells of the matrix without the columns that no one moves to."""
    matrix = transitions.active_targets(transitions.compute_transition_matrix(events(s, d)))
    targets = [c for c in matrix.columns if c != "from_segment"]
    return matrix.unpivot(["from_segment"], targets, "to_segment", "prob")


add("t10_active_targets", _active_cells, """
SELECT f.from_segment, g.to_segment, COALESCE(t.prob, 0.0) AS prob
FROM (SELECT DISTINCT from_segment FROM trans) f
CROSS JOIN (SELECT to_segment FROM trans GROUP BY to_segment HAVING SUM(prob) > 0) g
LEFT JOIN trans t ON t.from_segment = f.from_segment AND t.to_segment = g.to_segment""")

add("t11_matrix_cells",
    lambda s, d: transitions.matrix_cells(transitions.transition_probabilities(events(s, d))), """
SELECT from_segment, to_segment,
  CASE WHEN prob >= 0.005 THEN printf('%.0f%%', prob * 100) ELSE '' END AS cell FROM trans""")


# Clustering

DOUBLE_COLUMNS = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in CLUSTER_FEATURES)

add("k01_cluster_input", lambda s, d: clustering.cluster_input(feature_store(s, d)),
    f"SELECT person_id, {DOUBLE_COLUMNS} FROM fs", CLUSTER_FEATURES)

SCALED = ", ".join(
    f"(CAST({c} AS DOUBLE) - (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM fs))"
    f" / COALESCE(NULLIF((SELECT quantile_cont(CAST({c} AS DOUBLE), 0.75)"
    f" - quantile_cont(CAST({c} AS DOUBLE), 0.25) FROM fs), 0.0), 1.0) AS {c}"
    for c in CLUSTER_FEATURES)

add("k02_robust_scaling",
    lambda s, d: clustering.robust_scaled(clustering.cluster_input(feature_store(s, d)),
                                          CLUSTER_FEATURES),
    f"SELECT person_id, {SCALED} FROM fs", CLUSTER_FEATURES)


_vectors: dict[tuple[str, str], DataFrame] = {}


def vectors(s: SparkSession, d: str) -> DataFrame:
    key = (s.sparkContext.applicationId, d)
    if key not in _vectors:
        _vectors[key] = clustering.cluster_vectors(feature_store(s, d))
    return _vectors[key]


def sweep(s: SparkSession, d: str) -> DataFrame:
    """Silhouette and cost per number of clusters, with ten starts each."""
    def build():
        points = vectors(s, d)
        ks = clustering.candidate_ks(points.count()) or range(2, 3)
        return clustering.k_sweep(points, ks, starts=10)
    return stage(s, d, "k-sweep", build)


def fitted(s: SparkSession, d: str) -> clustering.KMeansModel:
    key = (s.sparkContext.applicationId, d)
    if key not in _models:
        points = vectors(s, d).persist()
        try:
            _models[key] = clustering.best_of(points, clustering.best_k(sweep(s, d)), starts=20)
        finally:
            points.unpersist()
    return _models[key]


_models: dict[tuple[str, str], clustering.KMeansModel] = {}


def clusters(s: SparkSession, d: str) -> DataFrame:
    return stage(s, d, "clusters", lambda: segment_table(s, d).join(
        fitted(s, d).transform(vectors(s, d)).select(USER, clustering.CLUSTER), USER))


def fixed_clusters(s: SparkSession, d: str) -> DataFrame:
    """Clusters without a model, the same in both engines."""
    return segment_table(s, d).withColumn(
        clustering.CLUSTER, F.expr("CAST(CAST(person_id AS INT) % 4 AS INT)"))


FIXED = "(SELECT *, CAST(CAST(person_id AS INT) % 4 AS INTEGER) AS cluster_id FROM seg)"

add("k03_k_sweep", sweep)


def _sweep_checks(s, d):
    """More clusters never cost more, and the silhouettes are such."""
    before = Window.orderBy("k")  # a row per number of clusters
    rows = sweep(s, d).withColumn("_less", F.lag("training_cost").over(before))
    return rows.agg(
        F.bool_and(F.coalesce(F.col("training_cost") <= F.col("_less") * 1.001, F.lit(True)))
        .alias("cost_never_rises"),
        F.bool_and(F.col("silhouette").between(-1, 1)).alias("silhouettes_in_range"),
        (F.min("k") == 2).alias("starts_at_two"))


add("k03_sweep_checks", _sweep_checks,
    "SELECT true AS cost_never_rises, true AS silhouettes_in_range, true AS starts_at_two")
add("k04_clusters", lambda s, d: clusters(s, d).select(USER, clustering.CLUSTER))


def _nearest_centre(s, d):
    """Whether each user's cluster is that of the nearest centre, by plain distances."""
    centres = [[float(x) for x in c] for c in fitted(s, d).clusterCenters()]
    point = vector_to_array("scaled")
    far = F.array(*[F.aggregate(
        F.zip_with(point, F.array(*map(F.lit, c)), lambda a, b: (a - b) * (a - b)),
        F.lit(0.0), lambda x, y: x + y) for c in centres])
    chosen = clusters(s, d).select(USER, clustering.CLUSTER)
    return vectors(s, d).join(chosen, USER).select(
        USER, (far[F.col(clustering.CLUSTER)] <= F.array_min(far) + 1e-9).alias("nearest"))


add("k04_nearest_centre", _nearest_centre, "SELECT person_id, true AS nearest FROM seg")
add("k05_cluster_distribution",
    lambda s, d: clustering.cluster_distribution(fixed_clusters(s, d)), f"""
SELECT cluster_id, COUNT(*) AS n,
  round(100.0 * COUNT(*) / (SELECT COUNT(*) FROM seg)::DOUBLE, 1) AS pct
FROM {FIXED} GROUP BY cluster_id""")
add("k05_model_distribution", lambda s, d: clustering.cluster_distribution(clusters(s, d)))
add("k06_pca_projection", lambda s, d: clustering.pca_projection(vectors(s, d))[0])


def _pca_checks(s, d):
    """Components are centred, uncorrelated, and in the order of their variance."""
    points, shares = clustering.pca_projection(vectors(s, d))
    scale = F.greatest(F.var_samp("pc1"), F.lit(1.0))
    return points.agg(
        ((F.abs(F.avg("pc1")) < 1e-6) & (F.abs(F.avg("pc2")) < 1e-6)).alias("centred"),
        (F.abs(F.covar_samp("pc1", "pc2")) < scale * 1e-6).alias("uncorrelated"),
        (F.var_samp("pc1") >= F.var_samp("pc2")).alias("in_order"),
        F.lit(1 >= shares[0] >= shares[1] >= 0).alias("shares_in_order"))


add("k06_pca_checks", _pca_checks, "SELECT true AS centred, true AS uncorrelated, "
    "true AS in_order, true AS shares_in_order")
add("k06_explained_variance", lambda s, d: s.createDataFrame(
    list(enumerate(clustering.pca_projection(vectors(s, d))[1], start=1)),
    "component INT, share DOUBLE"))
add("k07_cluster_profile",
    lambda s, d: clustering.cluster_profile(fixed_clusters(s, d), groups=range(4)),
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, " + ", ".join(
            f"round(AVG({c}) FILTER (WHERE cluster_id = {g}), 3) AS \"Cluster {g}\""
            for g in range(4)) + f" FROM {FIXED}" for c in CLUSTER_FEATURES))
add("k07_model_profile", lambda s, d: clustering.cluster_profile(clusters(s, d)))

add("k07_segment_profile",
    lambda s, d: clustering.cluster_profile(segment_table(s, d), SEGMENT, ORDER, ""),
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, " + ", ".join(
            f"round(AVG({c}) FILTER (WHERE funnel_segment = '{g}'), 3) AS \"{g}\"" for g in ORDER)
        + " FROM seg" for c in CLUSTER_FEATURES))

add("k08_cluster_by_segment",
    lambda s, d: clustering.cluster_by_segment(fixed_clusters(s, d)),
    "SELECT cluster_id, " + ", ".join(
        f"COUNT(*) FILTER (WHERE funnel_segment = '{g}') AS \"{g}\"" for g in ORDER)
    + f" FROM {FIXED} GROUP BY cluster_id")
add("k08_model_by_segment", lambda s, d: clustering.cluster_by_segment(clusters(s, d)))
