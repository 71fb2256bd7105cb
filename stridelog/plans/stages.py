"""From an event log to labels, features, segments, model and report.

Every stage reads what the stage before it wrote, so a run can be taken up again at any
stage, and an executor lost in one costs nothing of those before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stridelog.config import SPLIT
from stridelog.operators import (
    clustering, features, labels, leakage, metrics, propensity, report, segments, transitions,
)
from stridelog.session import configure
from stridelog.sources import sinks, validation
from stridelog.sources.events import (
    load_feature_store, load_labels, load_raw_events, load_splits, read_table,
)


@dataclass(frozen=True)
class Run:
    """Where a run reads its events and keeps its tables."""

    spark: SparkSession
    events_path: str
    folder: str

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def events(self) -> DataFrame:
        return load_raw_events(configure(self.spark), self.events_path, drop_banned=False)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name), name)


def make_labels(run: Run) -> DataFrame:
    events = validation.validate_raw_events(run.events())
    return validation.validate_labels(
        sinks.write_parquet(labels.build_labels(events), run.path("labels"))
    )


def make_splits(run: Run) -> DataFrame:
    known = load_labels(run.spark, run.path("labels"))
    return sinks.write_parquet(labels.assign_splits(known), run.path("splits"))


def make_feature_store(run: Run) -> DataFrame:
    store = features.build_feature_store(
        run.events(), load_labels(run.spark, run.path("labels"))
    )
    return validation.validate_feature_store(
        sinks.write_parquet(store, run.path("feature_store"))
    )


def make_audit(run: Run) -> DataFrame:
    store = load_feature_store(run.spark, run.path("feature_store"))
    return sinks.write_parquet(leakage.audit_features(store), run.path("audit"))


def make_segments(run: Run) -> DataFrame:
    store = load_feature_store(run.spark, run.path("feature_store"))
    return sinks.write_parquet(segments.assign_segments(store), run.path("segments"))


def make_transitions(run: Run) -> DataFrame:
    probabilities = transitions.transition_probabilities(run.events())
    return sinks.write_parquet(probabilities, run.path("transitions"))


def make_clusters(run: Run, starts: int = 20) -> DataFrame:
    segmented = run.table("segments")
    clusters, model = clustering.run_clustering(segmented, starts=starts)
    model.save(run.path("kmeans"))
    inputs = clustering.cluster_input(segmented)
    sinks.write_parquet(
        clustering.scaling_parameters(inputs, clustering.cluster_columns(segmented)),
        run.path("cluster_scaling"))
    return sinks.write_parquet(clusters, run.path("clusters"))


def make_model(run: Run, trees: int = propensity.TREES) -> propensity.PropensityModel:
    """Cross-validate, refit, score the test split, and keep model, scores and metadata."""
    table = propensity.training_table(
        load_feature_store(run.spark, run.path("feature_store")),
        load_splits(run.spark, run.path("splits")),
    )
    table = sinks.write_parquet(table, run.path("training"))
    known = table.where(table[SPLIT].isin("train", "validation"))
    oof, iterations = propensity.cross_validate(known, trees=trees)
    model = propensity.refit(table, propensity.median_iteration(iterations))
    test = propensity.score_split(model, table)

    model.save(run.path("model"))
    sinks.write_csv(oof, run.path("oof_predictions"))
    sinks.write_csv(
        metrics.fold_scores(propensity.as_scored(oof), iterations.drop("losses")),
        run.path("fold_scores"),
    )
    sinks.write_json(
        propensity.model_metadata(table, oof, iterations, test), run.path("model_metadata")
    )
    return model


def make_predictions(run: Run) -> DataFrame:
    model = propensity.PropensityModel.load(run.spark, run.path("model"))
    store = load_feature_store(run.spark, run.path("feature_store"))
    return sinks.write_parquet(propensity.predict_batch(model, store), run.path("predictions"))


def make_report(run: Run) -> DataFrame:
    result = report.generate_full_report(run.table("segments"), run.table("predictions"))
    sinks.write_json(result, run.path("funnel_report"))
    return result


def run_all(run: Run, trees: int = propensity.TREES, starts: int = 20) -> DataFrame:
    """All stages in order; returns the funnel report."""
    make_labels(run)
    make_splits(run)
    make_feature_store(run)
    make_audit(run)
    make_segments(run)
    make_transitions(run)
    make_clusters(run, starts)
    make_model(run, trees)
    make_predictions(run)
    return make_report(run)
