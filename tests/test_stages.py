from __future__ import annotations

import os

from pyspark.sql import functions as F

from stridelog.catalog.testdata import canonical_events
from stridelog.operators import clustering
from stridelog.plans import stages


def test_a_whole_run(spark, tmp_path):
    log = str(tmp_path / "events")
    canonical_events(spark, "/root/testdata/sf0.01").write.parquet(log)
    run = stages.Run(spark, log, str(tmp_path / "out"))
    result = stages.run_all(run, trees=2, starts=1)
    assert result.agg(F.sum("user_count")).first()[0] == 316
    assert result.agg(F.count("mean_upgrade_prob")).first()[0] == result.count()
    made = {"labels", "splits", "feature_store", "audit", "segments", "transitions", "clusters",
            "kmeans", "training", "model", "oof_predictions", "fold_scores", "model_metadata",
            "predictions", "funnel_report"}
    assert made <= set(os.listdir(tmp_path / "out"))
    assert run.table("audit").count() == 0
    meta = spark.read.json(run.path("model_metadata")).first()
    assert meta["n_train"] == 221 and meta["n_features"] == 22 and meta["test_auc"] is None
    tiers = run.table("predictions").where("upgrade_risk_tier IS NULL").count()
    assert tiers == 0

    # A saved model and its scaling place the same users in the same clusters.
    model = clustering.KMeansModel.load(run.path("kmeans"))
    scaling = spark.read.parquet(run.path("cluster_scaling"))
    placed = clustering.place_users(run.table("segments"), scaling, model)
    assert placed.exceptAll(run.table("clusters").select(*placed.columns)).count() == 0
