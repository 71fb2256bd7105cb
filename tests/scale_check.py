"""Time the core operators on a large made-up log in which one user owns a third of all events.

Not a test: run it by hand as ``python tests/scale_check.py [events]``.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from stridelog.operators import features, labels, metrics, profile, transitions  # noqa: E402
from stridelog.session import configure  # noqa: E402

NAMES = ("$ai_generation run_block agent_new_chat $exception credits_used sign_in x1 x2 x3 "
         "new_user_created").split()


def make_log(spark, n):
    """Users by hash, except for every third event; sessions repeat over some 20 events."""
    names = ", ".join(f"'{e}'" for e in NAMES)
    upgrade = f"pmod(xxhash64(id, 3), 100000) < 5 AND id > {2 * n // 3}"
    return spark.range(0, n, 1, 16).selectExpr(
        f"IF(id % 3 = 0, 'hot', CAST(pmod(xxhash64(id), {max(n // 300, 10)}) AS STRING)) AS person_id",
        f"CAST(timestamp_micros(1700000000000000 + id * {3 * 10**12 // n}) AS TIMESTAMP_NTZ)"
        " AS timestamp",
        f"IF({upgrade}, 'subscription_upgraded', element_at(array({names}),"
        " CAST(pmod(xxhash64(id, 1), 10) + 1 AS INT))) AS event",
        f"CONCAT('s', id div {max(n // 500, 1)}, '-', pmod(xxhash64(id, 2), 3)) AS canvas_id",
    )


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 12_000_000
    spark = configure(
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "32")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "20g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    make_log(spark, n).write.parquet(f"{folder}/events")
    events = spark.read.parquet(f"{folder}/events")
    labels.build_labels(events).write.parquet(f"{folder}/labels")
    known = spark.read.parquet(f"{folder}/labels")
    scores = spark.range(n // 2).selectExpr(
        "CAST(pmod(xxhash64(id), 10) = 0 AS INT) AS y",
        "IF(id % 3 = 0, 0.25D, pmod(xxhash64(id, 9), 1000000007) / 1000000007.0D * 1e-6) AS p",
    )
    jobs = {
        "labels": lambda: labels.build_labels(events),
        "clean events": lambda: labels.clean_events(events, known),
        "feature store": lambda: features.build_feature_store(events, known),
        "unlabelled features": lambda: features.unlabelled_features(events),
        "transitions": lambda: transitions.transition_counts(events),
        "upgrade timing": lambda: profile.upgrade_timing(events),
        "profile": lambda: profile.full_profile(events),
        "auc": lambda: metrics.rank_metrics(scores),
    }
    for threshold in ("10485760", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name, build in jobs.items():
            start = time.time()
            build().write.format("noop").mode("overwrite").save()
            print(f"{n} events, broadcast up to {threshold}: {name} {time.time() - start:.1f} s",
                  flush=True)


if __name__ == "__main__":
    main()
