"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelog.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the least node of its component, for every node of ``links``.

    ``links`` has the two ends in ``a`` and ``b``; repeated links and loops do no harm. Each
    round a node takes the least label around it and then the label of its label, so labels
    travel along paths of doubling length. Each round is written, so none is computed again.
    """
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("next"))
    edges = written(ends.union(ends.select("next", "node")).distinct(), "edges")
    labels = written(edges.groupBy("node").agg(
        F.least("node", F.min("next")).alias("label")), "labels")
    while True:
        around = edges.join(
            labels.select(F.col("node").alias("next"), "label"), "next").groupBy("node").agg(
            F.min("label").alias("least"))
        hooked = labels.join(around, "node").select(
            "node", F.col("label").alias("before"), F.least("label", "least").alias("label"))
        tops = hooked.select(F.col("node").alias("label"), F.col("label").alias("top"))
        moved = written(hooked.join(tops, "label").select(
            "node", "before", F.col("top").alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.where("label <> before").isEmpty():
            return labels
