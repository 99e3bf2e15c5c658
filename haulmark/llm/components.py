"""Connected components of links that need not fit one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import small
from haulmark.session import written

#: Labels of so many nodes are broadcast to the links in each round.
BROADCAST_ROWS = 200_000


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): ``label`` is the smallest node that it reaches.

    Each round a node takes the smallest label around it and then the label of
    that label, so rounds grow with the logarithm of a chain. Every round is
    written to the shared folder and the next reads it.
    """
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")).withColumn("moved", F.lit(True)))
    while labels.where("moved").limit(1).count():
        held = small(labels, BROADCAST_ROWS)
        around = both.join(held, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "label")
        own = labels.select("node", "label", F.col("label").alias("old"))
        least = own.unionByName(around, allowMissingColumns=True).groupBy("node").agg(F.min("label").alias("next"), F.max("old").alias("old"))
        target = held.select(F.col("node").alias("next"), F.col("label").alias("jump"))
        labels = written(
            least.join(target, "next", "left").select(
                "node", F.least("next", F.coalesce("jump", "next")).alias("label"), (F.least("next", F.coalesce("jump", "next")) < F.col("old")).alias("moved")
            )
        )
    return labels.select("node", "label")
