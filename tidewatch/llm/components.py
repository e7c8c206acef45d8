"""Connected components of a table of links, as Spark jobs; links and labels never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import discard, materialise


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is named by its smallest node.

    Each round a node takes the smallest label among itself and its neighbours, then its label's label, so long chains
    halve. Rounds are written tables; the loop ends with the first round that changes nothing.
    """
    both = materialise(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links")
    labels = written = materialise(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "labels")
    while True:
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("__up"))
        jumped = labels.join(jump, "component").select("node", F.col("__up").alias("component"), F.col("component").alias("__old"))
        near = both.join(jumped.select(F.col("node").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("__near"))
        step = jumped.join(near, jumped["node"] == near["a"]).select("node", F.least("component", "__near").alias("component"), (F.least("component", "__near") < F.col("__old")).alias("__moved"))
        before, written = written, materialise(step, "labels")
        discard(links.sparkSession, before)
        labels = written.drop("__moved")
        if not written.where("__moved").head(1):
            discard(links.sparkSession, both)
            return labels
