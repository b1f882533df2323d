"""Connected components of a graph that is given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.shared import drop_written, written


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for each node of ``links`` (a, b); written.

    Each round every node, and the node it points at, takes the smallest label that its neighbours'
    labels point at, and labels are followed one step further, so that paths shorten fast. Labels are
    combined before the shuffle, so a node with many links is no hot group. Rounds are written to the
    shared folder. Links with a null end are left out.
    """
    both = links.select("a", "b").where("a is not null and b is not null")
    both = written(both.union(both.select("b", "a")).distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")))
    while True:
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("above"))
        labelled = labels.join(up, "component")  # a label is a node, and every node has a label
        heard = both.join(labelled.select(F.col("node").alias("b"), "above"), "b").groupBy("a").agg(F.min("above").alias("least"))
        heard = heard.join(labels.select(F.col("node").alias("a"), "component"), "a")
        offers = heard.select(F.col("a").alias("node"), "least").union(heard.select("component", "least"))
        offers = offers.union(labelled.select("node", "above"))
        best = offers.groupBy("node").agg(F.min("least").alias("best"))
        new = written(
            labels.join(best, "node").select(
                "node", F.least("component", "best").alias("component"), (F.col("best") < F.col("component")).alias("changed")
            )
        )
        changed = new.where("changed").limit(1).count()
        drop_written(labels)
        labels = new.select("node", "component")
        if not changed:
            drop_written(both)
            return labels
