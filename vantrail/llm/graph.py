"""Connected components of a graph that lies in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vantrail.session import spool


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable from each node of ``edges`` (a, b), both long.

    Labels are parents in a forest. In every round a node hears its neighbours' grandparents, and takes
    the smallest for itself and for its parent, so trees are hung together and flattened at once and a
    path of n nodes needs about log n rounds. Labels are written to the shared folder
    after each round; one row per node, and minima are taken map-side, so a node with very many edges
    sends one row per task.
    """
    several = edges.where("a <> b")
    both = spool(several.select("a", "b").unionByName(several.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = spool(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        parents = labels.select(F.col("node").alias("label"), F.col("label").alias("grand"))
        known = labels.join(parents, "label")
        near = both.join(known.select(F.col("node").alias("b"), "grand"), "b").groupBy(F.col("a").alias("node")).agg(F.min("grand").alias("near"))
        heard = known.join(near, "node")
        hooked = heard.groupBy(F.col("label").alias("node")).agg(F.min("near").alias("hook"))
        least = F.least("label", "grand", "near", F.coalesce("hook", "label"))
        after = spool(heard.join(hooked, "node", "left").select("node", least.alias("label"), F.col("label").alias("was")), "labels")
        labels = after.select("node", "label")
        if after.where("label <> was").isEmpty():
            return labels
