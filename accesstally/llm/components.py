"""Connected components of an undirected graph of links, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from accesstally.sources.scratch import discard, scratch_path, written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is named by its smallest node.

    Each round gives a node the smallest component among its own, its neighbours' and theirs, then lets
    every component follow the one its name belongs to by now, so long chains halve. Rounds are written to
    the shared folder; they end when none changes a node.
    """
    spark = links.sparkSession
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both_path = scratch_path(spark, "links")
    both = written(both, both_path)
    path = scratch_path(spark, "components")
    labels = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("component")).withColumnRenamed("a", "node"), path)
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("near"))
        lowest = labels.join(near, labels.node == near.a).select("node", "component", F.least("component", "near").alias("lowest"))
        names = lowest.select(F.col("node").alias("name"), F.col("lowest").alias("further"))
        moved = lowest.join(names, F.col("lowest") == F.col("name"), "left").select(
            "node", F.coalesce("further", "lowest").alias("component"), (F.coalesce("further", "lowest") != F.col("component")).alias("changed")
        )
        next_path = scratch_path(spark, "components")
        moved = written(moved, next_path)
        done = not moved.filter("changed").take(1)
        labels = moved.select("node", "component")
        discard(spark, path)
        path = next_path
        if done:
            discard(spark, both_path)
            return labels
