"""Components of a growing graph: stored labels, and contraction of the new edges only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admere.operators.identity import _labelled, connected_components, record_links
from admere.session import release, stable
from admere.sources.versioned import VersionedTable

#: Nodes of a load that are broadcast at most to find their labels.
BROADCAST_ROWS = 1_000_000


class Labels:
    """Component of every node seen so far, below ``path``.

    ``nodes`` holds each node with the component it had when it came; rows are only added. ``merged`` holds
    the components that are part of another one by now, with that one's name. A load reads
    the labels of its own nodes and writes its new nodes and the merged components, never
    the labels of other nodes. The name of a component is its smallest node's.

    A load that stops between the two tables is repaired by running it again: its nodes are known then, and
    its edges are contracted as before.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.nodes = VersionedTable(spark, f"{path.rstrip('/')}/nodes", "load")
        self.merged = VersionedTable(spark, f"{path.rstrip('/')}/merged", "part")

    def read(self) -> DataFrame:
        """``node`` and ``component`` as of the last load."""
        nodes, merged = self.nodes.read(), self.merged.read()
        if nodes is None:
            return self.spark.createDataFrame([], "node string, component string")
        if merged is None:
            return nodes.select("node", "component")
        now = merged.select(F.col("component"), F.col("name").alias("__name"))
        return nodes.join(now, "component", "left").select("node", F.coalesce("__name", "component").alias("component"))

    def add(self, edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
        """Take in new edges; returns the components that were renamed, ``old`` and ``new``, for the facts that carry them."""
        links = stable(edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct())
        ends = stable(links.select(F.col("src").alias("node")).union(links.select("dst")).distinct())
        few = F.broadcast(ends) if ends.count() <= BROADCAST_ROWS else ends
        known = stable(self.read().join(few, "node", "left_semi"))
        label = ends.join(known, "node", "left").select("node", F.coalesce("component", "node").alias("was"), F.col("component").isNull().alias("fresh"))
        label = stable(label)
        contracted = links.join(label.select(F.col("node").alias("src"), F.col("was").alias("a")), "src").join(
            label.select(F.col("node").alias("dst"), F.col("was").alias("b")), "dst"
        )
        parts = stable(connected_components(contracted.select("a", "b").distinct(), "a", "b").select(F.col("node").alias("was"), F.col("component").alias("name")))
        changes = stable(parts.filter("was <> name").join(known.select(F.col("component").alias("was")).distinct(), "was", "left_semi").select(F.col("was").alias("old"), F.col("name").alias("new")))
        number = (max(self.nodes.versions(), default=0)) + 1
        added = label.filter("fresh").join(parts, "was").select("node", F.col("name").alias("component"), F.lit(number).alias("load"))
        self._merge(changes)
        self.nodes.append(added)
        for table in (links, ends, known, label, parts):
            release(table)
        return changes

    def _merge(self, changes: DataFrame) -> None:
        """Follow earlier merges to the new names, and add the components merged now."""
        fresh = changes.select(F.col("old").alias("component"), F.col("new").alias("name"))
        before = self.merged.read()
        if before is not None:
            moved = changes.select(F.col("old").alias("name"), F.col("new").alias("__new"))
            followed = before.join(moved, "name", "left").select("component", F.coalesce("__new", "name").alias("name"))
            fresh = followed.union(fresh).groupBy("component").agg(F.min("name").alias("name"))
        self.merged.replace(fresh.withColumn("part", F.lit(0)))


def people_so_far(labels: Labels, customers: DataFrame, key: str = "customer_id") -> DataFrame:
    """Component of each customer record, from stored labels."""
    found = labels.read().filter(F.col("node").startswith("c|"))
    return _labelled(customers, found, key)


def add_customers(labels: Labels, customers: DataFrame, key: str = "customer_id") -> DataFrame:
    """Take in a delivery of customer records; returns the renamed components."""
    return labels.add(record_links(customers, key))
