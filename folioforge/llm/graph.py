"""Connected components of an edge table, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(u, v) long, undirected -> (node, component): the smallest node reachable, for every node of an edge.

    Each round takes the smallest label among neighbours and then jumps to the label's own label, so a chain
    of n nodes settles in O(log n) rounds. Labels and edges are written tables: lineage stays one round long,
    and both sides of each join are plain scans, so Spark can split the task of a node with very many edges.
    Loops and repeated edges change nothing. No edges: an empty table. Rows with a null end are left out.
    """
    e = edges.filter("u is not null and v is not null and u <> v").select(F.col("u").cast("long"), F.col("v").cast("long"))
    both = scratch.write(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = scratch.write(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("component")).withColumnRenamed("u", "node"), "labels")
    for _ in range(max_rounds):
        seen = both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("component").alias("near"))
        better = scratch.write(labels.join(seen, labels.node == seen.u).select("node", F.col("component").alias("old"), F.least("component", "near").alias("component")), "near")
        up = better.select(F.col("node").alias("at"), F.col("component").alias("jump"))
        new = scratch.write(better.join(up, better.component == up["at"], "left").select("node", "old", F.least(F.coalesce("jump", "component"), "component").alias("component")), "labels")
        changed = new.filter("component <> old").limit(1).count()
        scratch.drop(labels, better)
        labels = new
        if not changed:
            scratch.drop(both)
            return labels.select("node", "component")
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
