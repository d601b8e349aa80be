"""Connected components of an edge table by hooking to smaller labels and pointer jumping, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), ``root`` being the smallest node of its component.

    Each round takes the smallest root among a node's neighbours, hooks the node's own root to it, and jumps
    pointers, so a path of n nodes takes some log(n) rounds. Every round's table is written to the shared folder.
    Self-edges and repeated edges do no harm; rows with nulls are left out; no edges give no rows.
    """
    pairs = edges.filter("a <> b").select("a", "b")
    both = stored(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    roots = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "roots")
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), F.col("root").alias("near")), "b")
        least = near.groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        hooked = roots.join(least, "node").select("node", "root", F.least("root", "near").alias("low"))
        # A root follows the smallest root that any of its nodes has seen.
        follow = hooked.groupBy(F.col("root").alias("old")).agg(F.min("low").alias("to"))
        moved = hooked.join(follow, hooked["root"] == follow["old"]).select("node", "root", F.least("low", "to").alias("low"))
        jump = moved.select(F.col("node").alias("at"), F.col("low").alias("further"))
        jumped = moved.join(jump, moved["low"] == jump["at"]).select("node", F.col("root").alias("was"), F.least("low", "further").alias("root"))
        after = stored(jumped, "roots")
        if after.filter("was <> root").isEmpty():
            return after.select("node", "root")
        roots = after.select("node", "root")
