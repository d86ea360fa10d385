"""Connected components of a large graph given as an edge table.

Contraction with random priorities: every node points at the neighbour (or
itself) whose hash of this round is smallest, edges are rewritten to the ends
pointed at, and loops and repeats go.  A constant share of the nodes leaves in
each round whatever the shape of the graph (chains included), so the rounds
grow with the logarithm of its size.  Minima are aggregated before any shuffle
of a hub's edges, and every round is a written table, so a lost executor
repeats one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives loss."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has long columns a and b.  Returns one row per node that has
    an edge to another node: node and component (the smallest node reachable).
    Nulls and loops are ignored; an empty table gives no rows."""
    edges = written(edges.select("a", "b").where("a <> b"), "edges")
    parents: list[DataFrame] = []
    while not edges.isEmpty():
        r = len(parents)
        both = edges.union(edges.select("b", "a"))
        order = F.xxhash64(F.lit(r), "b")
        best = both.groupBy("a").agg(F.min(F.struct(order.alias("h"), F.col("b").alias("to"))).alias("m"))
        own = F.struct(F.xxhash64(F.lit(r), "a").alias("h"), F.col("a").alias("to"))
        step = written(best.select(F.col("a").alias("node"), F.least("m", own)["to"].alias("parent")), "parents")
        parents.append(step)
        ends = [step.select(F.col("node").alias(c), F.col("parent").alias(f"{c}2")) for c in "ab"]
        moved = edges.join(ends[0], "a").join(ends[1], "b").where("a2 <> b2")
        edges = written(moved.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "edges")
    if not parents:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    root = parents[-1].withColumnRenamed("parent", "root")
    for k, step in enumerate(reversed(parents[:-1]), 1):
        above = root.select(F.col("node").alias("parent"), F.col("root"))
        root = step.join(above, "parent", "left").select("node", F.coalesce("root", "parent").alias("root"))
        if k % 4 == 0:  # no plan chains all rounds
            root = written(root, "roots")
    root = written(root, "roots")
    least = root.groupBy("root").agg(F.least(F.min("node"), F.col("root")).alias("component"))
    return root.join(least, "root").select("node", "component")
