"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.llm import frames


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node's neighbours (the larger ones, or the smaller ones and itself) join its least one."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return moved.where("u != v")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node with an edge; a component is named by its least node.

    Large and small stars take turns until every component is one star, which takes about as many
    rounds as the logarithm of the longest chain. Each round is written to the shared folder, and
    only whether another one is needed reaches the driver. Edges from a node to itself and null
    ends are ignored.
    """
    now = frames.stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v")
        .where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct(), "edges")

    def unfinished(df: DataFrame) -> bool:
        """Whether a node has two edges to smaller ones, or one and is itself the smaller end of another."""
        ends = df.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            df.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        per_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return not per_node.where("up > 1 OR (up = 1 AND down = 1)").isEmpty()

    while unfinished(now):
        now = frames.stored(_star(_star(now, True), False).distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
