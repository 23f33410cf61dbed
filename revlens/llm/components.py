"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        both.join(least, "u")
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges lead straight from every node to its label: then
    another round would change nothing."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    down = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return down.where((F.col("down") > 0) & (F.col("down") + F.col("up") > 1)).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (u, v); the label is the least
    node of its component.

    Each round is written to the shared folder, so a lost executor costs no
    earlier round. Only whether a round settled all comes to the driver.
    Both stars aggregate before they shuffle; a node with very many edges is
    a join key whose partition Spark can split.
    """
    ordered = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stored(ordered.where(F.col("u") != F.col("v")).distinct(), "edges")
    while not _settled(now):
        last, now = now, stored(_small_star(_large_star(now)), "stars")
        discard(last)
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return leaves.unionByName(roots)
