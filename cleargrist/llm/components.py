"""Connected components of a graph that lies in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleargrist.llm.tables import stored


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, component): the smallest node that each node of an edge (u, v) is connected with.

    Large-star and small-star rounds (Kiveris et al., 2014): every round hangs a node's
    neighbours on the smallest one, which halves long chains and never makes a star larger than
    its component; it ends when all that is left are stars around their smallest nodes. A round
    is two joins of the edges with one row per node; a node with very many neighbours is reduced
    by partial aggregation, and adaptive execution splits its join. Each round is written to the
    shared folder; nothing but a count reaches the driver.
    """
    pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stored(pairs.filter("u > v").distinct(), f"{label}-edges")
    while not _are_stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u and v > m")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
        now = stored(small, f"{label}-edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger end of an edge has one edge and is no smaller end of another."""
    one, none = F.lit(1).alias("up"), F.lit(0).alias("up")
    ends = edges.select(F.col("u").alias("node"), one, F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), none, F.lit(1).alias("down"))
    )
    ups, downs = F.sum("up"), F.max("down")
    nodes = ends.groupBy("node").agg(ups.alias("ups"), downs.alias("downs"))
    return nodes.filter("ups > 1 or (ups = 1 and downs = 1)").isEmpty()
