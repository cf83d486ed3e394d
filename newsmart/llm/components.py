"""Connected components of a table of links by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.llm.tables import stage


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them (links point from large to small)."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of ``links`` (columns a, b); the component is its smallest node.

    Rows with a NULL end or equal ends say nothing and give no row; repeated links are one link. Every round is
    written to the shared folder, and rounds end when the links no longer change: they then form stars. A component of
    diameter d needs O(log d) rounds in practice. A hot centre is a skewed join key, which the adaptive
    join splits; no neighbour list is ever gathered in one row.
    """
    ends = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current, seen = stage(ends.distinct(), "links"), None
    while True:
        mark = current.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")
        ).first()
        if mark == seen or mark["n"] == 0:
            break
        seen = mark
        current = stage(_small_star(_large_star(current).distinct()).distinct(), "links")
    found = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.union(found.select("component", "component").distinct())
