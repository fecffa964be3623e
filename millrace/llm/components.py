"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.staging import Scratch


def _are_stars(edges: DataFrame) -> bool:
    """Whether every u has one v, which is no u itself: then each v names a component."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    ends = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return ends.agg(F.coalesce(F.max(F.col("out") + F.least("out", "into")), F.lit(0))).first()[0] <= 1


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every node of ``links`` (columns x and y, long); component is the least node.

    A node of many links is the key of many rows, never a list: their minimum is aggregated before it is shuffled, and the
    join back to the links can be split.
    """
    edges = links.filter("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct()
    edges = scratch.write(edges, "edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges, last = scratch.write(small, "edges"), edges
        scratch.release(last)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
