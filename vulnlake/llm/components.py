"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnlake.llm.tables import cut_lineage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )


def _round(edges: DataFrame) -> DataFrame:
    """One large star and one small star. Minima are partial aggregates and the joins are plain equi-joins,
    so a node with very many links is split like any skewed key."""
    ways = _both_ways(edges)
    least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = ways.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum((F.col("b") % 1000003).cast("double"))).first()
    return tuple(row)


def stars(links: DataFrame, name: str) -> DataFrame:
    """(a, b): every linked node but the smallest of its component, with that smallest node.

    `links` has the columns a and b in any direction; null ends and links to oneself do not count. Each
    round is written to the shared folder and read back, so a lost executor costs at most one round.
    Rounds grow with the logarithm of the longest chain.
    """
    edges = links.select("a", "b").where("a <> b").distinct()
    edges = cut_lineage(edges, f"{name}-links")
    before = _signature(edges)
    while before[0]:
        edges = cut_lineage(_round(edges), f"{name}-round")
        after = _signature(edges)
        if after == before:
            break
        before = after
    return edges
