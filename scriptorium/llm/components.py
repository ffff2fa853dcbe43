"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.session import materialize


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (u, v)``; a component
    is named by its smallest node.

    Each round hangs the neighbours of a node below the smallest node it
    knows (larger ones, then smaller ones), so the number of rounds follows
    the logarithm of the longest chain. Rounds are cut by written tables;
    only a row count and a checksum come to the driver. Self loops, repeated
    edges and an empty table are fine.
    """
    edges = (
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u <> v").distinct()
    )
    edges = materialize(edges, "components")
    seen = _fingerprint(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_lowest(both).withColumn("m", F.least("u", "m")), "u")
            .where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).where("u <> v").distinct()
        low = _lowest(large)
        small = (
            large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct()
        )
        edges = materialize(small, "components")
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    return (
        edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")))
        .distinct()
    )
