"""Connected components of links between rows, by stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marquee.session import store_once


def _state(links: DataFrame) -> tuple[int, int]:
    """Count and checksum of the links: equal for equal sets."""
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 31))).first()
    return row[0], row[1] or 0


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest one (the node itself included)."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest one."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v) but the roots; the root is the smallest node reachable.

    Large and small stars by turns until nothing changes; the number of rounds grows with the
    logarithm of the number of nodes. Each round is written to the checkpoint folder, so a lost
    executor costs no more than that round. A link of a node to itself and repeated links change nothing.
    """
    links = links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = store_once(links, "links")
    before = _state(links)
    while before[0]:
        links = store_once(_small_star(_large_star(links)), "links")
        now = _state(links)
        if now == before:
            break
        before = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
