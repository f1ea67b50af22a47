"""Connected components of an edge table, by alternating stars.

Each round hangs every node's larger neighbours on its smallest one, then every
node's smaller neighbours on the smallest of them; edges end as stars around the
smallest node after a number of rounds that grows with the logarithm of the
longest path. A node with very many edges is reduced to a minimum per task
before the shuffle. Each round is a written table. Tables of ``FEW`` edges or
less stay in one partition: a round of them costs its edges, not a task for
each of the session's shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Scratch

#: Edges that one partition holds; rounds never add to them.
FEW = 1 << 16


def _packed(edges: DataFrame, few: bool) -> DataFrame:
    """A few edges in one partition, where grouping and joining them needs no shuffle."""
    return edges.coalesce(1) if few else edges


def _lowest(edges: DataFrame) -> DataFrame:
    """edges (u, v) with the smallest v of each u as ``low``, u itself included."""
    low = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return edges.join(low, "u")


def _are_stars(edges: DataFrame, few: bool) -> bool:
    """Every u hangs on one v, and no v hangs on another node."""
    ends = (edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .unionAll(edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    return _packed(ends, few).groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``links`` (node, other); component is its smallest node."""
    edges = links.where("node <> other").select(F.greatest("node", "other").alias("u"), F.least("node", "other").alias("v"))
    old, few = None, edges.count() <= FEW
    while True:
        both = _packed(edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), few)
        large = _lowest(both).where("v > u and v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = _lowest(large)
        small = _packed(small.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
                        .unionAll(small.select("u", F.col("low").alias("v"))), few).distinct()
        edges = scratch.save(small)
        if old is not None:
            scratch.drop(old)
        if _are_stars(edges, few):
            break
        old = edges
    edges = _packed(edges, few)
    lows = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(lows)
