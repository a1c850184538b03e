"""Distributed connected components by alternating large and small stars.

Each half round hangs every node below the smallest neighbour it knows. Minima
are partial aggregates written out before they are joined back, so both sides
of the join are plain exchanges that adaptive execution can split at a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspine.llm.common import store


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = store(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    linked = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return store(linked.distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    low = store(edges.groupBy("u").agg(F.min("v").alias("m")))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return store(moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node with an edge to another node.

    ``component`` is the smallest node that can be reached. Null ends and loops
    are ignored; no edges give no rows.
    """
    now = store(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    before, seen = None, _signature(now)
    while seen[0] and seen != before:
        now = _small_star(_large_star(now))
        before, seen = seen, _signature(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
