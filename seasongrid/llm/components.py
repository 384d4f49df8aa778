"""Connected components of a graph given as pairs, by alternating stars.

Each round is two joins on node ids: every node passes its smallest neighbour
to the larger ones, then to the smaller ones.  Minima combine before the
shuffle and the joins split skewed keys, so a node with very many neighbours
is not gathered anywhere.  The pairs of each round are a written table; only
two numbers of it reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasongrid.llm.common import stored


def _minima(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _minima(both).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` lead from the larger to the smaller node."""
    least = _minima(edges)
    moved = edges.join(least, "u").where(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, component_id)`` for every node in ``pairs`` that is not its component's smallest.

    ``component_id`` is the smallest node that can be reached.  Pairs may repeat
    and come in either direction; pairs of a node with itself say nothing.
    An empty table gives an empty one.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    edges = pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    edges = stored(edges, "links")
    before = None
    while True:
        now = edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if now[0] == 0 or tuple(now) == before:
            break
        before = tuple(now)
        edges = stored(_small_star(_large_star(edges).distinct()).distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component_id"))
