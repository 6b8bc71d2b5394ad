"""Connected components of an edge table by alternating stars.

Each round hangs every node on the smallest node among its neighbours, first for the larger
neighbours, then for the smaller ones; the number of rounds grows with the logarithm of the
longest chain. Edges stay distributed and are cut from their lineage by ``checkpoint()``, in as
many partitions as their number asks for. A node with many neighbours is an aggregate with partial
sums and a join that Spark may split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import few
from stockloom.plans.scan import saved


def components(edges: DataFrame, n: int | None = None) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge (a, b).

    Loops and repeated edges count once; edges with a null end are ignored. No edges give
    no rows. ``n``: about how many edges there are, if known; it only decides on partitions.
    """
    now = (
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("a IS NOT NULL AND b IS NOT NULL AND u <> v")
        .distinct()
    )
    now = saved(now if n is None else few(now, n))
    mark = _mark(now)
    while mark[0]:
        # A round makes at most an edge and a node's own one of each edge.
        now = few(now, mark[0])
        now = saved(few(_small(few(_large(now), mark[0])), 2 * mark[0]))
        before, mark = mark, _mark(now)
        if before == mark:
            break
    # Every node now hangs directly on the smallest of its component.
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _two(u1: str, v1: str, u2: str, v2: str) -> Column:
    """Two edges made of a row's columns."""
    return F.inline(F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in ((u1, v1), (u2, v2))]))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(_two("u", "v", "v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.filter("v > u").join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    )


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").select(_two("v", "m", "u", "m")).filter("u <> v").distinct()
