"""Connected components of an edge table by alternating stars.

Each round hangs every node on the smallest node among its neighbours, first for the larger
neighbours, then for the smaller ones; the number of rounds grows with the logarithm of the
longest chain. Edges stay distributed; every round writes them to the shared folder and removes
those of the round before. A node with many neighbours is an aggregate with partial sums and
a join that Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.plans.scratch import Scratch


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge (a, b).

    Loops and repeated edges count once; edges with a null end are ignored. No edges give
    no rows.
    """
    rounds = Scratch(edges.sparkSession, "components")
    now = rounds.keep(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("a IS NOT NULL AND b IS NOT NULL AND u <> v")
        .distinct()
    )
    mark = _mark(now)
    while True:
        now = rounds.keep(_small(_large(now)))
        before, mark = mark, _mark(now)
        rounds.remove_older()
        if before == mark:
            break
    # Every node now hangs directly on the smallest of its component.
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.filter("v > u").join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    )


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
