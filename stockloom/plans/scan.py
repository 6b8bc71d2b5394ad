"""Running totals over ordered rows that never put a whole key into one task.

Rows are cut into ranges ("blocks") of (key, order) of equal size, so a key with a third
of all rows spans many blocks. Totals run inside a block; what earlier blocks of the same
key add up to is carried in by a table with fewer rows than there are blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.plans.lookup import shuffle_partitions
from stockloom.plans.scratch import Scratch
from stockloom.session import ensure_checkpoints

BLOCK = "_block"
BLOCK_ROWS = 2_000_000


def saved(df: DataFrame) -> DataFrame:
    """The rows of a frame, kept in the shared checkpoint folder."""
    ensure_checkpoints(df.sparkSession)
    return df.checkpoint()


def with_blocks(df: DataFrame, order: list[str], blocks: int | None = None) -> DataFrame:
    """Add the number of the range each row falls into, ranges sorted by ``order``.

    The range bounds come from a sample, so the rows are written first, or their plan would run
    twice; the numbered rows are checkpointed, as a second evaluation could choose other
    bounds. There are as many blocks as shuffle partitions, and more where a block would
    exceed BLOCK_ROWS rows.
    """
    rows = Scratch(df.sparkSession, "unordered")
    kept = rows.keep(df)
    n = blocks or max(shuffle_partitions(df.sparkSession), kept.count() // BLOCK_ROWS + 1)
    numbered = saved(kept.repartitionByRange(n, *order).withColumn(BLOCK, F.spark_partition_id()))
    rows.remove()
    return numbered


def running(
    df: DataFrame,
    key: list[str],
    order: list[str],
    sums: dict[str, Column] | None = None,
    latest: dict[str, Column] | None = None,
) -> DataFrame:
    """Add running values per key to a frame made by ``with_blocks``.

    ``sums``: total over the rows before this one, 0 at the start.
    ``latest``: greatest value over the rows up to and including this one.
    """
    sums, latest = sums or {}, latest or {}
    inside = Window.partitionBy(*key, BLOCK).orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.select(
        "*",
        *[F.coalesce(F.sum(e).over(before), F.lit(0)).alias(f"_in_{n}") for n, e in sums.items()],
        *[F.max(e).over(upto).alias(f"_in_{n}") for n, e in latest.items()],
    )

    totals = df.groupBy(*key, BLOCK).agg(
        *[F.sum(e).alias(f"_all_{n}") for n, e in sums.items()],
        *[F.max(e).alias(f"_all_{n}") for n, e in latest.items()],
    )
    # A key has at most one row per block here, so this window is bounded by the blocks.
    earlier = (
        Window.partitionBy(*key).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = totals.select(
        *key,
        BLOCK,
        F.count(F.lit(1)).over(earlier).alias("_blocks_before"),
        *[F.sum(f"_all_{n}").over(earlier).alias(f"_from_{n}") for n in sums],
        *[F.max(f"_all_{n}").over(earlier).alias(f"_from_{n}") for n in latest],
    ).filter("_blocks_before > 0")

    # Ranges are contiguous, so only the first key of a block can continue from an earlier
    # one: the carry table has fewer rows than there are blocks, whatever the data.
    joined = local.join(F.broadcast(carry), [*key, BLOCK], "left")
    return joined.select(
        *df.columns,
        *[
            (F.col(f"_in_{n}") + F.coalesce(F.col(f"_from_{n}"), F.lit(0))).alias(n)
            for n in sums
        ],
        *[F.greatest(f"_in_{n}", f"_from_{n}").alias(n) for n in latest],
    )
