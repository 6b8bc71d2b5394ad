"""Match ordered supplies with ordered demands: first demand served from the first supply.

Both sides are laid end to end on one axis per key. Sorting the starts of both sides
together shows for every position the supply and the demand it falls into, so the work
grows with the number of supplies plus demands; pairs that do not meet are never formed.

Each side is dealt by key once, and the rows of a key are gone through in one task. A key with
more than HOT_ROWS rows is cut into blocks instead; a sketch names such keys, and which ones it
names affects speed only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom.plans.lookup import heavy_hashes
from stockloom.plans.scan import running, with_blocks
from stockloom.plans.scratch import Scratch

HOT_ROWS = 500_000  # supplies and demands of one key, beyond which they are cut into blocks


@dataclass(frozen=True)
class Laid:
    """Rows with a positive ``amount``, in their ``order`` on the axis of their ``key``."""

    rows: DataFrame
    key: list[str]
    order: list[str]
    amount: str

    def starts(self, rows: DataFrame, side: str, columns: list[str], blocks: bool) -> DataFrame:
        """(key, ``pos``, ``side``): where each of the rows starts, and its struct with start and end."""
        size = F.col(self.amount)
        if blocks:
            placed = running(with_blocks(rows, [*self.key, *self.order]), self.key, self.order,
                             sums={"start": size.cast("bigint")})
        else:
            before = Window.partitionBy(*self.key).orderBy(*self.order).rowsBetween(Window.unboundedPreceding, -1)
            placed = rows.repartition(*self.key).withColumn(
                "start", F.coalesce(F.sum(size.cast("bigint")).over(before), F.lit(0)))
        placed = placed.withColumn("end", F.col("start") + size)
        return placed.select(*self.key, F.col("start").alias("pos"), F.struct("start", "end", *columns).alias(side))


def laid_out(df: DataFrame, key: list[str], order: list[str], amount: str) -> Laid:
    """The rows of one side, to be laid on the axis of their key in ``order``."""
    return Laid(df.filter(F.col(amount) > 0), key, order, amount)


def allocate(
    supply: Laid,
    demand: Laid,
    key: list[str],
    supply_columns: list[str],
    demand_columns: list[str],
) -> DataFrame:
    """Rows (key, supply columns, demand columns, ``quantity``) of the overlaps.

    Both sides come from ``laid_out``. Demand beyond the supply gets no row.
    """
    # Counted, sketched and dealt: worked out once.
    scratch = Scratch(supply.rows.sparkSession, "allocate")
    sides = [
        (side, columns, name, scratch.keep(side.rows.select(*dict.fromkeys([*key, *side.order, side.amount, *columns]))))
        for side, columns, name in ((supply, supply_columns, "s"), (demand, demand_columns, "d"))
    ]

    def events(how: str | None, blocks: bool) -> DataFrame:
        frames = [
            side.starts(rows if how is None else rows.join(F.broadcast(hot), place, how), name, columns, blocks)
            for side, columns, name, rows in sides
        ]
        return frames[0].unionByName(frames[1], allowMissingColumns=True)

    hot = heavy_hashes(sides[0][3].select(*key).unionByName(sides[1][3].select(*key)), key, HOT_ROWS)
    place = F.xxhash64(*key) == F.col("_hot") if hot is not None else None
    # Intervals of one side follow each other, so the latest to start is the greatest
    # struct. Of two rows at the same position the first yields an empty overlap.
    upto = Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = events(hot and "left_anti", False).select(
        *key, "pos", F.max("s").over(upto).alias("supply"), F.max("d").over(upto).alias("demand"))
    if hot is not None:
        cut = with_blocks(events("left_semi", True), [*key, "pos"])
        both = both.unionByName(running(
            cut, key, ["pos"], latest={"supply": F.col("s"), "demand": F.col("d")}).select(*both.columns))
    quantity = F.least("supply.end", "demand.end") - F.col("pos")
    return (
        both.filter(F.col("supply").isNotNull() & F.col("demand").isNotNull())
        .withColumn("quantity", quantity)
        .filter("quantity > 0")
        .select(
            *key,
            *[F.col(f"supply.{c}").alias(c) for c in supply_columns],
            *[F.col(f"demand.{c}").alias(c) for c in demand_columns],
            F.col("quantity").cast("bigint").alias("quantity"),
        )
    )
