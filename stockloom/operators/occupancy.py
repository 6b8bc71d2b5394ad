"""Occupied space per location: from stock rows, or from changes to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.functions.scalars import occupancy, or_zero


def op_occupancy(inventory: DataFrame) -> DataFrame:
    """Space taken per location. Reserved units count on top of the units on hand."""
    return inventory.groupBy("location_id").agg(F.sum(occupancy()).alias("current_capacity"))


def stock_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Change rows (location_id, old_total, new_total) between two stock snapshots.

    An insert has no old row and a delete no new one; both count as 0.
    """
    keys = ["product_id", "location_id"]
    old = before.select(*keys, occupancy().alias("old_total"))
    new = after.select(*keys, occupancy().alias("new_total"))
    return (
        old.join(new, keys, "full")
        .select(
            "location_id", or_zero("old_total").alias("old_total"),
            or_zero("new_total").alias("new_total"),
        )
        .filter("old_total <> new_total")
    )


def occupancy_delta(changes: DataFrame) -> DataFrame:
    """Change of the occupied space per location."""
    return changes.groupBy("location_id").agg(
        F.sum(F.col("new_total") - F.col("old_total")).alias("delta")
    )


def apply_occupancy(locations: DataFrame, delta: DataFrame) -> DataFrame:
    """Locations with the change added to their occupied space."""
    return (
        locations.join(delta.select("location_id", "delta"), "location_id", "left")
        .withColumn(
            "current_capacity", (F.col("current_capacity") + or_zero("delta")).cast("bigint")
        )
        .select(*locations.columns)
    )
