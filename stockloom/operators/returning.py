"""Customer returns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.functions.scalars import order_reference
from stockloom.operators.outcome import Event, Outcome, first_per_order, ledger_events
from stockloom.schema import NOTES, SCRAP_REASONS


def op_return(
    requests: DataFrame, orders: DataFrame, order_items: DataFrame, inventory: DataFrame
) -> Outcome:
    """Take goods back for delivered orders.

    requests: order_id, product_id, qty, reason, return_date, seq (unique). The order must
    be Delivered and hold the product with at least that quantity (of several lines, the
    one with the lowest line id, or else the smallest quantity and price). A return moves
    the whole order to Returned, so only the first valid request of an order passes;
    ``fully_returned`` tells whether it covered everything. Goods go back to the product's
    lowest location, damaged and defective ones are scrapped.
    """
    asked = requests.withColumn("seq", F.col("seq").cast("bigint"))
    wanted = asked.select("order_id").distinct()
    lines = order_items.join(wanted, "order_id", "left_semi")
    line_order = (
        F.col("order_item_id")
        if "order_item_id" in order_items.columns
        else F.struct("quantity", "unit_price")
    )
    per_product = lines.groupBy("order_id", "product_id").agg(
        F.min_by(F.struct("quantity", "unit_price"), line_order).alias("line"),
        F.sum("quantity").alias("units"),
    )
    bought = per_product.drop("units")
    totals = per_product.groupBy("order_id").agg(F.sum("units").alias("order_units"))
    checked = (
        asked.join(
            orders.select("order_id", F.col("status").alias("order_status")), "order_id", "left"
        )
        .join(bought, ["order_id", "product_id"], "left")
        .withColumn(
            "refusal",
            F.when(
                ~F.coalesce(F.col("order_status") == "Delivered", F.lit(False)),
                F.lit("order not delivered"),
            )
            .when(F.col("line").isNull(), F.lit("product not in order"))
            .when(F.col("qty") > F.col("line.quantity"), F.lit("more than bought")),
        )
    )
    first = first_per_order(checked.filter("refusal IS NULL")).withColumn("is_first", F.lit(True))
    decided = checked.join(first, ["order_id", "seq"], "left").withColumn(
        "accepted", F.col("refusal").isNull() & F.col("is_first").isNotNull()
    )
    decisions = decided.withColumn(
        "reason_refused",
        F.when(~F.col("accepted"), F.coalesce("refusal", F.lit("order already returned"))),
    ).select(*asked.columns, "accepted", "reason_refused")

    def effects():
        # Every product's lowest bin; bins are combined inside the map tasks.
        bins = inventory.groupBy("product_id").agg(F.min("location_id").alias("location_id"))
        scrapped = F.col("reason").isin(SCRAP_REASONS)
        accepted = (
            decided.filter("accepted")
            .join(totals, "order_id", "left")
            .join(bins, "product_id", "left")
            .withColumn("refund_amount", F.round(F.col("qty") * F.col("line.unit_price"), 2))
            .withColumn("fully_returned", F.col("qty") == F.col("order_units"))
        )
        goes_back = ~scrapped & F.col("location_id").isNotNull()
        inspected = F.concat(
            F.lit("Return QA completed. Reason: "), F.col("reason"), F.lit(". Restockable: "),
            F.when(scrapped, F.lit("False")).otherwise(F.lit("True")),
        )
        reference = order_reference()
        location = F.col("location_id")
        events = [
            Event("RETURN_INSPECTED", reference=reference, notes=inspected),
            Event("STOCK_ADJUSTMENT", goes_back, location, None, reference, NOTES["restock"]),
            Event("QUALITY_FAIL", scrapped, None, None, reference, NOTES["scrap"]),
        ]
        return ledger_events(accepted, events, "qty"), {
            "returns": accepted.select(
                "order_id", "product_id", F.col("qty").alias("quantity"),
                F.col("reason").alias("return_reason"), "return_date", "refund_amount",
                F.lit("Approved").alias("status"), "fully_returned",
            ),
            "inventory_delta": accepted.filter(goes_back)
            .groupBy("product_id", "location_id")
            .agg(F.sum("qty").cast("bigint").alias("quantity_on_hand")),
            "orders": accepted.select("order_id", F.lit("Returned").alias("status")),
        }

    return Outcome(decisions, effects)
