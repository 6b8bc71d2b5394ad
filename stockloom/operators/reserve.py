"""Reservation of stock for orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.functions.scalars import available, order_reference
from stockloom.operators.outcome import Outcome, ledger_rows
from stockloom.plans.allocate import allocate, laid_out
from stockloom.plans.resolve import refused
from stockloom.plans.scan import saved
from stockloom.plans.scratch import Scratch
from stockloom.schema import NOTES


def op_reserve(requests: DataFrame, order_items: DataFrame, inventory: DataFrame) -> Outcome:
    """Reserve the lines of each order in sequence, all of an order or nothing.

    requests: order_id, seq (unique). An order passes when every product has enough free
    stock after the accepted orders before it; an order without lines passes. Bins with
    more stock on hand serve first, then the lower location id. Stock on hand stays.
    Several lines of one product in an order are reserved together. With an ``employee_id``
    in the requests that picker is set on the orders that pass.
    """
    picker = ["employee_id"] if "employee_id" in requests.columns else []
    asked = requests.select("order_id", F.col("seq").cast("bigint").alias("seq"), *picker)
    # Read by the decisions and by the allocation: joined and added up once.
    demand = Scratch(requests.sparkSession, "demand").keep(
        asked.join(order_items.select("order_id", "product_id", "quantity"), "order_id")
        .groupBy("seq", "order_id", "product_id")
        .agg(F.sum("quantity").alias("quantity"))
    )
    free = inventory.groupBy("product_id").agg(F.sum(available()).alias("level"))
    no = refused(
        demand.select(
            "seq", F.col("product_id").alias("resource"), F.col("quantity").alias("need"),
            (-F.col("quantity")).alias("delta"),
        ),
        free.withColumnRenamed("product_id", "resource"),
    )
    decisions = (
        asked.join(no.withColumn("accepted", F.lit(False)), "seq", "left")
        .withColumn("accepted", F.coalesce("accepted", F.lit(True)))
        .withColumn("reason", F.when(~F.col("accepted"), F.lit("insufficient stock")))
    )

    def effects():
        supply = laid_out(
            inventory.select(
                "product_id", "location_id", (-F.col("quantity_on_hand")).alias("rank"),
                available().alias("free"),
            ),
            ["product_id"], ["rank", "location_id"], "free",
        )
        accepted = demand.filter("seq IS NOT NULL").join(no, "seq", "left_anti")
        wanted = laid_out(accepted, ["product_id"], ["seq"], "quantity")
        allocations = saved(
            allocate(supply, wanted, ["product_id"], ["location_id"], ["seq", "order_id"])
        )
        ledger = ledger_rows(
            allocations, "RESERVATION", location=F.col("location_id"),
            reference=order_reference(), notes=NOTES["reserve"],
        )
        return ledger, {
            "allocations": allocations,
            "inventory_delta": allocations.groupBy("product_id", "location_id").agg(
                F.sum("quantity").cast("bigint").alias("quantity_reserved")
            ),
        }

    passed = decisions.filter("accepted").select("order_id")
    started = decisions.filter("accepted").select(
        "order_id", F.lit("Picking").alias("status"),
        *[F.col(c).alias("picking_employee_id") for c in picker],
    )
    return Outcome(decisions, effects, {
        "orders": started, "order_items": passed.withColumn("item_status", F.lit("Reserved"))})
