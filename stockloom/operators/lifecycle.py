"""Picking, packing, shipping and delivery of orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.functions.scalars import order_reference
from stockloom.operators.lookups import pick_rows
from stockloom.operators.outcome import Outcome, first_per_order, ledger_rows
from stockloom.plans.allocate import allocate, laid_out
from stockloom.plans.scan import saved
from stockloom.schema import NOTES


def op_complete_pick(
    order_ids: DataFrame, orders: DataFrame, order_items: DataFrame, products: DataFrame,
    inventory: DataFrame, locations: DataFrame,
) -> Outcome:
    """Mark the lines on an order's pick list as picked, one PICKING row per bin.

    An order without pick list is refused. Lines without any reserved bin stay as they are;
    the order itself is in Picking afterwards.
    """
    rows = pick_rows(order_ids, order_items, products, inventory, locations)
    line = ["order_id", "product_id"] + (
        ["order_item_id"] if "order_item_id" in rows.columns else []
    )
    picked = rows.select(*line).distinct()
    started = picked.select("order_id").distinct().withColumn("has_rows", F.lit(True))
    decisions = (
        order_ids.join(started, "order_id", "left")
        .withColumn("accepted", F.coalesce("has_rows", F.lit(False)))
        .withColumn("reason", F.when(~F.col("accepted"), F.lit("empty pick list")))
        .drop("has_rows")
    )

    def effects():
        pickers = orders.select("order_id", "picking_employee_id")
        ledger = ledger_rows(
            rows.join(pickers, "order_id", "left"), "PICKING", location=F.col("location_id"),
            employee=F.col("picking_employee_id"), reference=order_reference(),
            notes=NOTES["pick"],
        )
        return ledger, {
            "orders": started.select("order_id", F.lit("Picking").alias("status")),
            "order_items": picked.withColumn("item_status", F.lit("Picked")),
        }

    return Outcome(decisions, effects)


def op_pick_reserved(order_ids: DataFrame, allocations: DataFrame, orders: DataFrame) -> Outcome:
    """Mark the lines that a reservation took stock for as picked, one PICKING row per bin taken from.

    ``allocations``: order_id, product_id, location_id, quantity, as ``op_reserve`` returns them.
    Work and ledger grow with what was reserved, not with lines times bins. An order without
    any allocation is refused.
    """
    rows = allocations.join(order_ids.select("order_id").distinct(), "order_id", "left_semi")
    started = rows.select("order_id").distinct()
    decisions = (
        order_ids.join(started.withColumn("has_rows", F.lit(True)), "order_id", "left")
        .withColumn("accepted", F.coalesce("has_rows", F.lit(False)))
        .withColumn("reason", F.when(~F.col("accepted"), F.lit("empty pick list")))
        .drop("has_rows")
    )

    def effects():
        pickers = orders.select("order_id", "picking_employee_id")
        ledger = ledger_rows(
            rows.join(pickers, "order_id", "left"), "PICKING", location=F.col("location_id"),
            employee=F.col("picking_employee_id"), reference=order_reference(),
            notes=NOTES["pick"],
        )
        lines = rows.select("order_id", "product_id").distinct()
        return ledger, {
            "orders": started.withColumn("status", F.lit("Picking")),
            "order_items": lines.withColumn("item_status", F.lit("Picked")),
        }

    return Outcome(decisions, effects)


def _decide(requests: DataFrame, state: DataFrame, required: str) -> DataFrame:
    """Accept the first request of every order whose status is the required one."""
    first = first_per_order(requests).withColumn("is_first", F.lit(True))
    current = F.col("current_status")
    return (
        requests.join(
            state.select("order_id", F.col("status").alias("current_status")), "order_id", "left"
        )
        .join(first, ["order_id", "seq"], "left")
        .withColumn(
            "accepted",
            F.coalesce(current == required, F.lit(False)) & F.col("is_first").isNotNull(),
        )
        .withColumn(
            "reason",
            F.when(current.isNull(), F.lit("not found"))
            .when(current != required, F.concat(F.lit("status "), current))
            .when(F.col("is_first").isNull(), F.lit("already done")),
        )
        .drop("is_first", "current_status")
    )


def _lines_of(accepted: DataFrame, order_items: DataFrame) -> DataFrame:
    return order_items.select("order_id", "product_id", "quantity").join(accepted, "order_id")


def op_pack(requests: DataFrame, orders: DataFrame, order_items: DataFrame) -> Outcome:
    """Pack orders that are in Picking. requests: order_id, employee_id, seq."""
    decisions = _decide(requests, orders, "Picking")
    accepted = decisions.filter("accepted").select("order_id", "employee_id")

    def effects():
        ledger = ledger_rows(
            _lines_of(accepted, order_items), "PACKING", employee=F.col("employee_id"),
            reference=order_reference(), notes=NOTES["pack"],
        )
        packed = accepted.select(
            "order_id", F.lit("Packed").alias("status"),
            F.col("employee_id").alias("packing_employee_id"),
        )
        items = accepted.select("order_id", F.lit("Packed").alias("item_status"))
        return ledger, {"orders": packed, "order_items": items}

    return Outcome(decisions, effects)


def op_ship(
    requests: DataFrame, orders: DataFrame, order_items: DataFrame, inventory: DataFrame
) -> Outcome:
    """Ship packed orders and take their goods out of the bins that hold reserved stock.

    requests: order_id, carrier, shipping_cost, tracking_number, ship_date, seq. Bins serve
    by location id, each up to its reserved stock, orders in sequence; what the bins do not
    cover is left out silently. Lines of one product are added up per order first.
    """
    decisions = _decide(requests, orders, "Packed")
    accepted = decisions.filter("accepted")

    def effects():
        per_product = ["order_id", "seq", "carrier", "tracking_number", "product_id"]
        shipped = accepted.select("order_id", "seq", "carrier", "tracking_number")
        demand = (
            _lines_of(shipped, order_items)
            .groupBy(*per_product)
            .agg(F.sum("quantity").alias("quantity"))
        )
        supply = laid_out(
            inventory.select("product_id", "location_id", "quantity_reserved"),
            ["product_id"], ["location_id"], "quantity_reserved",
        )
        wanted = laid_out(demand, ["product_id"], ["seq"], "quantity")
        taken = saved(
            allocate(
                supply, wanted, ["product_id"], ["location_id"],
                ["seq", "order_id", "carrier", "tracking_number"],
            )
        )
        note = F.concat(
            F.lit("Dispatched via "), F.col("carrier"), F.lit(". Tracking: "),
            F.col("tracking_number"),
        )
        ledger = ledger_rows(
            taken, "SHIPPING", location=F.col("location_id"), reference=order_reference(),
            notes=note,
        )
        out = F.sum(-F.col("quantity")).cast("bigint")
        return ledger, {
            "inventory_delta": taken.groupBy("product_id", "location_id").agg(
                out.alias("quantity_on_hand"), out.alias("quantity_reserved")
            ),
        }

    return Outcome(decisions, effects, {
        "shipments": accepted.select(
            "order_id", "tracking_number", "carrier", "shipping_cost", "ship_date",
            F.lit("In Transit").alias("status"),
        ),
        "orders": accepted.select("order_id", F.lit("Shipped").alias("status")),
        "order_items": accepted.select("order_id", F.lit("Shipped").alias("item_status")),
    })


def op_deliver(requests: DataFrame, shipments: DataFrame, order_items: DataFrame) -> Outcome:
    """Deliver orders whose shipment is in transit. requests: order_id, delivery_date, seq."""
    decisions = _decide(requests, shipments, "In Transit")
    accepted = decisions.filter("accepted").select("order_id", "delivery_date")

    def effects():
        ledger = ledger_rows(
            _lines_of(accepted, order_items), "DELIVERY", reference=order_reference(),
            notes=NOTES["deliver"],
        )
        return ledger, {
            "shipments": accepted.withColumn("status", F.lit("Delivered")),
            "orders": accepted.select("order_id", F.lit("Delivered").alias("status")),
        }

    return Outcome(decisions, effects)
