"""Derived order data: line prices, totals, line statuses and the expected ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.functions.scalars import order_reference
from stockloom.plans.lookup import lookup_join

# Status of the lines of an order in each status; all others: Pending.
ITEM_STATUS = {
    "Picking": "Reserved",
    "Packed": "Packed",
    "Shipped": "Shipped",
    "Delivered": "Shipped",
    "Returned": "Shipped",
    "Cancelled": "Cancelled",
}

# Events of a line by order status, with the employee column and note.
EVENTS = [
    ("RESERVATION", ["Picking", "Packed", "Shipped", "Delivered", "Returned"],
     "picking_employee_id", "Reserved for picking"),
    ("PICKING", ["Picking", "Packed", "Shipped", "Delivered", "Returned"],
     "picking_employee_id", "Picked from shelf"),
    ("PACKING", ["Packed", "Shipped", "Delivered", "Returned"],
     "packing_employee_id", "Order items packed"),
    ("SHIPPING", ["Shipped", "Delivered", "Returned"],
     "packing_employee_id", "Dispatched to carrier"),
    ("DELIVERY", ["Delivered", "Returned"], None, "Delivered to customer"),
]


def op_default_price(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with a missing or zero price get the product's sale price."""
    missing = F.col("unit_price").isNull() | (F.col("unit_price") == 0)
    priced = lookup_join(
        order_items, products.select("product_id", "sale_price"), "product_id", "left"
    )
    return priced.withColumn(
        "unit_price", F.when(missing, F.col("sale_price")).otherwise(F.col("unit_price"))
    ).select(*order_items.columns)


def op_order_total(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Orders with their total set to Σ quantity x unit price; 0.00 without lines."""
    totals = order_items.groupBy("order_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price")).alias("line_total")
    )
    total = F.coalesce("line_total", F.lit(0)).cast("decimal(18,2)")
    return (
        orders.drop("total_amount")
        .join(totals, "order_id", "left")
        .withColumn("total_amount", total)
        .drop("line_total")
    )


def op_order_status_items(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Lines with the status that follows from their order's status."""
    known = F.create_map(*[F.lit(v) for pair in ITEM_STATUS.items() for v in pair])
    status = F.coalesce(F.try_element_at(known, F.col("order_status")), F.lit("Pending"))
    by_order = orders.select("order_id", F.col("status").alias("order_status"))
    return (
        order_items.drop("item_status")
        .join(by_order, "order_id")
        .withColumn("item_status", status)
        .drop("order_status")
    )


def op_ledger_from_orders(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """The events every line must have passed, given its order's status.

    Only the part that follows from the orders: no bins and no times. A line is packed only
    if its order names a packer.
    """
    lines = order_items.select("order_id", "product_id", "quantity").join(
        orders.select("order_id", "status", "picking_employee_id", "packing_employee_id"),
        "order_id",
    )
    candidates = []
    for kind, statuses, employee, note in EVENTS:
        who = F.col(employee) if employee else F.lit(None)
        happened = F.col("status").isin(statuses)
        if kind == "PACKING":
            happened &= F.col(employee).isNotNull()
        event = F.struct(
            F.lit(kind).alias("transaction_type"), who.cast("bigint").alias("employee_id"),
            F.lit(note).alias("notes"),
        )
        candidates.append(F.when(happened, event))
    events = F.array_compact(F.array(*candidates))
    return lines.select("order_id", "product_id", "quantity", F.explode(events).alias("e")).select(
        "e.transaction_type", "product_id", "quantity", "e.employee_id",
        order_reference().alias("reference_id"), "e.notes",
    )
