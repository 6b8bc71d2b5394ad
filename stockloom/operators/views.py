"""Analytical views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.functions.scalars import available, full_name, or_zero, pct, whole_units
from stockloom.plans.lookup import lookup_join


def live_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("status") != "Cancelled")


def live_lines(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines whose order was not cancelled.

    A left semi join on the unique order key: only that key is shuffled on the order side.
    """
    return order_items.join(live_orders(orders).select("order_id"), "order_id", "left_semi")


def revenue() -> Column:
    return F.sum(F.col("quantity") * F.col("unit_price"))


def product_sales(lines: DataFrame) -> DataFrame:
    """Units and revenue per product, added up before any join to the products.

    Rows of a hot product are combined inside each map task. ``priced_units`` leaves out
    lines without a price, as profit sums do.
    """
    priced = F.when(F.col("unit_price").isNotNull(), F.col("quantity"))
    return lines.groupBy("product_id").agg(
        F.sum("quantity").alias("units"),
        revenue().alias("revenue"),
        F.sum(priced).alias("priced_units"),
    )


def stock_by_product(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("product_id").agg(
        F.sum("quantity_on_hand").alias("on_hand"),
        F.sum("quantity_reserved").alias("reserved"),
        F.sum(available()).alias("available"),
    )


def v_inventory_utilization(locations: DataFrame) -> DataFrame:
    return locations.groupBy("zone").agg(
        F.count("location_id").alias("total_bins"),
        F.sum("max_capacity").alias("total_max_capacity"),
        F.sum("current_capacity").alias("total_current_capacity"),
        pct(F.sum("current_capacity"), F.sum("max_capacity")).alias("utilization_percentage"),
    )


def v_low_stock_alerts(
    products: DataFrame, categories: DataFrame, inventory: DataFrame
) -> DataFrame:
    """Products whose free stock is at or below their reorder level."""
    stocked = products.select(
        "product_id", "sku", "product_name", "category_id", "reorder_level"
    ).join(stock_by_product(inventory), "product_id", "left")
    low = stocked.filter(or_zero("available") <= F.col("reorder_level"))
    named = lookup_join(
        low, categories.select("category_id", "category_name"), "category_id", "left"
    )
    return named.select(
        "product_id", "sku", "product_name", "category_name",
        or_zero("on_hand").alias("quantity_on_hand"),
        or_zero("reserved").alias("quantity_reserved"),
        or_zero("available").alias("quantity_available"),
        "reorder_level",
    )


def v_order_fulfillment_kpis(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    shipped = shipments.select(
        "order_id", "ship_date", "delivery_date", "carrier", "shipping_cost"
    )
    return orders.join(shipped, "order_id", "left").select(
        "order_id", "status", "order_date", "ship_date", "delivery_date", "total_amount",
        whole_units("MINUTE", "order_date", "ship_date").alias("minutes_to_ship"),
        whole_units("HOUR", "order_date", "delivery_date").alias("hours_to_deliver"),
        "carrier", "shipping_cost",
    )


def staff_counts(orders: DataFrame) -> DataFrame:
    """(employee_id, picked, packed) in one pass over the orders."""
    tasks = orders.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("picking_employee_id").alias("employee_id"),
                    F.lit(1).alias("picked"), F.lit(0).alias("packed"),
                ),
                F.struct(
                    F.col("packing_employee_id").alias("employee_id"),
                    F.lit(0).alias("picked"), F.lit(1).alias("packed"),
                ),
            )
        ).alias("t")
    ).select("t.*")
    return (
        tasks.filter("employee_id IS NOT NULL")
        .groupBy("employee_id")
        .agg(F.sum("picked").alias("picked"), F.sum("packed").alias("packed"))
    )


def v_employee_productivity(
    employees: DataFrame, orders: DataFrame, transactions: DataFrame
) -> DataFrame:
    """Picks, packs and receipts per employee; cancelled orders count."""
    received = (
        transactions.filter("transaction_type = 'RECEIVING' AND employee_id IS NOT NULL")
        .groupBy("employee_id")
        .agg(F.count(F.lit(1)).alias("received"))
    )
    return (
        employees.join(staff_counts(orders), "employee_id", "left")
        .join(received, "employee_id", "left")
        .select(
            "employee_id", full_name().alias("employee_name"), "role", "status",
            or_zero("picked").alias("orders_picked"),
            or_zero("packed").alias("orders_packed"),
            or_zero("received").alias("shipments_received"),
        )
    )


def category_sales(
    categories: DataFrame, products: DataFrame, order_items: DataFrame, orders: DataFrame
) -> DataFrame:
    """Orders, units, revenue, cost and profit per category without cancelled orders.

    One pass: the distinct count is taken over (category, order) pairs, which spread over
    all tasks, and the money sums travel with those partial rows.
    """
    product_dim = products.select("product_id", "category_id", "cost_price").filter(
        "category_id IS NOT NULL"
    )
    lines = live_lines(order_items, orders)
    cost = F.col("quantity") * F.col("cost_price")
    profit = F.col("quantity") * (F.col("unit_price") - F.col("cost_price"))
    sums = (
        lookup_join(lines, product_dim, "product_id")
        .groupBy("category_id")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.sum("quantity").alias("units"),
            revenue().alias("revenue"),
            F.sum(cost).alias("cost"),
            F.sum(profit).alias("profit"),
        )
    )
    return categories.select("category_id", "category_name").join(sums, "category_id")


def v_category_sales(
    categories: DataFrame, products: DataFrame, order_items: DataFrame, orders: DataFrame
) -> DataFrame:
    return category_sales(categories, products, order_items, orders).select(
        "category_id", "category_name",
        F.col("orders").alias("total_orders"),
        F.col("units").alias("total_units_sold"),
        F.col("revenue").alias("gross_revenue"),
        F.col("cost").alias("total_cost"),
        F.col("profit").alias("net_profit"),
        pct("profit", "revenue").alias("profit_margin_percentage"),
    )


def v_inventory_value_by_location(
    inventory: DataFrame, locations: DataFrame, products: DataFrame
) -> DataFrame:
    """Cost and retail value of every bin and product."""
    stock = inventory.select("product_id", "location_id", "quantity_on_hand", "quantity_reserved")
    placed = lookup_join(
        stock, locations.select("location_id", "zone", "aisle", "shelf", "bin"), "location_id"
    )
    priced = lookup_join(
        placed, products.select("product_id", "sku", "product_name", "cost_price", "sale_price"),
        "product_id"
    )
    return priced.select(
        "zone", "aisle", "shelf", "bin", "sku", "product_name",
        "quantity_on_hand", "quantity_reserved",
        (F.col("quantity_on_hand") * F.col("cost_price")).alias("inventory_value_cost"),
        (F.col("quantity_on_hand") * F.col("sale_price")).alias("inventory_value_retail"),
    )
