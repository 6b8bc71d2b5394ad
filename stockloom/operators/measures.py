"""Dashboard measures and the frames behind the dashboard visuals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.functions.scalars import (
    customer_name, full_name, month_of, or_zero, pct, ratio, seconds_between, usage_pct,
)
from stockloom.operators.views import product_sales, staff_counts
from stockloom.plans.combine import one_row


def _zero_if_null(value):
    return F.coalesce(value, F.lit(0.0))


def m_fulfillment_rate(orders: DataFrame) -> DataFrame:
    """Shipped and delivered orders over all orders, 0 without orders."""
    done = F.count_if(F.col("status").isin("Shipped", "Delivered"))
    return orders.agg(_zero_if_null(ratio(done, F.count("order_id"))).alias("fulfillment_rate"))


def m_return_rate_ledger(transactions: DataFrame) -> DataFrame:
    """Inspected return quantity over shipped quantity in the ledger, 0 without shipments."""

    def total(kind: str):
        return F.sum(F.when(F.col("transaction_type") == kind, F.col("quantity")))

    moved = transactions.filter(F.col("transaction_type").isin("RETURN_INSPECTED", "SHIPPING"))
    rate = ratio(total("RETURN_INSPECTED"), total("SHIPPING"))
    return moved.agg(_zero_if_null(rate).alias("return_rate"))


def m_turnover_proxy(orders: DataFrame, transactions: DataFrame) -> DataFrame:
    """60 % of all order value over the summed ledger quantity, 0 without ledger."""
    totals = one_row(
        orders.agg(F.sum("total_amount").alias("sales")),
        transactions.agg(F.sum("quantity").alias("moved")),
    )
    cost = F.col("sales").cast("double") * 0.60  # Fixed value: assumed share of cost.
    return totals.select(_zero_if_null(ratio(cost, "moved")).alias("inventory_turnover"))


def m_avg_delivery_days(shipments: DataFrame) -> DataFrame:
    """Mean number of midnights between shipping and delivery."""
    days = F.datediff(F.to_date("delivery_date"), F.to_date("ship_date"))
    return shipments.filter("delivery_date IS NOT NULL").agg(
        F.avg(days).alias("average_delivery_days")
    )


def m_exec_cards(orders: DataFrame, transactions: DataFrame) -> DataFrame:
    """Revenue, orders, fulfillment and return rate in one row."""
    totals = orders.agg(
        F.sum("total_amount").alias("total_sales_revenue"),
        F.count_distinct("order_id").alias("total_orders"),
    )
    return one_row(
        totals, m_fulfillment_rate(orders), m_return_rate_ledger(transactions)
    )


def m_exec_trend(orders: DataFrame) -> DataFrame:
    """Sales per month, all statuses."""
    return orders.groupBy(month_of("order_date").alias("order_month")).agg(
        F.sum("total_amount").alias("revenue")
    )


def m_exec_category_revenue(
    order_items: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    """Line revenue per category, all statuses; added up per product before the joins."""
    return (
        product_sales(order_items)
        .select("product_id", "revenue")
        .join(products.select("product_id", "category_id"), "product_id")
        .groupBy("category_id")
        .agg(F.sum("revenue").alias("revenue"))
        .join(categories.select("category_id", "category_name"), "category_id")
        .select("category_name", "revenue")
    )


def m_exec_top_customers(orders: DataFrame, customers: DataFrame, k: int = 10) -> DataFrame:
    """Customers by spend with their order count, all statuses."""
    spend = orders.groupBy("customer_id").agg(
        F.sum("total_amount").alias("total_spent"), F.count("order_id").alias("order_count")
    )
    return (
        customers.select(
            "customer_id", customer_name(customers.columns).alias("customer_name")
        )
        .join(spend, "customer_id")
        .orderBy(F.desc("total_spent"), "customer_id")
        .limit(k)
    )


def m_inventory_cards(
    inventory: DataFrame, products: DataFrame, locations: DataFrame
) -> DataFrame:
    """Units on hand, value at cost and retail, and mean bin occupancy in one row."""
    stock = inventory.groupBy("product_id").agg(F.sum("quantity_on_hand").alias("on_hand"))
    units = stock.agg(F.sum("on_hand").alias("total_units_on_hand"))
    value = stock.join(
        products.select("product_id", "cost_price", "sale_price"), "product_id"
    ).agg(
        F.sum(F.col("on_hand") * F.col("cost_price")).alias("inventory_value_cost"),
        F.sum(F.col("on_hand") * F.col("sale_price")).alias("inventory_value_retail"),
    )
    usage = F.avg(usage_pct()).cast("double")
    bins = locations.agg(usage.alias("avg_location_occupancy_percentage"))
    return one_row(units, value, bins)


def m_inventory_zone_usage(locations: DataFrame) -> DataFrame:
    """Mean bin occupancy per zone."""
    usage = F.avg(usage_pct()).cast("double")
    return locations.groupBy("zone").agg(usage.alias("avg_usage_percentage"))


def m_inventory_drill(locations: DataFrame) -> DataFrame:
    """Occupancy by zone, aisle and bin with subtotals of every level.

    NULL marks the levels that are added up; ``level`` is their number (0: single bins).
    """
    depth = F.grouping_id()
    return (
        locations.rollup("zone", "aisle", "bin")
        .agg(
            F.sum("current_capacity").alias("current_capacity"),
            F.sum("max_capacity").alias("max_capacity"),
            F.when(depth == 0, 0).when(depth == 1, 1).when(depth == 3, 2).otherwise(3)
            .alias("level"),
        )
        .select("level", "zone", "aisle", "bin", "current_capacity", "max_capacity")
    )


def m_shipping_cards(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Mean hours to ship, mean transit days and late dispatch share in one row."""
    to_ship = seconds_between("order_date", "ship_date")
    transit = seconds_between("ship_date", "delivery_date")
    joined = shipments.select("order_id", "ship_date", "delivery_date").join(
        orders.select("order_id", "order_date"), "order_id"
    )
    return joined.agg(
        ratio(F.sum(to_ship), F.count(to_ship) * 3600).alias("avg_hours_to_ship"),
        ratio(F.sum(transit), F.count(transit) * 86400).alias("avg_transit_days"),
        pct(F.count_if(to_ship > 24 * 3600), F.count(F.lit(1)))
        .alias("late_dispatch_percentage"),
    )


def m_shipping_carriers(shipments: DataFrame) -> DataFrame:
    """Cost against speed per carrier; days over delivered, cost over all shipments."""
    days = F.datediff(F.to_date("delivery_date"), F.to_date("ship_date"))
    return shipments.groupBy("carrier").agg(
        F.count("shipment_id").alias("total_shipments"),
        F.avg(days).alias("avg_delivery_days"),
        F.avg("shipping_cost").alias("avg_shipping_cost"),
    )


def m_shipping_status(shipments: DataFrame) -> DataFrame:
    return shipments.groupBy("status").agg(F.count("shipment_id").alias("shipments"))


def m_staff_cards(employees: DataFrame, orders: DataFrame) -> DataFrame:
    """Active staff, and orders per active day and hour for pickers and packers.

    An active day of an employee is a day with at least one of their orders; an hour is
    counted alike. The rates are orders over the summed active days or hours.
    """
    active = employees.filter("status = 'Active'").agg(
        F.count("employee_id").alias("active_staff")
    )

    def rates(column: str, name: str) -> DataFrame:
        # One row per employee and hour, then the days are counted from those rows.
        hourly = (
            orders.filter(F.col(column).isNotNull())
            .groupBy(column, F.date_trunc("hour", "order_date").alias("hour"))
            .agg(F.count("order_id").alias("n"))
        )
        daily = hourly.groupBy(column, F.to_date("hour").alias("day")).agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("hours")
        )
        return daily.agg(
            ratio(F.sum("n"), F.count(F.lit(1))).alias(f"{name}_per_day"),
            ratio(F.sum("n"), F.sum("hours")).alias(f"{name}_per_hour"),
        )

    return one_row(
        active, rates("picking_employee_id", "picks"), rates("packing_employee_id", "packs")
    )


def m_staff_leaderboard(employees: DataFrame, orders: DataFrame) -> DataFrame:
    """Picked plus packed orders per employee with their role."""
    return (
        employees.join(staff_counts(orders), "employee_id", "left")
        .select(
            "employee_id", full_name().alias("employee_name"), "role",
            (or_zero("picked") + or_zero("packed")).alias("task_count"),
        )
        .orderBy(F.desc("task_count"), "employee_id")
    )
