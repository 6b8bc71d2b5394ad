"""Key figures of the KPI export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.functions.scalars import month_of, or_zero, ratio, seconds_between, usage_pct
from stockloom.plans.combine import one_row
from stockloom.schema import NOTES


def _not_cancelled(orders: DataFrame) -> DataFrame:
    """Orders without a status are kept here, unlike in the reports."""
    return orders.filter(~F.col("status").eqNullSafe("Cancelled"))


def k_aov(orders: DataFrame) -> DataFrame:
    return _not_cancelled(orders).agg(F.avg("total_amount").alias("average_order_value"))


def ledger_sign() -> Column:
    """Effect of a located ledger row on the stock on hand of its bin."""
    kind = F.col("transaction_type")
    return (
        F.when(kind.isin("PUT_AWAY", "STOCK_ADJUSTMENT"), F.lit(1))
        .when(kind == "SHIPPING", F.lit(-1))
        .otherwise(F.lit(0))
    )


def ledger_by_bin(transactions: DataFrame) -> DataFrame:
    """Signed ledger total per (product, location).

    A move writes one row, at its destination; the source is read from the row's note and
    gets the opposite amount.
    """
    located = transactions.filter(
        F.col("location_id").isNotNull() & (ledger_sign() != 0)
    )
    amount = (F.col("quantity") * ledger_sign()).alias("amount")
    signed = located.select("product_id", F.col("location_id").cast("bigint"), amount)
    if "notes" in transactions.columns:
        source = F.regexp_extract("notes", f"^{NOTES['moved_from']}([0-9]+)$", 1)
        moved_out = (
            located.filter("transaction_type = 'STOCK_ADJUSTMENT'")
            .withColumn("source", source)
            .filter("source <> ''")
            .select(
                "product_id", F.col("source").cast("bigint").alias("location_id"),
                (-F.col("quantity")).alias("amount"),
            )
        )
        signed = signed.unionByName(moved_out)
    return signed.groupBy("product_id", "location_id").agg(F.sum("amount").alias("ledger"))


def inventory_mismatches(inventory: DataFrame, transactions: DataFrame) -> DataFrame:
    """Bins whose stock on hand differs from their signed ledger."""
    return (
        inventory.select("product_id", "location_id", "quantity_on_hand")
        .join(ledger_by_bin(transactions), ["product_id", "location_id"], "left")
        .withColumn("ledger", or_zero("ledger"))
        .filter("quantity_on_hand <> ledger")
    )


def k_inventory_accuracy(inventory: DataFrame, transactions: DataFrame) -> DataFrame:
    """Share of bins whose stock on hand equals the signed ledger, 100 without bins."""
    checked = inventory.select("product_id", "location_id", "quantity_on_hand").join(
        ledger_by_bin(transactions), ["product_id", "location_id"], "left"
    )
    wrong = F.count_if(F.col("quantity_on_hand") != or_zero("ledger"))
    counted = checked.agg(F.count(F.lit(1)).alias("bins"), wrong.alias("mismatched_bins"))
    share = F.lit(100.0) - F.coalesce(ratio("mismatched_bins", "bins"), F.lit(0.0)) * 100
    return counted.select("*", F.round(share, 2).alias("inventory_accuracy_percentage"))


def inventory_accuracy_by_product(inventory: DataFrame, transactions: DataFrame) -> DataFrame:
    """Stock on hand and signed ledger per product, with shipping rows that name no bin.

    For ledgers that ship without a location, which cannot be reconciled per bin.
    """
    stock = inventory.groupBy("product_id").agg(F.sum("quantity_on_hand").alias("on_hand"))
    kind = F.col("transaction_type")
    put_away = (kind == "PUT_AWAY") | (
        (kind == "STOCK_ADJUSTMENT") & F.col("location_id").isNotNull()
    )
    # A move takes from one bin what it adds to another: nothing per product.
    if "notes" in transactions.columns:
        put_away &= ~F.coalesce(F.col("notes").startswith(NOTES["moved_from"]), F.lit(False))
    sign = F.when(put_away, 1).when(kind == "SHIPPING", -1).otherwise(0)
    ledger = (
        transactions.filter(kind.isin("PUT_AWAY", "STOCK_ADJUSTMENT", "SHIPPING"))
        .groupBy("product_id")
        .agg(F.sum(F.col("quantity") * sign).alias("ledger"))
    )
    return stock.join(ledger, "product_id", "left").select(
        "product_id", "on_hand", or_zero("ledger").alias("ledger"),
        (F.col("on_hand") == or_zero("ledger")).alias("matches"),
    )


def k_inventory_turnover(
    order_items: DataFrame, products: DataFrame, inventory: DataFrame
) -> DataFrame:
    """Cost of shipped lines over stock value; a stock value of 0 or less counts as 1.

    Both sides are added up per product, stacked, and joined to the products once.
    """
    shipped = (
        order_items.filter("item_status = 'Shipped'")
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("shipped"))
    )
    stock = inventory.groupBy("product_id").agg(F.sum("quantity_on_hand").alias("stock"))
    units = shipped.unionByName(stock, allowMissingColumns=True)
    totals = units.join(products.select("product_id", "cost_price"), "product_id").agg(
        or_zero(F.sum(F.col("shipped") * F.col("cost_price"))).alias("cogs"),
        or_zero(F.sum(F.col("stock") * F.col("cost_price"))).alias("stock_value"),
    )
    divisor = F.when(F.col("stock_value") > 0, F.col("stock_value")).otherwise(F.lit(1))
    return totals.select(
        "cogs", "stock_value", ratio("cogs", divisor).alias("inventory_turnover")
    )


def k_fulfillment_hours(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Mean hours from order to delivery of delivered orders."""
    done = orders.filter("status = 'Delivered'").select("order_id", "order_date").join(
        shipments.filter("delivery_date IS NOT NULL").select("order_id", "delivery_date"),
        "order_id",
    )
    seconds = F.sum(seconds_between("order_date", "delivery_date"))
    return done.agg(
        ratio(seconds, F.count(F.lit(1)) * 3600).alias("avg_fulfillment_time_hours")
    )


def k_carrier_performance(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Late dispatch (over 24.0 hours) and delivery (over 3.0 days) of all shipments."""
    late_dispatch = seconds_between("order_date", "ship_date") > 24 * 3600
    late_delivery = seconds_between("ship_date", "delivery_date") > 3 * 86400
    return (
        shipments.select("order_id", "shipment_id", "carrier", "ship_date", "delivery_date")
        .join(orders.select("order_id", "order_date"), "order_id")
        .filter("carrier IS NOT NULL")
        .groupBy("carrier")
        .agg(
            F.count("shipment_id").alias("total_shipments"),
            F.count_if(late_dispatch).alias("late_dispatches"),
            F.count_if(late_delivery).alias("late_deliveries"),
        )
        .select(
            "*",
            (ratio("late_dispatches", "total_shipments") * 100).alias("late_dispatch_rate"),
            (ratio("late_deliveries", "total_shipments") * 100).alias("late_delivery_rate"),
        )
    )


def k_return_rate(order_items: DataFrame, returns: DataFrame) -> DataFrame:
    """Returned per sold unit in percent, 0 when nothing was sold."""
    totals = one_row(
        order_items.agg(F.sum("quantity").alias("units_sold")),
        returns.agg(F.sum("quantity").alias("units_returned")),
    )
    rate = ratio(or_zero("units_returned"), or_zero("units_sold")) * 100
    return totals.select(
        or_zero("units_sold").alias("units_sold"),
        or_zero("units_returned").alias("units_returned"),
        F.coalesce(rate, F.lit(0.0)).alias("return_rate_percentage"),
    )


def k_most_active_supplier(
    transactions: DataFrame, products: DataFrame, suppliers: DataFrame
) -> DataFrame:
    """Supplier of the largest received quantity, 'None' without receipts.

    Equal quantities go to the lower supplier id.
    """
    received = (
        transactions.filter("transaction_type = 'RECEIVING'")
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("units"))
    )
    by_supplier = (
        received.join(products.select("product_id", "supplier_id"), "product_id")
        .groupBy("supplier_id")
        .agg(F.sum("units").alias("units"))
        .join(suppliers.select("supplier_id", "supplier_name"), "supplier_id")
    )
    top = F.max_by("supplier_name", F.struct("units", -F.col("supplier_id")))
    return by_supplier.agg(
        F.coalesce(top, F.lit("None")).alias("most_active_supplier"),
        or_zero(F.max("units")).alias("received_units"),
    )


def k_location_usage(locations: DataFrame) -> DataFrame:
    """Mean of the occupancy of each bin, not weighted by capacity."""
    usage = F.avg(usage_pct()).cast("double")
    return locations.agg(usage.alias("avg_location_usage_percentage"))


def k_monthly_sales(orders: DataFrame) -> DataFrame:
    return (
        _not_cancelled(orders)
        .groupBy(month_of("order_date").alias("month_year"))
        .agg(F.sum("total_amount").alias("total_amount"))
    )


def k_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """All key figures in one row, rounded to two digits."""
    t = tables
    accuracy = k_inventory_accuracy(t["inventory"], t["transactions"])
    turnover = k_inventory_turnover(t["order_items"], t["products"], t["inventory"])
    returned = k_return_rate(t["order_items"], t["returns"])
    supplier = k_most_active_supplier(t["transactions"], t["products"], t["suppliers"])

    def rounded(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.select(F.round(F.col(column).cast("double"), 2).alias(name))

    return one_row(
        rounded(k_aov(t["orders"]), "average_order_value", "average_order_value_usd"),
        accuracy.select("inventory_accuracy_percentage"),
        rounded(turnover, "inventory_turnover", "inventory_turnover_rate"),
        rounded(
            k_fulfillment_hours(t["orders"], t["shipments"]),
            "avg_fulfillment_time_hours", "avg_fulfillment_time_hours",
        ),
        rounded(returned, "return_rate_percentage", "return_rate_percentage"),
        rounded(
            k_location_usage(t["warehouse_locations"]), "avg_location_usage_percentage",
            "avg_warehouse_utilization_percentage",
        ),
        supplier.select("most_active_supplier"),
    )


def kpi_extracts(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The three KPI frames that are exported next to the base tables."""
    return {
        "carrier_performance_kpi": k_carrier_performance(tables["orders"], tables["shipments"]),
        "monthly_sales_trend": k_monthly_sales(tables["orders"]),
        "kpi_summary_dashboard": k_summary(tables),
    }
