"""The twenty business reports.

Top-k reports end their sort on a unique key, so ties have one answer.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom.functions.scalars import (
    customer_name, enum_rank, full_name, month_of, or_zero, pct, ratio, seconds_between,
    whole_units,
)
from stockloom.operators.views import (
    category_sales, live_lines, live_orders, product_sales, stock_by_product,
)
from stockloom.operators.views import staff_counts
from stockloom.plans.lookup import lookup_join
from stockloom.plans.scan import saved


def _categories(categories: DataFrame) -> DataFrame:
    return categories.select("category_id", "category_name")


def _with_category(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Inner join: products without a category are dropped."""
    return lookup_join(
        products, _categories(categories), "category_id"
    )


def r01_top_products(
    order_items: DataFrame, products: DataFrame, categories: DataFrame, orders: DataFrame,
    k: int = 10,
) -> DataFrame:
    """Best sellers by revenue without cancelled orders."""
    sales = product_sales(live_lines(order_items, orders))
    catalog = _with_category(
        products.select("product_id", "sku", "product_name", "category_id"), categories
    )
    return (
        sales.join(catalog, "product_id")
        .select(
            "product_id", "sku", "product_name", "category_name",
            F.col("units").alias("total_units_sold"),
            F.col("revenue").alias("gross_revenue"),
        )
        .orderBy(F.desc("gross_revenue"), "product_id")
        .limit(k)
    )


def r02_lowest_inventory(products: DataFrame, inventory: DataFrame) -> DataFrame:
    return (
        products.select("product_id", "sku", "product_name", "reorder_level")
        .join(stock_by_product(inventory), "product_id", "left")
        .filter(or_zero("available") <= F.col("reorder_level"))
        .select(
            "product_id", "sku", "product_name",
            or_zero("on_hand").alias("total_on_hand"),
            or_zero("reserved").alias("total_reserved"),
            or_zero("available").alias("total_available"),
            "reorder_level",
        )
        .orderBy("total_available", "product_id")
    )


def r03_inventory_value(
    inventory: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    """Stock value per category name; stock is added up per product before the joins."""
    stock = stock_by_product(inventory).select("product_id", "on_hand")
    priced = stock.join(
        products.select("product_id", "category_id", "cost_price", "sale_price"), "product_id"
    )
    by_category = priced.groupBy("category_id").agg(
        F.sum("on_hand").alias("units"),
        F.sum(F.col("on_hand") * F.col("cost_price")).alias("cost"),
        F.sum(F.col("on_hand") * F.col("sale_price")).alias("retail"),
        F.sum(F.col("on_hand") * (F.col("sale_price") - F.col("cost_price"))).alias("profit"),
    )
    return (
        by_category.join(_categories(categories), "category_id")
        .groupBy("category_name")
        .agg(
            F.sum("units").alias("total_units_in_stock"),
            F.sum("cost").alias("total_inventory_cost_value"),
            F.sum("retail").alias("total_inventory_retail_value"),
            F.sum("profit").alias("potential_profit_margin"),
        )
        .orderBy(F.desc("total_inventory_cost_value"), "category_name")
    )


def r04_daily_orders(orders: DataFrame, k: int = 30) -> DataFrame:
    """The latest k days with orders, all statuses."""
    return (
        orders.groupBy(F.to_date("order_date").alias("order_day"))
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("total_amount").alias("daily_revenue"),
            F.avg("total_amount").alias("average_order_value"),
        )
        .orderBy(F.desc("order_day"))
        .limit(k)
    )


def r05_monthly_orders(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy(month_of("order_date").alias("order_month"))
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("total_amount").alias("monthly_revenue"),
            F.avg("total_amount").alias("average_order_value"),
        )
        .orderBy(F.desc("order_month"))
    )


def r06_fulfillment_rate(orders: DataFrame) -> DataFrame:
    """Shipped and delivered count as fulfilled, returned does not."""
    status = F.col("status")
    counts = orders.agg(
        F.count("order_id").alias("total_orders"),
        F.count_if(status.isin("Shipped", "Delivered")).alias("fulfilled_orders"),
        F.count_if(status == "Cancelled").alias("cancelled_orders"),
        F.count_if(status == "Pending").alias("pending_orders"),
    )
    return counts.select(
        "*",
        pct("fulfilled_orders", "total_orders").alias("fulfillment_rate_percentage"),
        pct("cancelled_orders", "total_orders").alias("cancellation_rate_percentage"),
    )


def r07_avg_shipping_time(shipments: DataFrame) -> DataFrame:
    delivered = shipments.filter(
        (F.col("status") == "Delivered")
        & F.col("ship_date").isNotNull()
        & F.col("delivery_date").isNotNull()
    )
    days = ratio(
        F.sum(seconds_between("ship_date", "delivery_date")),
        F.count(F.lit(1)) * 86400,
    )
    return (
        delivered.groupBy("carrier")
        .agg(
            F.count("shipment_id").alias("total_shipments"),
            F.round(days, 2).alias("avg_delivery_time_days"),
            F.round(F.avg("shipping_cost"), 2).alias("avg_shipping_cost"),
        )
        .orderBy("avg_delivery_time_days", "carrier")
    )


def r08_employee_productivity(employees: DataFrame, orders: DataFrame) -> DataFrame:
    """Active pickers and packers ranked within their role, cancelled orders left out.

    The rank is taken over the distinct totals of a role, so a role with very many
    employees is not gathered in one task.
    """
    # One pass over the orders; the ranks and the result read the rows per employee again.
    staff = saved(
        employees.filter((F.col("status") == "Active") & F.col("role").isin("Picker", "Packer"))
        .join(staff_counts(live_orders(orders)), "employee_id", "left")
        .select(
            "employee_id", full_name().alias("employee_name"), "role",
            or_zero("picked").alias("total_orders_picked"),
            or_zero("packed").alias("total_orders_packed"),
            (or_zero("picked") + or_zero("packed")).alias("total"),
        )
    )
    ranks = (
        staff.select("role", "total").distinct()
        .withColumn(
            "productivity_rank",
            F.dense_rank().over(Window.partitionBy("role").orderBy(F.desc("total"))),
        )
    )
    return (
        staff.join(ranks, ["role", "total"])
        .orderBy(enum_rank("employees", "role"), "productivity_rank", "employee_id")
        .select(
            "employee_id", "employee_name", "role", "total_orders_picked",
            "total_orders_packed", "productivity_rank",
        )
    )


def r09_warehouse_utilization(locations: DataFrame) -> DataFrame:
    return (
        locations.groupBy("zone")
        .agg(
            F.count("location_id").alias("total_bins"),
            F.sum("max_capacity").alias("max_storage_capacity"),
            F.sum("current_capacity").alias("current_occupied_capacity"),
            pct(F.sum("current_capacity"), F.sum("max_capacity"))
            .alias("utilization_rate_percentage"),
            F.count_if(F.col("current_capacity") == 0).alias("empty_bins"),
            F.count_if(F.col("current_capacity") >= F.col("max_capacity"))
            .alias("fully_occupied_bins"),
        )
        .orderBy(F.desc("utilization_rate_percentage"), "zone")
    )


def r10_supplier_performance(
    suppliers: DataFrame, products: DataFrame, transactions: DataFrame, exact: bool = False
) -> DataFrame:
    """Supplied products, mean cost and receipts per supplier.

    Receipts belong to a supplier when their reference starts with ``RECV-SUPP-`` and the
    supplier id. As a prefix match, id 1 also takes the receipts of 10, 11, 100 and so on;
    ``exact=True`` compares the whole number. Either way the ledger is counted per number
    first and then joined by equality: a number is counted under each of its prefixes.
    """
    supplied = (
        products.filter("supplier_id IS NOT NULL")
        .groupBy("supplier_id")
        .agg(F.count("product_id").alias("n_products"), F.avg("cost_price").alias("avg_cost"))
    )
    digits = F.regexp_extract("reference_id", "^RECV-SUPP-([0-9]+)", 1)
    counts = (
        transactions.filter(F.col("transaction_type").isin("RECEIVING", "QUALITY_FAIL"))
        .select(digits.alias("digits"), "transaction_type")
        .filter("digits <> ''")
        .groupBy("digits")
        .agg(
            F.count_if(F.col("transaction_type") == "RECEIVING").alias("received"),
            F.count_if(F.col("transaction_type") == "QUALITY_FAIL").alias("failed"),
        )
    )
    if exact:
        matched = counts.withColumnRenamed("digits", "id_text")
    else:
        lengths = F.sequence(F.lit(1), F.length("digits"))
        matched = (
            counts.withColumn("n", F.explode(lengths))
            .groupBy(F.expr("substring(digits, 1, n)").alias("id_text"))
            .agg(F.sum("received").alias("received"), F.sum("failed").alias("failed"))
        )
    return (
        suppliers.select("supplier_id", "supplier_name", "performance_rating")
        .join(supplied, "supplier_id", "left")
        .withColumn("id_text", F.col("supplier_id").cast("string"))
        .join(matched, "id_text", "left")
        .select(
            "supplier_id", "supplier_name", "performance_rating",
            or_zero("n_products").alias("total_supplied_products"),
            F.round("avg_cost", 2).alias("avg_product_cost"),
            or_zero("received").alias("total_shipments_received"),
            or_zero("failed").alias("total_quality_failures"),
        )
        .orderBy(F.desc("performance_rating"), "supplier_id")
    )


def _units_by_category(rows: DataFrame, products: DataFrame, name: str) -> DataFrame:
    """Σ quantity per category, added up per product before the join."""
    units = rows.groupBy("product_id").agg(F.sum("quantity").alias("units"))
    return (
        units.join(products.select("product_id", "category_id"), "product_id")
        .groupBy("category_id")
        .agg(F.sum("units").alias(name))
    )


def r11_return_percentage(
    categories: DataFrame, products: DataFrame, order_items: DataFrame, returns: DataFrame
) -> DataFrame:
    """Returned per sold unit and category; cancelled sales count, NULL if nothing sold."""
    return (
        _categories(categories)
        .join(_units_by_category(order_items, products, "sold"), "category_id", "left")
        .join(_units_by_category(returns, products, "returned"), "category_id", "left")
        .select(
            "category_name",
            or_zero("sold").alias("total_units_sold"),
            or_zero("returned").alias("total_units_returned"),
            pct(or_zero("returned"), or_zero("sold")).alias("return_rate_percentage"),
        )
        .orderBy(F.desc("return_rate_percentage"), "category_name")
    )


def r12_category_sales(
    categories: DataFrame, products: DataFrame, order_items: DataFrame, orders: DataFrame
) -> DataFrame:
    return (
        category_sales(categories, products, order_items, orders)
        .select(
            "category_name",
            F.col("orders").alias("total_orders"),
            F.col("units").alias("total_items_sold"),
            F.col("revenue").alias("gross_sales_revenue"),
            F.col("cost").alias("cost_of_goods_sold"),
            F.col("profit").alias("net_profit"),
        )
        .orderBy(F.desc("gross_sales_revenue"), "category_name")
    )


def _since(as_of: datetime, days: int):
    start = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    return start - F.make_dt_interval(F.lit(days))


def r13_fast_movers(
    products: DataFrame, categories: DataFrame, order_items: DataFrame, orders: DataFrame,
    as_of: datetime, days: int = 60, k: int = 15,
) -> DataFrame:
    """Products by units sold in the last days; ties share a rank.

    Rows that sell more than a top-k row are in the top k themselves, so ranking the k rows
    gives the rank among all products without a window over all of them.
    """
    recent = orders.filter(F.col("order_date") >= _since(as_of, days))
    sold = (
        live_lines(order_items, recent)
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("recent_units"))
    )
    catalog = _with_category(
        products.select("product_id", "sku", "product_name", "category_id"), categories
    )
    top = (
        catalog.join(sold, "product_id", "left")
        .withColumn("units_sold", or_zero("recent_units"))
        .orderBy(F.desc("units_sold"), "product_id")
        .limit(k)
    )
    rank = F.rank().over(Window.orderBy(F.desc("units_sold")))
    return (
        top.withColumn("sales_velocity_rank", rank)
        .orderBy("sales_velocity_rank", "product_id")
        .select(
            "sku", "product_name", "category_name",
            F.col("units_sold").alias(f"units_sold_{days}_days"), "sales_velocity_rank",
        )
    )


def r14_slow_movers(
    products: DataFrame, categories: DataFrame, inventory: DataFrame, order_items: DataFrame,
    orders: DataFrame, as_of: datetime, days: int = 90, k: int = 15, deduped: bool = False,
) -> DataFrame:
    """Stock of products by their sales outside the last days; cancelled orders count.

    As reported, stock counts once per order line older than the period (once if the
    product was never ordered), and a product with old and recent lines still appears.
    Two sums per product replace that fan-out join. ``deduped=True`` counts stock once and
    keeps only products without any recent line.
    """
    recent = orders.filter(F.col("order_date") >= _since(as_of, days)).select(
        "order_id", F.lit(1).alias("is_recent")
    )
    lines = (
        order_items.select("order_id", "product_id")
        .join(recent, "order_id", "left")
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.count("is_recent").alias("n_recent"))
    )
    stock = stock_by_product(inventory).select("product_id", "on_hand")
    catalog = _with_category(
        products.select("product_id", "sku", "product_name", "category_id", "cost_price"),
        categories,
    )
    merged = catalog.join(stock, "product_id", "left").join(lines, "product_id", "left")
    if deduped:
        kept = merged.filter(or_zero("n_recent") == 0).withColumn("times", F.lit(1))
    else:
        old = F.col("n_lines") - F.col("n_recent")
        kept = merged.withColumn("times", F.coalesce(old, F.lit(1))).filter("times > 0")
    units = or_zero("on_hand") * F.col("times")
    return (
        kept.select(
            "product_id", "sku", "product_name", "category_name",
            units.alias("current_inventory"),
            (units * F.col("cost_price")).alias("dead_stock_value_cost"),
        )
        .orderBy(F.desc("dead_stock_value_cost"), "product_id")
        .limit(k)
        .drop("product_id")
    )


def r15_inventory_turnover(
    categories: DataFrame, products: DataFrame, order_items: DataFrame, orders: DataFrame,
    inventory: DataFrame,
) -> DataFrame:
    """Cost of goods sold over current stock value per category; NULL without stock value."""
    dim = products.select("product_id", "category_id", "cost_price")

    def valued(units: DataFrame, name: str) -> DataFrame:
        return (
            units.join(dim, "product_id")
            .groupBy("category_id")
            .agg(F.sum(F.col("units") * F.col("cost_price")).alias(name))
        )

    sold = (
        live_lines(order_items, orders)
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("units"))
    )
    stock = inventory.groupBy("product_id").agg(F.sum("quantity_on_hand").alias("units"))
    turnover = F.round(ratio(or_zero("cogs"), "stock_value"), 2)
    return (
        _categories(categories)
        .join(valued(sold, "cogs"), "category_id", "left")
        .join(valued(stock, "stock_value"), "category_id", "left")
        .select(
            "category_name",
            or_zero("cogs").alias("cost_of_goods_sold"),
            or_zero("stock_value").alias("current_stock_value"),
            turnover.alias("inventory_turnover_ratio"),
        )
        .orderBy(F.desc("inventory_turnover_ratio"), "category_name")
    )


def r16_customer_frequency(customers: DataFrame, orders: DataFrame, k: int = 20) -> DataFrame:
    """Segments by order count; customers without orders have no lifetime value."""
    per_customer = (
        live_orders(orders)
        .filter("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(F.count("order_id").alias("n_orders"), F.sum("total_amount").alias("value"))
    )
    n = or_zero("n_orders")
    # Segment limits and names.
    segment = (
        F.when(n >= 15, "VIP Frequent Buyer")
        .when(n >= 8, "Regular Customer")
        .when(n >= 3, "Occasional Buyer")
        .otherwise("One-Time / Inactive")
    )
    return (
        customers.join(per_customer, "customer_id", "left")
        .select(
            "customer_id", customer_name(customers.columns).alias("customer_name"),
            "membership_tier", n.alias("total_orders"),
            F.round("value", 2).alias("customer_lifetime_value"),
            segment.alias("customer_segment"),
        )
        .orderBy(F.desc("customer_lifetime_value"), "customer_id")
        .limit(k)
    )


def r17_revenue_by_month(orders: DataFrame) -> DataFrame:
    """Monthly revenue with the month before; the window runs over one row per month."""
    monthly = (
        live_orders(orders)
        .groupBy(month_of("order_date").alias("order_month"))
        .agg(F.sum("total_amount").alias("revenue"))
    )
    before = F.lag("revenue").over(Window.orderBy("order_month"))
    return (
        monthly.withColumn("previous", before)
        .select(
            "order_month",
            F.round("revenue", 2).alias("revenue"),
            F.round("previous", 2).alias("previous_month_revenue"),
            pct(F.col("revenue") - F.col("previous"), "previous").alias("mom_growth_percentage"),
        )
        .orderBy(F.desc("order_month"))
    )


def r18_top_customers(
    customers: DataFrame, orders: DataFrame, order_items: DataFrame, products: DataFrame,
    categories: DataFrame, k: int = 10,
) -> DataFrame:
    """Customers by spend with the category they bought most lines of.

    Spend leaves out cancelled orders, the favourite category does not. It is worked out
    for the k customers only; equal counts go to the lower category id.
    """
    spend = (
        live_orders(orders)
        .groupBy("customer_id")
        .agg(F.sum("total_amount").alias("total_spent"))
    )
    # Read by the orders and by the result: the k rows are worked out once.
    top = saved(
        customers.select(
            "customer_id", customer_name(customers.columns).alias("customer_name")
        )
        .join(spend, "customer_id")
        .orderBy(F.desc("total_spent"), "customer_id")
        .limit(k)
    )
    # k rows, so the broadcast is bounded by the parameter.
    their_orders = orders.select("order_id", "customer_id").join(
        F.broadcast(top.select("customer_id")), "customer_id", "left_semi"
    )
    bought = (
        order_items.select("order_id", "product_id")
        .join(their_orders, "order_id")
        .groupBy("customer_id", "product_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    favourite = (
        lookup_join(
            bought, products.select("product_id", "category_id"), "product_id"
        )
        .groupBy("customer_id", "category_id")
        .agg(F.sum("n").alias("n"))
        .groupBy("customer_id")
        .agg(F.max_by("category_id", F.struct("n", -F.col("category_id"))).alias("category_id"))
    )
    return (
        top.join(favourite, "customer_id", "left")
        .join(_categories(categories), "category_id", "left")
        .select(
            "customer_id", "customer_name", F.round("total_spent", 2).alias("total_spent"),
            F.col("category_name").alias("favorite_product_category"),
        )
        .orderBy(F.desc("total_spent"), "customer_id")
    )


def r19_most_returned(
    returns: DataFrame, products: DataFrame, categories: DataFrame, k: int = 10
) -> DataFrame:
    per_product = returns.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("total_return_events"),
        F.sum("quantity").alias("total_units_returned"),
        F.round(F.sum("refund_amount"), 2).alias("total_refunded_capital"),
    )
    catalog = _with_category(
        products.select("product_id", "sku", "product_name", "category_id"), categories
    )
    return (
        per_product.join(catalog, "product_id")
        .orderBy(F.desc("total_units_returned"), "product_id")
        .limit(k)
        .select(
            "sku", "product_name", "category_name", "total_return_events",
            "total_units_returned", "total_refunded_capital",
        )
    )


def r20_shipping_delays(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Late by whole hours over 24 (dispatch) and whole days over 3 (delivery)."""
    delivered = shipments.filter(
        (F.col("status") == "Delivered")
        & F.col("ship_date").isNotNull()
        & F.col("delivery_date").isNotNull()
    ).drop("status")
    late_delivery = F.count_if(whole_units("DAY", "ship_date", "delivery_date") > 3)
    return (
        delivered.join(orders.select("order_id", "order_date"), "order_id")
        .groupBy("carrier")
        .agg(
            F.count("shipment_id").alias("total_shipments"),
            F.count_if(whole_units("HOUR", "order_date", "ship_date") > 24)
            .alias("late_dispatches_count"),
            late_delivery.alias("late_deliveries_count"),
            pct(late_delivery, F.count("shipment_id")).alias("delay_rate_percentage"),
        )
        .orderBy(F.desc("delay_rate_percentage"), "carrier")
    )
