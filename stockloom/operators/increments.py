"""Order and category figures kept up to date from changed orders alone.

What is stored are cells: sums per day and status, and per category, of which the reports and the
view are made. Cells of rows before a change count negatively, those after it positively, so adding
the two to the stored cells gives what all rows would give. Only changed orders are read, a cell
without rows goes, and cells can be merged in any order and number of steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom.functions.scalars import month_of, pct
from stockloom.operators.views import live_lines, live_orders
from stockloom.plans.lookup import lookup_join

DAY_KEYS, DAY_SUMS = ["order_day", "cancelled"], ["n_rows", "n_orders", "n_amounts", "amount"]
CATEGORY_KEYS = ["category_id"]
CATEGORY_SUMS = ["n_rows", "n_orders", "units", "n_revenue", "revenue", "cost", "n_profit", "profit"]


def day_cells(orders: DataFrame, sign: int = 1) -> DataFrame:
    """Orders and amounts per day, cancelled ones (and those without a status) apart."""
    live = F.coalesce(F.col("status") != "Cancelled", F.lit(False))
    return orders.groupBy(F.to_date("order_date").alias("order_day"), (~live).alias("cancelled")).agg(
        (sign * F.count(F.lit(1))).alias("n_rows"),
        (sign * F.count("order_id")).alias("n_orders"),
        (sign * F.count("total_amount")).alias("n_amounts"),
        (sign * F.coalesce(F.sum(F.col("total_amount").cast("decimal(38,2)")), F.lit(0))).cast("decimal(38,2)").alias("amount"),
    )


def category_cells(products: DataFrame, order_items: DataFrame, orders: DataFrame, sign: int = 1) -> DataFrame:
    """Distinct orders, units and money per category of the lines of live orders.

    Give whole orders: an order counts once in each category that it has lines of, and that holds
    when all its lines come in one call.
    """
    dim = products.select("product_id", "category_id", "cost_price").filter("category_id IS NOT NULL")
    lines = lookup_join(live_lines(order_items, orders), dim, "product_id")
    revenue = F.col("quantity") * F.col("unit_price")
    profit = F.col("quantity") * (F.col("unit_price") - F.col("cost_price"))

    def total(value):
        return (sign * F.coalesce(F.sum(value), F.lit(0))).cast("decimal(38,2)")

    return lines.groupBy("category_id").agg(
        (sign * F.count(F.lit(1))).alias("n_rows"),
        (sign * F.count_distinct("order_id")).alias("n_orders"),
        (sign * F.coalesce(F.sum("quantity"), F.lit(0))).cast("bigint").alias("units"),
        (sign * F.count(revenue)).alias("n_revenue"), total(revenue).alias("revenue"),
        total(F.col("quantity") * F.col("cost_price")).alias("cost"),
        (sign * F.count(profit)).alias("n_profit"), total(profit).alias("profit"),
    )


def merged(keys: list[str], sums: list[str], *cells: DataFrame) -> DataFrame:
    """Cells added up; those that no row is left in are gone."""
    rows = cells[0].select(*keys, *sums)
    for more in cells[1:]:
        rows = rows.unionByName(more.select(*keys, *sums))
    kinds = {f.name: f.dataType for f in rows.schema}
    return rows.groupBy(*keys).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in sums]).filter("n_rows <> 0")


def refreshed_days(cells: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Day cells after orders changed from ``before`` to ``after``; new ones are in ``after`` only,
    deleted ones in ``before`` only."""
    return merged(DAY_KEYS, DAY_SUMS, cells, day_cells(before, -1), day_cells(after))


def refreshed_categories(cells: DataFrame, products: DataFrame, before: tuple[DataFrame, DataFrame],
                         after: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Category cells after changes; ``before`` and ``after`` are (lines, orders) of all changed orders.

    An order changes when it, or any of its lines, does.
    """
    return merged(CATEGORY_KEYS, CATEGORY_SUMS, cells, category_cells(products, *before, -1),
                  category_cells(products, *after))


def changed_orders(before: DataFrame, after: DataFrame) -> DataFrame:
    """order_id of the rows that differ between two states of a table, in any column or number.

    Rows are compared as hashes added up per order, so a repeated row counts.
    """
    columns = sorted(set(before.columns) & set(after.columns))
    row = F.xxhash64(*[F.col(c).cast("string") for c in columns])
    both = before.select("order_id", row.alias("h"), F.lit(-1).alias("s")).unionByName(
        after.select("order_id", row.alias("h"), F.lit(1).alias("s")))
    return both.groupBy("order_id", "h").agg(F.sum("s").alias("s")).filter("s <> 0").select("order_id").distinct()


# ---- reports from cells


def _money(cells: DataFrame, key, name: str) -> DataFrame:
    amount = F.sum("amount")
    return cells.groupBy(key).agg(
        F.sum("n_orders").alias("total_orders"),
        F.when(F.sum("n_amounts") > 0, amount).alias(name),
        F.when(F.sum("n_amounts") > 0, (amount / F.sum("n_amounts")).cast("decimal(14,6)")).alias("average_order_value"),
    )


def daily_orders(cells: DataFrame, k: int = 30) -> DataFrame:
    """r04_daily_orders from day cells."""
    return _money(cells, F.col("order_day"), "daily_revenue").orderBy(F.desc("order_day")).limit(k)


def monthly_orders(cells: DataFrame) -> DataFrame:
    """r05_monthly_orders from day cells."""
    return _money(cells, month_of("order_day").alias("order_month"), "monthly_revenue").orderBy(F.desc("order_month"))


def revenue_by_month(cells: DataFrame) -> DataFrame:
    """r17_revenue_by_month from day cells."""
    monthly = _money(cells.filter("NOT cancelled"), month_of("order_day").alias("order_month"), "revenue")
    previous = F.lag("revenue").over(Window.orderBy("order_month"))
    return monthly.withColumn("previous", previous).select(
        "order_month", F.round("revenue", 2).alias("revenue"), F.round("previous", 2).alias("previous_month_revenue"),
        pct(F.col("revenue") - F.col("previous"), "previous").alias("mom_growth_percentage"),
    ).orderBy(F.desc("order_month"))


def category_sales(cells: DataFrame, categories: DataFrame) -> DataFrame:
    """v_category_sales from category cells."""
    money = F.when(F.col("n_revenue") > 0, F.col("revenue"))
    profit = F.when(F.col("n_profit") > 0, F.col("profit"))
    return categories.select("category_id", "category_name").join(cells, "category_id").select(
        "category_id", "category_name", F.col("n_orders").alias("total_orders"), F.col("units").alias("total_units_sold"),
        money.alias("gross_revenue"), F.col("cost").alias("total_cost"), profit.alias("net_profit"),
        pct(profit, money).alias("profit_margin_percentage"),
    )
