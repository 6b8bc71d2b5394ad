"""Distinct orders as sketches that are stored per day and category and merged for any question.

A sketch has a fixed size whatever it has counted; merging the sketches of any days and categories
gives what one sketch over all their rows would give, so an order with lines in several categories
counts once in a total. The exact counts of the views and reports do not use them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.operators.views import live_lines, live_orders
from stockloom.plans.lookup import lookup_join

LOG_SLOTS = 12
#: Relative standard error of a merged sketch of 2 ** LOG_SLOTS slots, and three times that.
ERROR = 1.04 / 2 ** (LOG_SLOTS / 2)
BOUND = 3 * ERROR


def order_sketches(products: DataFrame, order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """(order_day, category_id, orders): a sketch of the live orders with lines of the category.

    Lines of products without a category are under a null category.
    """
    days = live_orders(orders).select("order_id", F.to_date("order_date").alias("order_day"))
    lines = lookup_join(
        live_lines(order_items, orders).select("order_id", "product_id"),
        products.select("product_id", "category_id"), "product_id")
    # One row per order and category before the days are joined.
    pairs = lines.select("order_id", "category_id").distinct().join(days, "order_id")
    return pairs.groupBy("order_day", "category_id").agg(
        F.hll_sketch_agg("order_id", LOG_SLOTS).alias("orders"))


def merged(*sketches: DataFrame) -> DataFrame:
    """Stored sketches with those of new days or rows put in."""
    rows = sketches[0]
    for more in sketches[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("order_day", "category_id").agg(F.hll_union_agg("orders").alias("orders"))


def distinct_orders(sketches: DataFrame, *by) -> DataFrame:
    """Estimated distinct orders per group of days and categories, e.g. by category, or of all."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("orders")).alias("orders"))
