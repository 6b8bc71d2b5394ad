"""Product, stock, order and staff lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom.functions.scalars import (
    available, customer_name, full_name, location_label, or_zero,
)
from stockloom.operators.views import stock_by_product
from stockloom.plans.lookup import fits_broadcast, heavy_hashes, lookup_join
from stockloom.plans.scan import BLOCK, running, with_blocks
from stockloom.plans.scratch import Scratch

BINS_TOGETHER = 8
ORDER_PARTS = 100_000  # beyond which an order is numbered in blocks


def stock_summary(inventory: DataFrame, product_ids: DataFrame) -> DataFrame:
    """Stock of each asked product, zeros where there is none.

    The ids restrict the stock rows before they are added up.
    """
    asked = product_ids.select("product_id").distinct()
    stock = stock_by_product(inventory.join(asked, "product_id", "left_semi"))
    return asked.join(stock, "product_id", "left").select(
        "product_id",
        or_zero("on_hand").alias("total_on_hand"),
        or_zero("reserved").alias("total_reserved"),
        or_zero("available").alias("total_available"),
    )


def inventory_valuation(inventory: DataFrame, products: DataFrame) -> DataFrame:
    """Total stock value and possible profit, zeros without stock."""
    stock = inventory.groupBy("product_id").agg(F.sum("quantity_on_hand").alias("on_hand"))
    priced = stock.join(products.select("product_id", "cost_price", "sale_price"), "product_id")
    units = F.col("on_hand")
    return priced.agg(
        or_zero(F.sum(units * F.col("cost_price"))).alias("total_inventory_cost"),
        or_zero(F.sum(units * F.col("sale_price"))).alias("total_inventory_retail"),
        or_zero(F.sum(units * (F.col("sale_price") - F.col("cost_price"))))
        .alias("potential_profit"),
    )


def search_products(
    products: DataFrame, categories: DataFrame, inventory: DataFrame, term: str
) -> DataFrame:
    """Products whose name, SKU or category contains the term, in any case.

    ``%`` and ``_`` in the term are wildcards. Stock is added up for the found products
    only.
    """
    pattern = f"%{term}%"
    named = lookup_join(
        products.select("product_id", "sku", "product_name", "category_id", "sale_price"),
        categories.select("category_id", "category_name"),
        "category_id", "left"
    )
    found = named.filter(
        F.col("product_name").ilike(pattern)
        | F.col("sku").ilike(pattern)
        | F.col("category_name").ilike(pattern)
    )
    stock = inventory.groupBy("product_id").agg(F.sum("quantity_on_hand").alias("on_hand"))
    return found.join(stock, "product_id", "left").select(
        "product_id", "sku", "product_name", "category_name", "sale_price",
        or_zero("on_hand").alias("quantity_on_hand"),
    )


def order_lookup(
    orders: DataFrame, order_items: DataFrame, customers: DataFrame, products: DataFrame,
    order_ids: DataFrame,
) -> DataFrame:
    """Lines of the asked orders, each with its order's header; one row without line
    columns for an order that has no lines.

    Lines stay rows: an order of any size is never packed into one value.
    """
    asked = order_ids.select("order_id").distinct()
    header = (
        orders.select("order_id", "customer_id", "status", "total_amount", "order_date")
        .join(asked, "order_id", "left_semi")
        .join(
            customers.select(
                "customer_id", customer_name(customers.columns).alias("customer_name")
            ),
            "customer_id",
        )
        .drop("customer_id")
    )
    lines = order_items.select(
        "order_id", "product_id", "quantity", "unit_price", "item_status"
    ).join(asked, "order_id", "left_semi")
    named = lookup_join(
        lines, products.select("product_id", "sku", "product_name"), "product_id"
    )
    # An inner join can be split at run time on the side of the lines, an outer join that
    # keeps the headers cannot; headers without lines are added on their own.
    filled = header.join(named.drop("product_id"), "order_id")
    with_lines = named.select("order_id").distinct()
    empty = header.join(with_lines, "order_id", "left_anti")
    return filled.unionByName(empty, allowMissingColumns=True).select(
        "order_id", "customer_name", "status", "total_amount", "order_date", "sku",
        "product_name", "quantity", "unit_price", "item_status",
    )


def low_stock(products: DataFrame, inventory: DataFrame, threshold: int = 15) -> DataFrame:
    """Products with free stock at or below one threshold for all."""
    return (
        products.select("product_id", "sku", "product_name")
        .join(stock_by_product(inventory).select("product_id", "available"), "product_id", "left")
        .withColumn("qty_available", or_zero("available"))
        .filter(F.col("qty_available") <= threshold)
        .select("product_id", "sku", "product_name", "qty_available")
    )


def in_stock_products(inventory: DataFrame, products: DataFrame, min_qty: int = 5) -> DataFrame:
    """Products with more than ``min_qty`` units in at least one bin."""
    stocked = inventory.filter(F.col("quantity_on_hand") > min_qty).select("product_id")
    return products.select("product_id", "sale_price").join(
        stocked.distinct(), "product_id", "left_semi"
    )


def pick_rows(
    order_ids: DataFrame, order_items: DataFrame, products: DataFrame, inventory: DataFrame,
    locations: DataFrame,
) -> DataFrame:
    """Order lines with every bin that has reserved stock of their product.

    Each bin repeats the whole line quantity, and the reservation need not be this order's.
    """
    return lookup_join(
        _named_lines(order_ids, order_items, products), _reserved_bins(inventory, locations), "product_id")


def _named_lines(order_ids: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    return lookup_join(
        _asked_lines(order_ids, order_items), products.select("product_id", "sku", "product_name"), "product_id"
    )


def _asked_lines(order_ids: DataFrame, order_items: DataFrame) -> DataFrame:
    extra = ["order_item_id"] if "order_item_id" in order_items.columns else []
    return order_items.select(*extra, "order_id", "product_id", "quantity").join(
        order_ids.select("order_id").distinct(), "order_id", "left_semi"
    )


def _reserved_bins(inventory: DataFrame, locations: DataFrame) -> DataFrame:
    return lookup_join(
        inventory.filter("quantity_reserved > 0").select("product_id", "location_id"),
        locations.select("location_id", "zone", "aisle", "shelf", "bin"),
        "location_id"
    )


def pick_list(
    order_ids: DataFrame, order_items: DataFrame, products: DataFrame, inventory: DataFrame,
    locations: DataFrame,
) -> DataFrame:
    """Pick rows numbered along the path (zone, aisle, shelf, bin) of their order.

    A line travels with up to BINS_TOGETHER of its bins and becomes one row per bin where its
    order is numbered. Orders of more than ORDER_PARTS such parts are numbered by running counts
    over sorted blocks, so an order of any size is spread over many tasks.
    """
    spark = order_ids.sparkSession
    places = locations.select("location_id", "zone", "aisle", "shelf", "bin")
    # Places that can be broadcast are looked up where the order is numbered: bins travel as ids.
    late = fits_broadcast(places)
    bins = (inventory.filter("quantity_reserved > 0").select("location_id", "product_id") if late
            else _reserved_bins(inventory, locations)).filter("product_id IS NOT NULL")
    number = F.row_number().over(Window.partitionBy("product_id").orderBy("location_id"))
    columns = [c for c in bins.columns if c != "product_id"]
    together = bins.withColumn("_part", F.floor((number - 1) / BINS_TOGETHER)).groupBy("product_id", "_part").agg(
        F.collect_list(F.struct(*columns) if len(columns) > 1 else F.col(*columns)).alias("_bins")).drop("_part")
    # Read several times each: sketched, joined and numbered.
    scratch, tables = Scratch(spark, "pick_list"), Scratch(spark, "pick_list_sides")
    together = tables.keep(together)
    named = tables.keep(lookup_join(together, products.select("product_id", "sku", "product_name"), "product_id").select(
        "product_id", "sku", "product_name", "_bins"))
    lines = tables.keep(_asked_lines(order_ids, order_items))
    parts = scratch.keep(lookup_join(lines, named, "product_id"))
    tables.remove()

    def rows_of(some: DataFrame) -> DataFrame:
        line = [c for c in some.columns if c != "_bins"]
        if late:
            rows = some.select(*line, F.explode("_bins").alias("location_id")).join(F.broadcast(places), "location_id")
            return rows.select(*line, *places.columns)
        return some.select(*line, F.explode("_bins").alias("_bin")).select(
            *line, *[F.col(f"_bin.{c}").alias(c) for c in columns])

    path = ["zone", "aisle", "shelf", "bin", "location_id", "product_id", "quantity"]
    path += ["order_item_id"] if "order_item_id" in parts.columns else []
    before = Window.partitionBy("order_id").orderBy(*path).rowsBetween(Window.unboundedPreceding, -1)
    hot = heavy_hashes(parts, "order_id", ORDER_PARTS)
    place = F.xxhash64("order_id") == F.col("_hot") if hot is not None else None
    plain = parts if hot is None else parts.join(F.broadcast(hot), place, "left_anti")
    counted = rows_of(plain.repartition("order_id")).withColumn("rows_before", F.count(F.lit(1)).over(before))
    if hot is not None:
        large = with_blocks(rows_of(parts.join(F.broadcast(hot), place, "left_semi")), ["order_id", *path])
        counted = counted.unionByName(
            running(large, ["order_id"], path, sums={"rows_before": F.lit(1)}).drop(BLOCK))
    return counted.select(
        *[c for c in counted.columns if c != "rows_before"], location_label().alias("label"),
        (F.col("rows_before") + 1).alias("pick_sequence"),
    )


def pick_list_reserved(allocations: DataFrame, products: DataFrame, locations: DataFrame) -> DataFrame:
    """Pick rows from what a reservation really took: one row per order, product and bin.

    allocations: order_id, product_id, location_id, quantity, as ``op_reserve`` returns them.
    The number of rows is that of the allocations, whatever else the bins hold.
    """
    named = lookup_join(
        allocations.select("order_id", "product_id", "location_id", "quantity"),
        products.select("product_id", "sku", "product_name"), "product_id",
    )
    return lookup_join(
        named, locations.select("location_id", "zone", "aisle", "shelf", "bin"), "location_id"
    ).withColumn("label", location_label())


def active_staff(employees: DataFrame, role: str) -> DataFrame:
    return employees.filter((F.col("role") == role) & (F.col("status") == "Active")).select(
        "employee_id", "first_name", "last_name", full_name().alias("full_name"), "role"
    )


def with_available(inventory: DataFrame) -> DataFrame:
    return inventory.withColumn("quantity_available", available())
