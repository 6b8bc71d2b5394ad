"""Every operator as a query over one data folder.

A query takes (spark, folder), builds the warehouse tables from the driver's tables and runs
one operator on all their rows. Request tables for the stock rules are derived from the
order tables, so they grow with them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.operators import (
    chain, constraints, divergence, increments, kpis, lifecycle, lookups, measures, moves, occupancy, orders, putaway,
    reports, reserve, returning, search, sessions, sketches, views,
)
from stockloom.schema import ENUMS, SCHEMAS
from stockloom.session import scratch_path, spread
from stockloom.sources import quarantine, sinks, tables
from stockloom.sources.stock_store import StockStore
from stockloom.sources.warehouse import DRIVER_SCHEMAS, Warehouse
from stockloom.streaming import exact_occupancy

# The end of the order dates in the driver's tables; "recent" is counted back from here.
AS_OF = datetime(2001, 8, 1)

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """The result in types that read the same from any engine.

    Integers as BIGINT, exact decimals and doubles as DOUBLE rounded to 6 digits, dates as
    text. Doubles are rounded as decimals, so a tie has one answer.
    """

    def plain(field: T.StructField):
        column = F.col(field.name)
        kind = field.dataType
        if isinstance(kind, T.IntegerType):
            return column.cast("bigint")
        if isinstance(kind, T.DecimalType):
            return F.round(column, 6).cast("double")
        if isinstance(kind, T.DoubleType):
            return F.round(column.cast("decimal(38,9)"), 6).cast("double")
        if isinstance(kind, T.DateType):
            return column.cast("string")
        return column

    return df.select(*[plain(f).alias(f.name) for f in df.schema])


# Table of the data model -> name of its derivation.
DERIVATIONS = {
    "categories": "categories", "suppliers": "suppliers", "products": "products",
    "customers": "customers", "employees": "employees",
    "warehouse_locations": "warehouse_locations", "inventory": "inventory",
    "orders": "wh_orders", "order_items": "order_items", "shipments": "shipments",
    "returns": "returns_", "transactions": "transactions",
}
KPI_TABLES = [
    "orders", "order_items", "products", "inventory", "warehouse_locations", "shipments",
    "returns", "suppliers", "transactions",
]


def base_tables(w: Warehouse, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The derived tables under the names of the data model."""
    return {name: getattr(w, DERIVATIONS[name]) for name in names or DERIVATIONS}


# ---- request tables -------------------------------------------------------------------


def order_requests(w: Warehouse) -> DataFrame:
    """One request per order, numbered by the order id."""
    return w.wh_orders.select("order_id", F.col("order_id").alias("seq"))


def receipts(w: Warehouse) -> DataFrame:
    """One supplier receipt per order row: 1 to 500 units; some name unknown products."""
    key = F.col("o_orderkey")
    return w.driver("orders").select(
        key.alias("seq"),
        (key % 13).alias("supplier_id"),
        (F.col("o_custkey") + (key % 7) * 100).alias("product_id"),
        (F.floor(F.col("o_totalprice") / 1000) + 1).cast("int").alias("qty"),
        F.concat(F.lit("RECV-"), key.cast("string")).alias("reference_id"),
        (key % 20 != 0).alias("qa_passed"),
        (key % 25).alias("receiver_id"),
        ((key + 1) % 25).alias("inspector_id"),
    )


def put_away_receipts(w: Warehouse) -> DataFrame:
    return receipts(w).select(
        "seq", "product_id", "qty", F.col("receiver_id").alias("employee_id"), "reference_id"
    )


def return_requests(w: Warehouse) -> DataFrame:
    """Two requests per order: its first product, often more than bought, then its last."""
    per_order = w.order_items.groupBy("order_id").agg(
        F.min("product_id").alias("first_product"), F.max("product_id").alias("last_product"),
        F.min("quantity").alias("smallest"),
    )
    # Return reasons.
    reasons = F.array(
        *[
            F.lit(r)
            for r in (
                "Damaged", "Defective", "Incorrect Item", "Not as Described", "Buyer Remorse",
            )
        ]
    )
    by_order = F.element_at(reasons, (F.col("order_id") % 5 + 1).cast("int"))
    pair = F.array(
        F.struct(
            F.col("order_id").alias("seq"), F.col("first_product").alias("product_id"),
            (F.col("smallest") + 1).alias("qty"),
        ),
        F.struct(
            (F.col("order_id") + F.lit(10**12)).alias("seq"),
            F.col("last_product").alias("product_id"), F.lit(1).alias("qty"),
        ),
    )
    return per_order.select(
        "order_id", F.explode(pair).alias("r"), by_order.alias("reason")
    ).select(
        "order_id", "r.seq", "r.product_id", "r.qty", "reason",
        F.lit("2001-08-01 00:00:00").cast("timestamp_ntz").alias("return_date"),
    )


def ship_requests(w: Warehouse) -> DataFrame:
    key = F.col("order_id")
    # Carriers.
    carriers = F.array(*[F.lit(c) for c in ("FedEx", "UPS", "DHL", "USPS")])
    return w.wh_orders.select(
        key, key.alias("seq"),
        F.element_at(carriers, (key % 4 + 1).cast("int")).alias("carrier"),
        ((key % 3000) / 100 + 5).cast("decimal(10,2)").alias("shipping_cost"),
        F.concat(F.lit("TRK"), (key + 1000000000).cast("string")).alias("tracking_number"),
        F.lit("2001-08-01 00:00:00").cast("timestamp_ntz").alias("ship_date"),
    )


def move_requests(w: Warehouse) -> DataFrame:
    """Every stocked bin asks to move most of its stock to the next location.

    Sequence numbers interleave the products; a location id takes the last six digits.
    """
    free = F.col("quantity_on_hand") - F.col("quantity_reserved")
    return w.inventory.filter("quantity_on_hand > 0").select(
        "product_id", F.col("location_id").alias("from_location"),
        (F.col("location_id") + 1).alias("to_location"),
        (free + F.col("product_id") % 3 - 1).cast("int").alias("qty"),
        (F.col("product_id") % 25).alias("employee_id"),
        (F.col("product_id") * 1000000 + F.col("location_id")).alias("seq"),
    )


def change_rows(events: DataFrame) -> DataFrame:
    """Stock changes read off the event rows; signups are deletions."""
    units = F.floor(F.col("value") * 10).cast("bigint")
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").alias("change_id"), F.col("ts").alias("changed_at"),
        F.col("user_id").alias("location_id"),
        F.when(kind.isin("signup", "error"), units).otherwise(F.lit(0)).alias("old_total"),
        F.when(kind == "signup", F.lit(0)).when(kind == "error", units * 2).otherwise(units)
        .alias("new_total"),
    )


# Search terms with and without wildcards, one too short for a trigram.
SEARCH_TERMS = ["RED", "b%lt", "_ld r", "od", "prod-1_9", "Brand#2", "g__mo", "no such thing"]


def search_products_indexed(spark: SparkSession, w: Warehouse) -> DataFrame:
    """Every term through a stored index."""
    index = search.ProductIndex(spark, scratch_path(spark, "search")).build(w.products, w.categories)
    out = None
    for term in SEARCH_TERMS:
        found = index.search(term, w.inventory).withColumn("term", F.lit(term))
        out = found if out is None else out.unionByName(found)
    return out


def order_changes(w: Warehouse) -> tuple[tuple[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]:
    """(lines, orders) before and after a change: of ten orders one is cancelled, one deleted and one
    ordered again under a new, negative number."""
    last, again = F.col("order_id") % 10, (-1 - F.col("order_id")).alias("order_id")

    def touched(rows: DataFrame, *digits: int) -> DataFrame:
        return rows.filter(last.isin(*digits))

    def repeated(rows: DataFrame) -> DataFrame:
        rows = touched(rows, 1)
        return rows.select(*[again if c == "order_id" else F.col(c) for c in rows.columns])

    before = touched(w.order_items, 3, 7), touched(w.wh_orders, 3, 7)
    cancelled = touched(w.wh_orders, 3).withColumn("status", F.lit("Cancelled"))
    after = (touched(w.order_items, 3).unionByName(repeated(w.order_items)),
             cancelled.unionByName(repeated(w.wh_orders)))
    return before, after


def _days_refreshed(w: Warehouse) -> DataFrame:
    before, after = order_changes(w)
    return increments.refreshed_days(increments.day_cells(w.wh_orders), before[1], after[1])


def _categories_refreshed(w: Warehouse) -> DataFrame:
    cells = increments.category_cells(w.products, w.order_items, w.wh_orders)
    cells = increments.refreshed_categories(cells, w.products, *order_changes(w))
    return increments.category_sales(cells, w.categories)


def bin_entries(w: Warehouse) -> DataFrame:
    """A ledger with times: odd lines come into the bin of their supplier, even ones go out."""
    signed = F.when(F.col("l_linenumber") % 2 == 1, F.col("l_quantity")).otherwise(-F.col("l_quantity"))
    return w.driver("lineitem").select(
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("location_id"),
        F.col("l_shipdate").alias("at"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("entry_id"),
        signed.cast("bigint").alias("amount"))


def bin_counts(w: Warehouse) -> DataFrame:
    """Every bin counted three times; of seven bins one is off by a unit from the second count on."""
    times = [f"{year}-07-01 00:00:00" for year in (1996, 1998, 2000)]
    upto = [F.sum(F.when(F.col("at") <= F.lit(t).cast("timestamp_ntz"), F.col("amount")).otherwise(0)) for t in times]
    off = F.when((F.col("product_id") + F.col("location_id")) % 7 == 0, 1).otherwise(0)
    per_bin = bin_entries(w).groupBy("product_id", "location_id").agg(
        *[x.alias(f"q{i}") for i, x in enumerate(upto)])
    rows = F.array(*[F.struct(F.lit(t).cast("timestamp_ntz").alias("at"),
                              (F.col(f"q{i}") + (off if i else F.lit(0))).alias("quantity_on_hand"))
                     for i, t in enumerate(times)])
    return per_bin.select("product_id", "location_id", F.explode(rows).alias("c")).select(
        "product_id", "location_id", "c.*")


def sink_ledger_months(spark: SparkSession, w: Warehouse) -> DataFrame:
    """The timed ledger written by month, 1997 written again with all quantities doubled; what the
    first quarters of the years hold, read through a table of months."""
    path = scratch_path(spark, "months")
    rows = bin_entries(w).withColumn(
        "transaction_type", F.when(F.col("amount") > 0, "RECEIVING").otherwise("SHIPPING"))
    sinks.replace_ledger_months(rows, path)
    again = rows.filter(F.year("at") == 1997).withColumn("amount", F.col("amount") * 2)
    for _ in range(2):
        sinks.replace_ledger_months(again, path)
    stored = spark.read.schema(
        "product_id bigint, location_id bigint, at timestamp_ntz, entry_id bigint, amount bigint, "
        "transaction_type string, month string").parquet(path)
    months = spark.range(1990 * 12, 2003 * 12).select(
        F.format_string("%04d-%02d", F.floor(F.col("id") / 12), F.col("id") % 12 + 1).alias("month"),
        (F.col("id") % 12).alias("place")).filter("place < 3")
    return sinks.ledger_of_months(stored, months).groupBy("transaction_type", "month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("amount").alias("units"))


def v_category_orders_sketched(w: Warehouse) -> DataFrame:
    """Distinct orders per category, and whether the merged sketches of its days are near them."""
    found = sketches.distinct_orders(
        sketches.order_sketches(w.products, w.order_items, w.wh_orders), "category_id"
    ).withColumnRenamed("orders", "estimate")
    exact = views.v_category_sales(w.categories, w.products, w.order_items, w.wh_orders)
    off = F.abs(F.col("estimate") - F.col("total_orders")) / F.col("total_orders")
    return exact.join(found, "category_id").select(
        "category_id", "total_orders", (off <= sketches.BOUND).alias("within_bound"))


def src_quarantine(spark: SparkSession, w: Warehouse) -> DataFrame:
    """Orders written as text with rows that do not fit, read back from CSV and Parquet."""
    key, last = F.col("order_id"), F.col("order_id") % 50
    rows = w.wh_orders.select(
        F.when(last == 0, F.concat(F.lit("no. "), key)).otherwise(key.cast("string")).alias("order_id"),
        F.when(last == 1, "Pending,again").otherwise(F.col("status")).alias("status"),
        F.when(last.isin(0, 2), "soon").otherwise(F.col("order_date").cast("string")).alias("order_date"),
        F.when(last == 3, F.lit(None)).otherwise(F.col("total_amount").cast("string")).alias("total_amount"),
        F.lit("x").alias("note"))
    out = None
    for fmt in ("csv", "parquet"):
        path = scratch_path(spark, f"orders-{fmt}")
        writer = rows.write.option("header", "true").option("quote", "") if fmt == "csv" else rows.write
        writer.format(fmt).save(path)
        read = quarantine.load_checked(spark, path, "orders", fmt)
        good = read.good.agg(F.lit("orders").alias("table_name"), F.lit("good").alias("reason"),
                             F.count(F.lit(1)).alias("n_rows"))
        drift = read.drift.filter("problem <> 'type'").select(
            F.lit("orders").alias("table_name"), F.concat_ws(" ", "problem", "column").alias("reason"),
            F.lit(0).cast("bigint").alias("n_rows"))
        found = read.report().unionByName(good).unionByName(drift).withColumn("fmt", F.lit(fmt))
        out = found if out is None else out.unionByName(found)
    return out


def stream_occupancy(spark: SparkSession, sf_dir: str, files: int = 1000) -> DataFrame:
    """The event rows read as a stream, ``files`` at a time, folded into totals per location.

    Files are read in any order of time, so no change is ever too late.
    """
    # As a pattern, the path may be one file or a folder of part files; a plain one is a folder.
    reader = spark.readStream.schema(DRIVER_SCHEMAS["events"]).option("maxFilesPerTrigger", files)
    events = reader.parquet(f"{sf_dir}/events.parque[t]")
    return exact_occupancy.run_to_end(change_rows(events))


# ---- sinks: write below the shared folder, read back, report what arrived ---------------


def _arrived(frames: dict[str, DataFrame]) -> DataFrame:
    reports_ = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("extract"), "n_rows")
        for n, df in frames.items()
    ]
    out = reports_[0]
    for report in reports_[1:]:
        out = out.unionByName(report)
    return out


def sink_base_csv(spark: SparkSession, w: Warehouse) -> DataFrame:
    frames = base_tables(w, sinks.BASE_EXTRACTS)
    tables.require_nonempty(orders=frames["orders"], products=frames["products"])
    paths = sinks.export_csv(frames, scratch_path(spark, "base"), sinks.BASE_EXTRACTS)
    return _arrived(
        {
            n: spark.read.schema(frames[n].schema).option("header", "true").csv(p)
            for n, p in paths.items()
        }
    )


def sink_kpi_csv(spark: SparkSession, w: Warehouse) -> DataFrame:
    frames = kpis.kpi_extracts(base_tables(w, KPI_TABLES))
    paths = sinks.export_csv(frames, scratch_path(spark, "kpi"), sinks.KPI_EXTRACTS)
    return _arrived(
        {
            n: spark.read.schema(frames[n].schema).option("header", "true").csv(p)
            for n, p in paths.items()
        }
    )


def sink_append_ledger(spark: SparkSession, w: Warehouse) -> DataFrame:
    """Two batches, one of them written twice, read back per batch and type."""
    path = scratch_path(spark, "ledger")
    events = orders.op_ledger_from_orders(w.wh_orders, w.order_items)
    for batch, rows in (("1", w.transactions), ("2", events), ("2", events)):
        sinks.append_ledger(rows, path, batch)
    stored = spark.read.option("basePath", path).parquet(f"{path}/batch_id=*")
    return stored.groupBy(
        F.col("batch_id").cast("bigint").alias("batch_id"), "transaction_type"
    ).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("quantity").alias("units"))


def supplied(w: Warehouse) -> DataFrame:
    """Every ledgered line put into the bin of its supplier."""
    return w.driver("lineitem").select(
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("location_id"),
        F.col("l_quantity").cast("int").alias("quantity_on_hand"), F.col("l_orderkey"),
    )


def sink_upsert_inventory(spark: SparkSession, w: Warehouse) -> DataFrame:
    """The lines merged into the versioned stock as one change, read back at its version."""
    store = StockStore(spark, scratch_path(spark, "inventory"))
    store.create(w.inventory)
    made = store.merge(supplied(w), "lines")
    return store.stock(made.version)


def sink_stock_versions(spark: SparkSession, w: Warehouse) -> DataFrame:
    """Three changes with their ledger rows, the second one sent twice; what each version holds.

    First the lines of every fifth order come in, then those of the others, then all shipments
    of the stock rules go out.
    """
    store = StockStore(spark, scratch_path(spark, "versions"))
    store.create(w.inventory)
    lines, fifth = supplied(w), F.col("l_orderkey") % 5 == 0
    shipped = _ship(w)
    for batch, delta in (("a", lines.filter(fifth)), ("b", lines.filter(~fifth)), ("b", lines.filter(~fifth)),
                         ("c", shipped.changes["inventory_delta"])):
        ledger = delta.select(F.lit("RECEIVING").alias("transaction_type"), "product_id", "location_id",
                              F.col("quantity_on_hand").cast("bigint").alias("quantity"))
        store.merge(delta, batch, ledger)
    held = None
    for version in store.versions():
        rows = store.stock(version).agg(
            F.lit(version).cast("bigint").alias("version"), F.count(F.lit(1)).alias("n_bins"),
            F.sum("quantity_on_hand").alias("on_hand"), F.sum("quantity_reserved").alias("reserved"))
        held = rows if held is None else held.unionByName(rows)
    entries = store.ledger().groupBy("version").agg(
        F.count(F.lit(1)).alias("ledger_rows"), F.sum("quantity").alias("ledger_units"))
    return held.join(entries, "version", "left")


def src_table(spark: SparkSession, w: Warehouse) -> DataFrame:
    """Tables written as Parquet and read back through the schema-checked loader."""
    root = scratch_path(spark, "tables")
    frames = {n: df for n, df in base_tables(w).items() if n != "categories"}
    for name, df in frames.items():
        typed = df.select(
            *[F.col(f.name).cast(f.dataType) for f in SCHEMAS[name] if f.name in df.columns]
        )
        typed.write.parquet(f"{root}/{name}")
    return _arrived(tables.load(spark, root, tables=list(frames)))


# ---- registry ---------------------------------------------------------------------------


def _on_warehouse(build: Callable[[Warehouse], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(Warehouse(spread(spark), sf_dir)))

    return run


def _with_spark(build: Callable[[SparkSession, Warehouse], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(spread(spark), Warehouse(spark, sf_dir)))

    return run


def _stock_ids(w: Warehouse) -> DataFrame:
    """All part keys and as many that do not exist."""
    part = w.driver("part").select(F.col("p_partkey").alias("product_id"))
    return part.unionByName(part.select((-F.col("product_id") - 1).alias("product_id")))


def _unposted(w: Warehouse) -> DataFrame:
    """The ledger with shipments and moves that the stock does not show yet."""
    w.store("inventory")
    return (
        w.transactions.unionByName(_ship(w).ledger, allowMissingColumns=True)
        .unionByName(_move(w).ledger, allowMissingColumns=True)
    )


def _staff(w: Warehouse) -> DataFrame:
    roles = ENUMS[("employees", "role")]
    out = lookups.active_staff(w.employees, roles[0])
    for role in roles[1:]:
        out = out.unionByName(lookups.active_staff(w.employees, role))
    return out


def _ledger_reserve(w: Warehouse):
    asked = order_requests(w).withColumn("employee_id", (F.col("order_id") % 25).cast("int"))
    w.store("inventory")  # read by the decisions and by the allocation
    return reserve.op_reserve(asked, w.order_items, w.inventory)


def _put_away(w: Warehouse):
    return putaway.op_put_away(put_away_receipts(w), w.warehouse_locations)


def _receive(w: Warehouse):
    return putaway.op_receive(receipts(w), w.suppliers, w.products, w.warehouse_locations)


def _complete_pick(w: Warehouse):
    asked = order_requests(w).select("order_id")
    return lifecycle.op_complete_pick(
        asked, w.wh_orders, w.order_items, w.products, w.inventory, w.warehouse_locations
    )


def _pack(w: Warehouse):
    asked = order_requests(w).withColumn("employee_id", F.col("order_id") % 25)
    return lifecycle.op_pack(asked, w.wh_orders, w.order_items)


def _ship(w: Warehouse):
    return lifecycle.op_ship(ship_requests(w), w.wh_orders, w.order_items, w.inventory)


def _deliver(w: Warehouse):
    asked = order_requests(w).withColumn(
        "delivery_date", F.lit("2001-08-05 00:00:00").cast("timestamp_ntz")
    )
    return lifecycle.op_deliver(asked, w.shipments, w.order_items)


def _return(w: Warehouse):
    return returning.op_return(return_requests(w), w.wh_orders, w.order_items, w.inventory)


def _move(w: Warehouse):
    w.store("inventory")  # read by the requests, as stock and as space taken
    return moves.op_move_stock(move_requests(w), w.inventory, w.warehouse_locations)


def _chain(w: Warehouse) -> chain.Fulfilled:
    """Pending orders reserved and picked; all that can be are packed, shipped and delivered."""
    key = F.col("order_id")
    asked = w.wh_orders.filter("status = 'Pending'").select(
        "order_id", key.alias("seq"), (key % 25).alias("employee_id"))
    sent = ship_requests(w).select(
        "*", (key % 25).alias("employee_id"),
        F.lit("2001-08-05 00:00:00").cast("timestamp_ntz").alias("delivery_date"))
    w.store("inventory", "order_items")
    return chain.fulfil(chain.Tables(w.wh_orders, w.order_items, w.inventory, w.shipments), asked, sent)


_DECISION = ["seq", "accepted"]


def registry() -> dict[str, Query]:
    plain: dict[str, Callable[[Warehouse], DataFrame]] = {
        # views
        "v_inventory_utilization": lambda w: views.v_inventory_utilization(w.warehouse_locations),
        "v_low_stock_alerts": lambda w: views.v_low_stock_alerts(
            w.products, w.categories, w.inventory
        ),
        "v_order_fulfillment_kpis": lambda w: views.v_order_fulfillment_kpis(
            w.wh_orders, w.shipments
        ),
        "v_employee_productivity": lambda w: views.v_employee_productivity(
            w.employees, w.wh_orders, w.transactions
        ),
        "v_category_sales": lambda w: views.v_category_sales(
            w.categories, w.products, w.order_items, w.wh_orders
        ),
        "v_inventory_value_by_location": lambda w: views.v_inventory_value_by_location(
            w.inventory, w.warehouse_locations, w.products
        ),
        # reports
        "r01_top_products": lambda w: reports.r01_top_products(
            w.order_items, w.products, w.categories, w.wh_orders
        ),
        "r02_lowest_inventory": lambda w: reports.r02_lowest_inventory(w.products, w.inventory),
        "r03_inventory_value": lambda w: reports.r03_inventory_value(
            w.inventory, w.products, w.categories
        ),
        "r04_daily_orders": lambda w: reports.r04_daily_orders(w.wh_orders),
        "r05_monthly_orders": lambda w: reports.r05_monthly_orders(w.wh_orders),
        "r06_fulfillment_rate": lambda w: reports.r06_fulfillment_rate(w.wh_orders),
        "r07_avg_shipping_time": lambda w: reports.r07_avg_shipping_time(w.shipments),
        "r08_employee_productivity": lambda w: reports.r08_employee_productivity(
            w.employees, w.wh_orders
        ),
        "r09_warehouse_utilization": lambda w: reports.r09_warehouse_utilization(
            w.warehouse_locations
        ),
        "r10_supplier_performance": lambda w: reports.r10_supplier_performance(
            w.suppliers, w.products, w.transactions
        ),
        "r10_supplier_performance_exact": lambda w: reports.r10_supplier_performance(
            w.suppliers, w.products, w.transactions, exact=True
        ),
        "r11_return_percentage": lambda w: reports.r11_return_percentage(
            w.categories, w.products, w.order_items, w.returns_
        ),
        "r12_category_sales": lambda w: reports.r12_category_sales(
            w.categories, w.products, w.order_items, w.wh_orders
        ),
        "r13_fast_movers": lambda w: reports.r13_fast_movers(
            w.products, w.categories, w.order_items, w.wh_orders, AS_OF
        ),
        "r14_slow_movers": lambda w: reports.r14_slow_movers(
            w.products, w.categories, w.inventory, w.order_items, w.wh_orders, AS_OF
        ),
        "r14_slow_movers_deduped": lambda w: reports.r14_slow_movers(
            w.products, w.categories, w.inventory, w.order_items, w.wh_orders, AS_OF,
            deduped=True,
        ),
        "r15_inventory_turnover": lambda w: reports.r15_inventory_turnover(
            w.categories, w.products, w.order_items, w.wh_orders, w.inventory
        ),
        "r16_customer_frequency": lambda w: reports.r16_customer_frequency(
            w.customers, w.wh_orders
        ),
        "r17_revenue_by_month": lambda w: reports.r17_revenue_by_month(w.wh_orders),
        "r18_top_customers": lambda w: reports.r18_top_customers(
            w.customers, w.wh_orders, w.order_items, w.products, w.categories
        ),
        "r19_most_returned": lambda w: reports.r19_most_returned(
            w.returns_, w.products, w.categories
        ),
        "r20_shipping_delays": lambda w: reports.r20_shipping_delays(w.wh_orders, w.shipments),
        # key figures
        "k_aov": lambda w: kpis.k_aov(w.wh_orders),
        "k_inventory_accuracy": lambda w: kpis.k_inventory_accuracy(w.inventory, w.transactions),
        "k_inventory_accuracy_by_product": lambda w: kpis.inventory_accuracy_by_product(
            w.inventory, w.transactions
        ),
        "k_inventory_mismatches": lambda w: kpis.inventory_mismatches(
            w.store("inventory").inventory, _unposted(w)
        ),
        "k_inventory_accuracy_unposted": lambda w: kpis.k_inventory_accuracy(
            w.store("inventory").inventory, _unposted(w)
        ),
        "k_inventory_turnover": lambda w: kpis.k_inventory_turnover(
            w.order_items, w.products, w.inventory
        ),
        "k_fulfillment_hours": lambda w: kpis.k_fulfillment_hours(w.wh_orders, w.shipments),
        "k_carrier_performance": lambda w: kpis.k_carrier_performance(w.wh_orders, w.shipments),
        "k_return_rate": lambda w: kpis.k_return_rate(w.order_items, w.returns_),
        "k_most_active_supplier": lambda w: kpis.k_most_active_supplier(
            w.transactions, w.products, w.suppliers
        ),
        "k_location_usage": lambda w: kpis.k_location_usage(w.warehouse_locations),
        "k_monthly_sales": lambda w: kpis.k_monthly_sales(w.wh_orders),
        "k_summary": lambda w: kpis.k_summary(
            base_tables(w.store("inventory", "order_items", "transactions"), KPI_TABLES)
        ),
        # dashboard
        "m_fulfillment_rate": lambda w: measures.m_fulfillment_rate(w.wh_orders),
        "m_return_rate_ledger": lambda w: measures.m_return_rate_ledger(w.transactions),
        "m_turnover_proxy": lambda w: measures.m_turnover_proxy(w.wh_orders, w.transactions),
        "m_avg_delivery_days": lambda w: measures.m_avg_delivery_days(w.shipments),
        "m_exec_cards": lambda w: measures.m_exec_cards(w.wh_orders, w.transactions),
        "m_exec_trend": lambda w: measures.m_exec_trend(w.wh_orders),
        "m_exec_category_revenue": lambda w: measures.m_exec_category_revenue(
            w.order_items, w.products, w.categories
        ),
        "m_exec_top_customers": lambda w: measures.m_exec_top_customers(
            w.wh_orders, w.customers
        ),
        "m_inventory_cards": lambda w: measures.m_inventory_cards(
            w.inventory, w.products, w.warehouse_locations
        ),
        "m_inventory_zone_usage": lambda w: measures.m_inventory_zone_usage(
            w.warehouse_locations
        ),
        "m_inventory_drill": lambda w: measures.m_inventory_drill(w.warehouse_locations),
        "m_shipping_cards": lambda w: measures.m_shipping_cards(w.wh_orders, w.shipments),
        "m_shipping_carriers": lambda w: measures.m_shipping_carriers(w.shipments),
        "m_shipping_status": lambda w: measures.m_shipping_status(w.shipments),
        "m_staff_cards": lambda w: measures.m_staff_cards(w.employees, w.wh_orders),
        "m_staff_sessions": lambda w: sessions.work_sessions(w.wh_orders, "picking_employee_id"),
        "k_ledger_divergence": lambda w: divergence.first_divergence(bin_entries(w), bin_counts(w)),
        "m_staff_leaderboard": lambda w: measures.m_staff_leaderboard(w.employees, w.wh_orders),
        # refreshed from changed orders
        "r04_daily_orders_refreshed": lambda w: increments.daily_orders(_days_refreshed(w)),
        "r05_monthly_orders_refreshed": lambda w: increments.monthly_orders(_days_refreshed(w)),
        "r17_revenue_by_month_refreshed": lambda w: increments.revenue_by_month(
            _days_refreshed(w)
        ),
        "v_category_sales_refreshed": _categories_refreshed,
        "v_category_orders_sketched": v_category_orders_sketched,
        # lookups
        "stock_summary": lambda w: lookups.stock_summary(w.inventory, _stock_ids(w)),
        "inventory_valuation": lambda w: lookups.inventory_valuation(w.inventory, w.products),
        "search_products": lambda w: lookups.search_products(
            w.products, w.categories, w.inventory, "RED"
        ),
        "order_lookup": lambda w: lookups.order_lookup(
            w.wh_orders, w.order_items, w.customers, w.products, w.wh_orders
        ),
        "low_stock": lambda w: lookups.low_stock(w.products, w.inventory),
        "in_stock_products": lambda w: lookups.in_stock_products(w.inventory, w.products),
        "pick_list": lambda w: lookups.pick_list(
            order_requests(w), w.order_items, w.products, w.inventory,
            w.warehouse_locations,
        ),
        "active_staff": _staff,
        "inventory_available": lambda w: lookups.with_available(w.inventory),
        # integrity
        "src_empty_guard": lambda w: tables.row_presence(base_tables(w)),
        "check_constraints": lambda w: constraints.violations(
            base_tables(w.store("inventory", "warehouse_locations", "order_items", "returns_",
                                "transactions"))
        ),
        # stock rules
        "op_default_price": lambda w: orders.op_default_price(w.order_items, w.products),
        "op_order_total": lambda w: orders.op_order_total(w.wh_orders, w.order_items),
        "op_order_status_items": lambda w: orders.op_order_status_items(
            w.wh_orders, w.order_items
        ),
        "op_ledger_from_orders": lambda w: orders.op_ledger_from_orders(
            w.wh_orders, w.order_items
        ),
        "op_occupancy": lambda w: occupancy.op_occupancy(w.inventory),
        "op_occupancy_apply": lambda w: occupancy.apply_occupancy(
            w.warehouse_locations, occupancy.occupancy_delta(change_rows(w.driver("events")))
        ),
        "op_occupancy_delta": lambda w: occupancy.occupancy_delta(
            change_rows(w.driver("events"))
        ),
        "op_reserve": lambda w: _ledger_reserve(w).decisions.drop("employee_id"),
        "op_reserve_ledger": lambda w: _ledger_reserve(w).ledger,
        "op_put_away": lambda w: _put_away(w).decisions.select(*_DECISION),
        "op_put_away_ledger": lambda w: _put_away(w).ledger,
        "op_receive": lambda w: _receive(w).decisions.select(*_DECISION, "reason"),
        "op_receive_ledger": lambda w: _receive(w).ledger,
        "op_complete_pick": lambda w: _complete_pick(w).decisions,
        "op_complete_pick_ledger": lambda w: _complete_pick(w).ledger,
        "op_pack": lambda w: _pack(w).decisions,
        "op_pack_ledger": lambda w: _pack(w).ledger,
        "op_ship": lambda w: _ship(w).decisions.select("order_id", "accepted", "reason"),
        "op_ship_ledger": lambda w: _ship(w).ledger,
        "op_deliver": lambda w: _deliver(w).decisions,
        "op_deliver_ledger": lambda w: _deliver(w).ledger,
        "op_return": lambda w: _return(w).decisions,
        "op_return_rows": lambda w: _return(w).changes["returns"],
        "op_return_ledger": lambda w: _return(w).ledger,
        # what the rules change in the stock, the orders and the shipments
        "op_reserve_delta": lambda w: _ledger_reserve(w).changes["inventory_delta"],
        "op_reserve_orders": lambda w: sinks.apply_updates(
            w.wh_orders, _ledger_reserve(w).changes["orders"], ["order_id"]
        ).select("order_id", "status", "picking_employee_id"),
        "op_put_away_delta": lambda w: _put_away(w).changes["inventory_delta"],
        "op_receive_delta": lambda w: _receive(w).changes["inventory_delta"],
        "op_pack_orders": lambda w: sinks.apply_updates(
            w.wh_orders, _pack(w).changes["orders"], ["order_id"]
        ).select("order_id", "status", "packing_employee_id"),
        "op_ship_delta": lambda w: _ship(w).changes["inventory_delta"],
        "op_ship_orders": lambda w: sinks.apply_updates(
            w.wh_orders, _ship(w).changes["orders"], ["order_id"]
        ).select("order_id", "status"),
        "op_ship_shipments": lambda w: sinks.add_rows(
            w.shipments, _ship(w).changes["shipments"]
        ).select("order_id", "carrier", "status"),
        "op_deliver_shipments": lambda w: sinks.apply_updates(
            w.shipments, _deliver(w).changes["shipments"], ["order_id"]
        ).select("order_id", "status", "delivery_date"),
        "op_return_delta": lambda w: _return(w).changes["inventory_delta"],
        "op_return_orders": lambda w: sinks.apply_updates(
            w.wh_orders, _return(w).changes["orders"], ["order_id"]
        ).select("order_id", "status"),
        # the whole way of an order: the tables and the ledger at its end
        "op_chain_orders": lambda w: _chain(w).tables.orders.select("order_id", "status"),
        "op_chain_items": lambda w: _chain(w).tables.order_items.select(
            "order_id", "product_id", "quantity", "item_status"
        ),
        "op_chain_stock": lambda w: _chain(w).tables.inventory,
        "op_chain_ledger": lambda w: chain.ledger_totals(_chain(w).ledger),
        "pick_list_reserved": lambda w: lookups.pick_list_reserved(
            _ledger_reserve(w).changes["allocations"], w.products, w.warehouse_locations
        ),
        "op_move_stock": lambda w: _move(w).decisions.select(*_DECISION),
        "op_move_stock_delta": lambda w: _move(w).changes["inventory_delta"],
    }
    with_spark: dict[str, Callable[[SparkSession, Warehouse], DataFrame]] = {
        "src_table": src_table,
        "search_products_indexed": search_products_indexed,
        "src_quarantine": src_quarantine,
        "sink_base_csv": sink_base_csv,
        "sink_kpi_csv": sink_kpi_csv,
        "sink_append_ledger": sink_append_ledger,
        "sink_upsert_inventory": sink_upsert_inventory,
        "sink_stock_versions": sink_stock_versions,
        "sink_ledger_months": sink_ledger_months,
        "op_occupancy_stream": lambda spark, w: stream_occupancy(spark, w.sf_dir),
    }
    return {
        **{name: _on_warehouse(build) for name, build in plain.items()},
        **{name: _with_spark(build) for name, build in with_spark.items()},
    }
