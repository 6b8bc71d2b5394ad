"""Mergeable distinct counts, and the ledger by month."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import rows_of
from stockloom.operators import sketches
from stockloom.sources import sinks

ORDERS = "order_id bigint, status string, order_date timestamp_ntz"
ITEMS = "order_id bigint, product_id bigint"


def test_merged_sketches_stay_within_their_error(spark, frame):
    products = frame("product_id bigint, category_id int", *[(i, i % 4 if i else None) for i in range(40)])
    orders = spark.range(30_000).select(
        F.col("id").alias("order_id"), F.when(F.col("id") % 10 == 0, "Cancelled").otherwise("Shipped").alias("status"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 50 as int))").alias("order_date"))
    items = spark.range(90_000).select(
        (F.col("id") % 30_000).alias("order_id"), F.pmod(F.xxhash64("id"), F.lit(40)).alias("product_id"))
    # Stored in two parts, as two batches of orders, and merged.
    parts = [sketches.order_sketches(products, items, orders.filter(f"order_id % 2 = {k}")) for k in (0, 1)]
    stored = sketches.merged(*parts)
    assert stored.count() == 50 * 5 - 5 * 5  # the cancelled orders are all those of five days
    lines = items.join(orders.filter("status <> 'Cancelled'"), "order_id").join(products, "product_id")
    for by in ([], ["category_id"]):
        exact = {tuple(r[:-1]): r[-1] for r in lines.groupBy(*by).agg(F.count_distinct("order_id")).collect()}
        got = {tuple(r[:-1]): r[-1] for r in sketches.distinct_orders(stored, *by).collect()}
        assert exact.keys() == got.keys()
        assert all(abs(got[k] - n) <= sketches.BOUND * n for k, n in exact.items())


def test_months_are_replaced_as_a_whole(spark, frame, tmp_path):
    kinds = "transaction_type string, at timestamp_ntz, quantity int"
    rng = random.Random(1)
    rows = [(rng.choice(["PICKING", "PACKING"]), datetime(2024, 1, 1) + timedelta(days=rng.randint(0, 120)), i) for i in range(200)]
    path = str(tmp_path / "ledger")
    sinks.replace_ledger_months(frame(kinds, *rows), path)
    february = [("PICKING", datetime(2024, 2, 3), 7), ("PICKING", datetime(2024, 2, 9), 8)]
    for _ in range(2):
        sinks.replace_ledger_months(frame(kinds, *february), path)
    stored = spark.read.schema("at timestamp_ntz, quantity int, transaction_type string, month string").parquet(path)
    want = [r for r in rows if not (r[0] == "PICKING" and r[1].month == 2)] + february
    assert rows_of(stored.select("transaction_type", "at", "quantity")) == rows_of(frame(kinds, *want))
    # What is left of the table of months decides which folders are read.
    months = frame("month string, quarter int", ("2024-01", 1), ("2024-02", 1), ("2024-04", 2)).filter("quarter = 2")
    found = sinks.ledger_of_months(stored, months)
    assert found.count() == sum(r[1].month == 4 for r in want) > 0
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()

