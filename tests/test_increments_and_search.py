"""Refreshed figures against recomputed ones, and the search index against a scan."""

import random
from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest

from conftest import rows_of
from stockloom.operators import increments, lookups, reports, views
from stockloom.operators.search import ProductIndex, literal_runs

ORDERS = "order_id bigint, status string, order_date timestamp_ntz, total_amount decimal(10,2)"
ITEMS = "order_id bigint, product_id bigint, quantity int, unit_price decimal(10,2)"
PRODUCTS = ("product_id bigint, sku string, product_name string, category_id int, cost_price decimal(10,2), "
            "sale_price decimal(10,2)")
CATEGORIES = "category_id int, category_name string"


def state(rng, ids):
    orders, items = [], []
    for i in ids:
        at = datetime(2024, 1, 25) + timedelta(hours=rng.randint(0, 900))
        orders.append((i, rng.choice(["Pending", "Shipped", "Cancelled", None]), at if rng.random() < 0.95 else None,
                       rng.choice([None, D("10.25"), D("3.10"), D("99999.99")])))
        for _ in range(rng.randint(0, 4)):
            items.append((i, rng.randint(1, 7), rng.randint(1, 5), rng.choice([None, D("2.50"), D("7.77")])))
    return orders, items


@pytest.mark.parametrize("seed", range(2))
def test_refreshing_equals_recomputing(frame, seed):
    rng = random.Random(seed)
    products = frame(PRODUCTS, *[(i, "s", "n", None if i == 6 else i % 3, D("1.10"), D("2.00")) for i in range(1, 7)])
    categories = frame(CATEGORIES, (0, "a"), (1, "b"), (2, "c"), (3, "none"))
    orders, items = state(rng, range(60))
    days = increments.day_cells(frame(ORDERS, *orders))
    cells = increments.category_cells(products, frame(ITEMS, *items), frame(ORDERS, *orders))
    for step in range(2):
        gone = set(rng.sample([o[0] for o in orders], 20)) if step == 0 else {o[0] for o in orders}
        back = [i for i in gone if rng.random() < 0.5] + [100 * (step + 1) + i for i in range(5)]
        fresh = state(rng, back)
        after = ([o for o in orders if o[0] not in gone] + fresh[0], [x for x in items if x[0] not in gone] + fresh[1])
        ids = {r.order_id for r in increments.changed_orders(frame(ORDERS, *orders), frame(ORDERS, *after[0])).collect()}
        ids |= {r.order_id for r in increments.changed_orders(frame(ITEMS, *items), frame(ITEMS, *after[1])).collect()}
        assert ids <= gone | set(back)

        def of(rows, kind, ids=ids):
            return frame(kind, *[r for r in rows if r[0] in ids])

        days = increments.refreshed_days(days, of(orders, ORDERS), of(after[0], ORDERS))
        cells = increments.refreshed_categories(
            cells, products, (of(items, ITEMS), of(orders, ORDERS)), (of(after[1], ITEMS), of(after[0], ORDERS)))
        orders, items = after
        all_orders, all_items = frame(ORDERS, *orders), frame(ITEMS, *items)
        assert rows_of(increments.daily_orders(days)) == rows_of(reports.r04_daily_orders(all_orders))
        assert rows_of(increments.monthly_orders(days)) == rows_of(reports.r05_monthly_orders(all_orders))
        assert rows_of(increments.revenue_by_month(days)) == rows_of(reports.r17_revenue_by_month(all_orders))
        view = views.v_category_sales(categories, products, all_items, all_orders)
        assert rows_of(increments.category_sales(cells, categories).select(view.columns)) == rows_of(view)
        days, cells = frame_of(days), frame_of(cells)


def frame_of(df):
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def test_changed_orders_sees_single_columns_and_repeated_rows(frame):
    a = frame(ITEMS, (1, 1, 1, None), (2, 1, 1, D("1.00")), (3, 1, 1, None), (4, 1, 1, None))
    b = frame(ITEMS, (1, 1, 1, None), (2, 1, 1, D("1.01")), (3, 1, 1, None), (3, 1, 1, None))
    assert {r.order_id for r in increments.changed_orders(a, b).collect()} == {2, 3, 4}


def test_runs_between_wildcards():
    assert literal_runs("%a_bc%") == ["a", "bc"]
    assert literal_runs(r"%50\% off\_x%") == ["50% off_x"]
    assert literal_runs("%%") == []


def test_the_index_finds_what_a_scan_finds(spark, frame, tmp_path):
    rng = random.Random(5)
    words = ["red", "Ring", "bolt", "ÜBER", "50% off", "a_b", "x", "Σίσυφος", ""]
    products = frame(PRODUCTS, *[
        (i, f"PROD-{i}", rng.choice([None, " ".join(rng.choice(words) for _ in range(3))]), rng.choice([None, 1, 2, 9]),
         None, D("1.00")) for i in range(300)])
    categories = frame(CATEGORIES, (1, "Red tools"), (2, "Other"))
    stock = frame("product_id bigint, quantity_on_hand int", *[(i % 200, 3) for i in range(400)])
    index = ProductIndex(spark, str(tmp_path)).build(products, categories, buckets=8)
    for term in ["red", "RED R", "bolt", "b%t", "ol", "", "%", "über", r"50\% off", "a\\_b", "prod-1_1", "tools", "zzz",
                 "d_t", "σίσυφος", "x x"]:
        want = rows_of(lookups.search_products(products, categories, stock, term))
        assert rows_of(index.search(term, stock)) == want, term


def test_only_buckets_of_candidates_are_read(spark, frame, tmp_path):
    products = frame(PRODUCTS, *[(i, f"S{i:06d}", f"word{i:06d}", 1, None, None) for i in range(2000)])
    index = ProductIndex(spark, str(tmp_path)).build(products, frame(CATEGORIES, (1, "all")), buckets=16)
    found = index.find("word001234")
    assert [r.product_id for r in found.collect()] == [1234]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(product_id, [1234])" in plan.replace("IsNotNull(product_id), ", "") or "EqualTo(product_id,1234)" in plan
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
