"""Hand-written frames for the edges of the reports, key figures and lookups."""

from datetime import datetime
from decimal import Decimal

import pytest

from conftest import rows_of
from stockloom.functions import scalars
from stockloom.operators import constraints, kpis, lookups, measures, reports, views

D = Decimal
INVENTORY = (
    "product_id int, location_id int, quantity_on_hand int, quantity_reserved int, "
    "quantity_allocated int"
)
PRODUCTS = (
    "product_id int, sku string, product_name string, category_id int, supplier_id int, "
    "cost_price decimal(10,2), sale_price decimal(10,2), reorder_level int"
)
CATEGORIES = "category_id int, category_name string"
ITEMS = "order_id int, product_id int, quantity int, unit_price decimal(10,2), item_status string"
ORDERS = (
    "order_id int, customer_id int, status string, order_date timestamp_ntz, "
    "total_amount decimal(10,2), picking_employee_id int, packing_employee_id int"
)
SHIPMENTS = (
    "shipment_id int, order_id int, carrier string, shipping_cost decimal(10,2), "
    "ship_date timestamp_ntz, delivery_date timestamp_ntz, status string"
)
LEDGER = (
    "transaction_type string, product_id int, location_id int, quantity int, employee_id int, "
    "reference_id string, notes string"
)
LOCATIONS = (
    "location_id int, zone string, aisle int, shelf int, bin int, max_capacity int, "
    "current_capacity int"
)
NOON = datetime(2001, 1, 1, 12)


def product(i, category=1, supplier=1, reorder=10):
    return (i, f"PRO-{i}", f"name {i}", category, supplier, D("2.00"), D("3.00"), reorder)


def order(i, customer=1, status="Delivered", at=NOON, total="10.00", picker=None, packer=None):
    return (i, customer, status, at, D(total), picker, packer)


def test_zero_divisors(frame):
    categories = frame(CATEGORIES, (1, "a"), (2, "b"))
    products = frame(PRODUCTS, product(1))
    lines = frame(ITEMS, (1, 1, 4, D("3.00"), "Shipped"))
    returned = frame("order_id int, product_id int, quantity int, refund_amount decimal(10,2)",
                     (1, 1, 1, D("3.00")))
    rates = {r.category_name: r.return_rate_percentage
             for r in reports.r11_return_percentage(categories, products, lines, returned).collect()}
    assert rates == {"a": 25.0, "b": None}
    stock = frame(INVENTORY)
    turnover = reports.r15_inventory_turnover(
        categories, products, lines, frame(ORDERS, order(1)), stock
    ).collect()
    assert {r.category_name: r.inventory_turnover_ratio for r in turnover} == {"a": None, "b": None}
    assert kpis.k_inventory_turnover(lines, products, stock).first().inventory_turnover == 8.0
    none = frame(ORDERS)
    assert measures.m_fulfillment_rate(none).first()[0] == 0.0
    assert measures.m_return_rate_ledger(frame(LEDGER)).first()[0] == 0.0
    assert measures.m_turnover_proxy(none, frame(LEDGER)).first()[0] == 0.0
    assert reports.r06_fulfillment_rate(none).first().fulfillment_rate_percentage is None
    empty_lines = frame(ITEMS)
    assert kpis.k_return_rate(empty_lines, returned).first().return_rate_percentage == 0.0
    assert lookups.inventory_valuation(stock, products).first().total_inventory_cost == 0


def test_null_keys_stay_or_go(frame):
    categories = frame(CATEGORIES, (1, "a"))
    products = frame(PRODUCTS, product(1), product(2, category=None))
    stock = frame(INVENTORY, (2, 1, 5, 0, 0))
    low = views.v_low_stock_alerts(products, categories, stock)
    assert rows_of(low.select("product_id", "category_name", "quantity_available")) == [
        (1, "a", 0), (2, None, 5)
    ]
    assert [r.product_id for r in reports.r02_lowest_inventory(products, stock).collect()] == [1, 2]
    assert reports.r03_inventory_value(stock, products, categories).count() == 0
    customers = frame("customer_id int, first_name string, last_name string, membership_tier string",
                      (1, "A", "B", "Gold"), (2, "C", "D", "Gold"))
    orders = frame(ORDERS, order(1, customer=None), order(2, status="Cancelled"))
    segments = reports.r16_customer_frequency(customers, orders).collect()
    assert [(r.customer_name, r.total_orders, r.customer_lifetime_value) for r in segments] == [
        ("A B", 0, None), ("C D", 0, None)
    ]
    assert segments[0].customer_segment == "One-Time / Inactive"


def test_time_edges(frame):
    cases = [  # hours and minutes to ship, hours in transit
        ("24h 0m", 24 * 60, 72), ("24h 59m", 24 * 60 + 59, 3 * 24 + 23), ("25h", 25 * 60, 96),
    ]
    orders = frame(ORDERS, *[order(i) for i in range(3)], order(3, at=datetime(2001, 1, 1, 23, 50)))
    shipped = []
    for i, (name, minutes, hours) in enumerate(cases):
        out = datetime.fromtimestamp(NOON.timestamp() + minutes * 60)
        back = datetime.fromtimestamp(out.timestamp() + hours * 3600)
        shipped.append((i, i, name, D("5.00"), out, back, "Delivered"))
    midnight = (3, 3, "midnight", D("5.00"), datetime(2001, 1, 1, 23, 59),
                datetime(2001, 1, 2, 0, 1), "Delivered")
    shipments = frame(SHIPMENTS, *shipped, midnight)
    whole = {r.carrier: (r.late_dispatches_count, r.late_deliveries_count)
             for r in reports.r20_shipping_delays(orders, shipments).collect()}
    assert whole == {"24h 0m": (0, 0), "24h 59m": (0, 0), "25h": (1, 1), "midnight": (0, 0)}
    exact = {r.carrier: (r.late_dispatches, r.late_deliveries)
             for r in kpis.k_carrier_performance(orders, shipments).collect()}
    assert exact == {"24h 0m": (0, 0), "24h 59m": (1, 1), "25h": (1, 1), "midnight": (0, 0)}
    days = measures.m_avg_delivery_days(shipments.filter("carrier = 'midnight'"))
    assert days.first()[0] == 1.0
    assert reports.r07_avg_shipping_time(shipments.filter("carrier = '25h'")).first()[2] == 4.0
    row = views.v_order_fulfillment_kpis(orders, shipments).filter("order_id = 1").first()
    assert (row.minutes_to_ship, row.hours_to_deliver) == (24 * 60 + 59, 119)


def test_roles_sort_as_declared(frame):
    staff = frame("employee_id int, first_name string, last_name string, role string, status string",
                  (1, "A", "A", "Packer", "Active"), (2, "B", "B", "Picker", "Active"),
                  (3, "C", "C", "Picker", "Inactive"), (4, "D", "D", "Picker", "Active"),
                  (5, "E", "E", "Picker", "Active"))
    orders = frame(ORDERS, order(1, picker=2, packer=1), order(2, picker=4),
                   order(3, status="Cancelled", picker=2))
    got = [(r.role, r.employee_id, r.productivity_rank)
           for r in reports.r08_employee_productivity(staff, orders).collect()]
    assert got == [("Picker", 2, 1), ("Picker", 4, 1), ("Picker", 5, 2), ("Packer", 1, 1)]
    counted = views.v_employee_productivity(staff, orders, frame(LEDGER))
    assert {r.employee_id: r.orders_picked for r in counted.collect()}[2] == 2


def test_ties_have_one_answer(frame):
    categories = frame(CATEGORIES, (1, "a"), (2, "b"))
    products = frame(PRODUCTS, product(3), product(2, category=2), product(1))
    lines = frame(ITEMS, *[(1, p, 2, D("3.00"), "Shipped") for p in (1, 2, 3)])
    orders = frame(ORDERS, order(1))
    top = reports.r01_top_products(lines, products, categories, orders, k=2)
    assert [r.product_id for r in top.collect()] == [1, 2]
    fast = reports.r13_fast_movers(products, categories, lines, orders, datetime(2001, 1, 2), k=2)
    assert [(r.sku, r.sales_velocity_rank) for r in fast.collect()] == [("PRO-1", 1), ("PRO-2", 1)]
    customers = frame("customer_id int, first_name string, last_name string", (1, "A", "B"))
    two = frame(ITEMS, (1, 1, 1, None, "Shipped"), (1, 2, 1, None, "Shipped"))
    best = reports.r18_top_customers(customers, orders, two, products, categories).first()
    assert best.favorite_product_category == "a"


def test_slow_movers_repeat_stock_per_old_line(frame):
    categories = frame(CATEGORIES, (1, "a"))
    products = frame(PRODUCTS, product(1), product(2), product(3))
    stock = frame(INVENTORY, (1, 1, 5, 0, 0), (1, 2, 2, 0, 0), (2, 1, 1, 0, 0), (3, 1, 1, 0, 0))
    old, new = datetime(2000, 1, 1), datetime(2001, 1, 1)
    orders = frame(ORDERS, order(1, at=old), order(2, at=new, status="Cancelled"))
    lines = frame(ITEMS, *[(1, 1, 1, None, "Shipped")] * 3, (2, 1, 1, None, "Shipped"),
                  (2, 3, 1, None, "Shipped"))
    args = (products, categories, stock, lines, orders, datetime(2001, 1, 2))
    literal = {r.sku: (r.current_inventory, r.dead_stock_value_cost)
               for r in reports.r14_slow_movers(*args).collect()}
    assert literal == {"PRO-1": (21, D("42.00")), "PRO-2": (1, D("2.00"))}
    deduped = {r.sku: r.current_inventory
               for r in reports.r14_slow_movers(*args, deduped=True).collect()}
    assert deduped == {"PRO-2": 1}


def test_supplier_prefixes_collide(frame):
    suppliers = frame("supplier_id int, supplier_name string, performance_rating decimal(3,2)",
                      (1, "a", D("5.00")), (10, "b", D("4.00")), (100, "c", D("3.00")))
    ledger = frame(LEDGER, *[("RECEIVING", 1, None, 5, None, f"RECV-SUPP-{s}-1234", None)
                             for s in (1, 10, 100)],
                   ("QUALITY_FAIL", 1, None, 5, None, "RECV-SUPP-10-1234", None),
                   ("RECEIVING", 1, None, 5, None, "RECV-SIM-1", None))
    products = frame(PRODUCTS, product(1, supplier=1), product(2, supplier=None))

    def counts(exact):
        df = reports.r10_supplier_performance(suppliers, products, ledger, exact=exact)
        return {r.supplier_id: (r.total_shipments_received, r.total_quality_failures)
                for r in df.collect()}

    assert counts(False) == {1: (3, 1), 10: (2, 1), 100: (1, 0)}
    assert counts(True) == {1: (1, 0), 10: (1, 1), 100: (1, 0)}


def test_inventory_accuracy_follows_the_ledger(frame):
    stock = frame(INVENTORY, (1, 1, 6, 2, 0), (1, 2, 4, 0, 0), (1, 3, 9, 0, 0), (2, 1, 0, 0, 0))
    ledger = frame(
        LEDGER,
        ("RECEIVING", 1, None, 12, None, "r", None),
        ("PUT_AWAY", 1, 1, 12, None, "r", None),
        ("RESERVATION", 1, 1, 2, None, "ORDER-1", None),
        ("SHIPPING", 1, 1, 2, None, "ORDER-1", None),
        ("STOCK_ADJUSTMENT", 1, 2, 4, None, "INTERNAL_MOVE", "Moved from location 1"),
        ("STOCK_ADJUSTMENT", 1, None, 7, None, "r", "no room"),
        ("PUT_AWAY", 1, 3, 8, None, "r", None),
    )
    got = kpis.k_inventory_accuracy(stock, ledger).first()
    assert (got.bins, got.mismatched_bins, got.inventory_accuracy_percentage) == (4, 1, 75.0)
    wrong = kpis.inventory_mismatches(stock, ledger).collect()
    assert [(r.product_id, r.location_id, r.ledger) for r in wrong] == [(1, 3, 8)]
    per_product = kpis.inventory_accuracy_by_product(stock, ledger).collect()
    assert {r.product_id: (r.on_hand, r.ledger) for r in per_product} == {1: (19, 18), 2: (0, 0)}


def test_most_active_supplier_without_receipts(frame):
    suppliers = frame("supplier_id int, supplier_name string", (1, "a"))
    got = kpis.k_most_active_supplier(frame(LEDGER), frame(PRODUCTS, product(1)), suppliers).first()
    assert (got.most_active_supplier, got.received_units) == ("None", 0)


def test_orders_without_status_count_in_the_mean(frame):
    orders = frame(ORDERS, order(1, total="10.00"), order(2, status=None, total="20.00"),
                   order(3, status="Cancelled", total="99.00"))
    assert kpis.k_aov(orders).first()[0] == D("15.000000")


@pytest.mark.parametrize(("term", "found"), [("pro", 2), ("PRO", 2), ("NAME 1", 1), ("%", 2),
                                             ("a_pha", 1), ("zzz", 0)])
def test_search(frame, term, found):
    categories = frame(CATEGORIES, (1, "alpha"))
    products = frame(PRODUCTS, product(1), product(2, category=None))
    stock = frame(INVENTORY, (1, 1, 5, 0, 0), (1, 2, 2, 0, 0))
    got = lookups.search_products(products, categories, stock, term).collect()
    assert len(got) == found
    if term == "NAME 1":
        assert got[0].quantity_on_hand == 7


def test_lookups(frame):
    stock = frame(INVENTORY, (1, 1, 5, 2, 0), (1, 2, 6, 0, 0), (2, 1, 4, 4, 0))
    products = frame(PRODUCTS, product(1), product(2), product(3))
    ids = frame("product_id int", (1,), (1,), (9,))
    assert rows_of(lookups.stock_summary(stock, ids)) == [(1, 11, 2, 9), (9, 0, 0, 0)]
    assert rows_of(lookups.in_stock_products(stock, products).select("product_id")) == [(1,)]
    assert {r.product_id for r in lookups.low_stock(products, stock, 0).collect()} == {2, 3}
    customers = frame("customer_id int, first_name string, last_name string", (1, "A", "B"))
    lines = frame(ITEMS, (1, 1, 2, D("3.00"), "Shipped"), (1, 2, 1, D("3.00"), "Shipped"))
    orders = frame(ORDERS, order(1), order(2), order(3, customer=None))
    asked = frame("order_id int", (1,), (2,), (3,), (4,))
    got = rows_of(lookups.order_lookup(orders, lines, customers, products, asked)
                  .select("order_id", "customer_name", "sku"))
    assert got == [(1, "A B", "PRO-1"), (1, "A B", "PRO-2"), (2, "A B", None)]
    assert [r.quantity_available for r in lookups.with_available(stock).collect()] == [3, 6, 0]


def test_pick_list_walks_the_aisles(frame):
    room = frame(LOCATIONS, (1, "B", 1, 1, 1, 9, 0), (2, "A", 2, 1, 1, 9, 0), (3, "A", 1, 9, 1, 9, 0))
    stock = frame(INVENTORY, (1, 1, 5, 1, 0), (1, 2, 5, 1, 0), (2, 3, 5, 1, 0), (2, 1, 5, 0, 0))
    lines = frame(ITEMS, (1, 1, 4, None, "Reserved"), (1, 2, 1, None, "Reserved"))
    got = lookups.pick_list(frame("order_id int", (1,)), lines, frame(PRODUCTS, product(1), product(2)),
                            stock, room)
    path = sorted((r.pick_sequence, r.label, r.product_id, r.quantity) for r in got.collect())
    assert path == [(1, "A-A1S9B1", 2, 1), (2, "A-A2S1B1", 1, 4), (3, "B-A1S1B1", 1, 4)]


def test_violations(frame):
    tables = {
        "categories": frame(CATEGORIES, (1, "a"), (2, "a"), (2, None)),
        "products": frame(PRODUCTS, product(1, category=9), product(2, category=None)),
        "inventory": frame(INVENTORY, (1, 1, -1, 0, 0), (1, 1, 1, 0, 0), (7, 1, 1, 0, 0)),
        "orders": frame(ORDERS, order(1, status="Lost", total="-1.00")),
    }
    found = {(r.table_name, r.rule): r.n for r in constraints.violations(tables).collect() if r.n}
    assert found == {
        ("categories", "not_null(category_name)"): 1,
        ("categories", "primary_key(category_id)"): 1,
        ("categories", "unique(category_name)"): 1,
        ("products", "foreign_key(category_id)"): 1,
        ("inventory", "check(quantity_on_hand)"): 1,
        ("inventory", "unique(product_id,location_id)"): 1,
        ("inventory", "foreign_key(product_id)"): 1,
        ("orders", "check(total_amount)"): 1,
        ("orders", "enum(status)"): 1,
    }


def test_whole_units_cut_toward_zero(frame):
    late, early = datetime(2001, 1, 2, 1, 30), datetime(2001, 1, 2)
    df = frame("a timestamp_ntz, b timestamp_ntz", (late, early), (early, late))
    hours = [r[0] for r in df.select(scalars.whole_units("HOUR", "a", "b")).collect()]
    assert hours == [-1, 1]
