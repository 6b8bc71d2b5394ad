"""Stock rules against request-by-request processing, with their invariants."""

import random
from collections import defaultdict

import pytest

from stockloom.operators import chain, lifecycle, moves, orders, putaway, reserve, returning
from stockloom.sources.sinks import upsert_inventory

INVENTORY = (
    "product_id int, location_id int, quantity_on_hand int, quantity_reserved int, "
    "quantity_allocated int"
)
LOCATIONS = (
    "location_id int, zone string, aisle int, shelf int, bin int, max_capacity int, "
    "current_capacity int"
)


def accepted(outcome):
    return {r.seq: r.accepted for r in outcome.decisions.collect()}


def test_reserve_skips_and_goes_on(frame):
    items = frame("order_id int, product_id int, quantity int", (1, 5, 4), (2, 5, 3), (3, 5, 1))
    stock = frame(INVENTORY, (5, 1, 5, 0, 0))
    asked = frame("order_id int, seq int", (1, 1), (2, 2), (3, 3))
    done = reserve.op_reserve(asked, items, stock)
    assert accepted(done) == {1: True, 2: False, 3: True}


def test_reserve_edges(frame):
    items = frame(
        "order_id int, product_id int, quantity int",
        (1, 5, 2), (1, 5, 2), (2, 6, 1), (4, 5, 1),
    )
    stock = frame(INVENTORY, (5, 1, 3, 0, 0), (5, 2, 4, 2, 0), (6, 1, 0, 0, 0))
    asked = frame("order_id int, seq int", (1, 1), (2, 2), (3, 3), (4, 4))
    done = reserve.op_reserve(asked, items, stock)
    # the same product twice; stock 0; no lines; what is left
    assert accepted(done) == {1: True, 2: False, 3: True, 4: True}
    # the bin with more on hand first, although less of it is free
    rows = sorted((r.reference_id, r.location_id, r.quantity) for r in done.ledger.collect())
    assert rows == [("ORDER-1", 1, 2), ("ORDER-1", 2, 2), ("ORDER-4", 1, 1)]


def reserve_in_sequence(asked, items, stock):
    bins = {(p, loc): [on, res] for p, loc, on, res, _ in stock}
    decisions, ledger = {}, defaultdict(int)
    for order, seq in sorted(asked, key=lambda a: a[1]):
        before = {k: list(v) for k, v in bins.items()}
        taken, ok = [], True
        for _, product, need in [i for i in items if i[0] == order]:
            mine = sorted(
                (k for k in bins if k[0] == product), key=lambda k: (-bins[k][0], k[1])
            )
            if sum(bins[k][0] - bins[k][1] for k in mine) < need or not mine:
                ok = False
                break
            for k in mine:
                take = min(need, bins[k][0] - bins[k][1])
                if take > 0:
                    bins[k][1] += take
                    need -= take
                    taken.append((order, *k, take))
        decisions[seq] = ok
        if ok:
            for order_, product, loc, take in taken:
                ledger[(order_, product, loc)] += take
        else:
            bins = before
    return decisions, dict(ledger), bins


@pytest.mark.parametrize("seed", range(3))
def test_reserve_equals_sequential(frame, seed):
    rng = random.Random(seed)
    stock = [
        (p, loc, on, rng.randint(0, on), 0)
        for p in range(8)
        for loc in range(rng.randint(0, 5) if p else 40)
        for on in [rng.randint(0, 12)]
    ]
    # product 0 is in a third of all lines
    items = [
        (o, 0 if rng.random() < 0.34 else rng.randint(1, 7), rng.randint(1, 6))
        for o in range(90)
        for _ in range(rng.randint(0, 4))
    ]
    asked = [(o, 1000 - o) for o in range(90)]
    done = reserve.op_reserve(
        frame("order_id int, seq int", *asked),
        frame("order_id int, product_id int, quantity int", *items),
        frame(INVENTORY, *stock),
    )
    decisions, ledger, bins = reserve_in_sequence(asked, items, stock)
    assert accepted(done) == decisions
    got = {
        (int(r.reference_id[6:]), r.product_id, r.location_id): r.quantity
        for r in done.ledger.collect()
    }
    assert got == ledger
    after = upsert_inventory(frame(INVENTORY, *stock), done.changes["inventory_delta"])
    state = {(r.product_id, r.location_id): r for r in after.collect()}
    assert {k: [r.quantity_on_hand, r.quantity_reserved] for k, r in state.items()} == bins
    assert all(r.quantity_reserved <= r.quantity_on_hand for r in state.values())


RECEIPTS = "product_id int, qty int, employee_id int, reference_id string, seq int"


def test_put_away_splits_and_refuses(frame):
    room = frame(
        LOCATIONS, (1, "B", 1, 1, 1, 5, 0), (2, "A", 1, 1, 1, 12, 2), (3, "A", 1, 2, 1, 5, 9)
    )
    asked = frame(RECEIPTS, (7, 12, 1, "a", 1), (7, 9, 1, "b", 2), (8, 3, 1, "c", 3))
    done = putaway.op_put_away(asked, room)
    assert accepted(done) == {1: True, 2: False, 3: True}
    placed = sorted((r.seq, r.location_id, r.quantity) for r in done.changes["placements"].collect())
    assert placed == [(1, 1, 2), (1, 2, 10), (3, 1, 3)]


def test_put_away_without_room(frame):
    room = frame(LOCATIONS, (1, "A", 1, 1, 1, 5, 5))
    done = putaway.op_put_away(frame(RECEIPTS, (7, 1, 1, "a", 1), (7, 0, 1, "b", 2)), room)
    assert accepted(done) == {1: False, 2: True}
    assert done.ledger.count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_put_away_equals_sequential(frame, seed):
    rng = random.Random(seed)
    bins = [
        (i, rng.choice("ABC"), rng.randint(1, 3), rng.randint(1, 3), i, rng.randint(1, 40),
         rng.randint(0, 30))
        for i in range(60)
    ]
    asked = [(rng.randint(1, 9), rng.randint(1, 60), 1, f"R{i}", i) for i in range(80)]
    done = putaway.op_put_away(frame(RECEIPTS, *asked), frame(LOCATIONS, *bins))
    room = {b[0]: b[5] - b[6] for b in sorted(bins, key=lambda b: b[1:5]) if b[5] > b[6]}
    decisions, placed = {}, []
    for product, qty, _, _, seq in asked:
        decisions[seq] = sum(room.values()) >= qty
        for loc in room if decisions[seq] else ():
            take = min(qty, room[loc])
            if take > 0:
                room[loc] -= take
                qty -= take
                placed.append((seq, product, loc, take))
    assert accepted(done) == decisions
    got = [
        (r.seq, r.product_id, r.location_id, r.quantity)
        for r in done.changes["placements"].collect()
    ]
    assert sorted(got) == sorted(placed)


def test_receive_routes(frame):
    suppliers = frame("supplier_id int", (1,))
    products = frame("product_id int", (5,))
    room = frame(LOCATIONS, (1, "A", 1, 1, 1, 10, 0))
    asked = frame(
        "supplier_id int, product_id int, qty int, reference_id string, qa_passed boolean, "
        "receiver_id int, inspector_id int, seq int",
        (1, 5, 4, "ok", True, 11, 12, 1), (1, 5, 4, "bad", False, 11, 12, 2),
        (2, 5, 4, "who", True, 11, 12, 3), (1, 6, 4, "what", True, 11, 12, 4),
        (1, 5, 9, "full", True, 11, 12, 5),
    )
    done = putaway.op_receive(asked, suppliers, products, room)
    reasons = {r.seq: (r.accepted, r.reason) for r in done.decisions.collect()}
    assert reasons == {
        1: (True, None), 2: (False, "failed inspection"), 3: (False, "unknown supplier"),
        4: (False, "unknown product"), 5: (False, "no room"),
    }
    ledger = sorted(
        (r.reference_id, r.transaction_type, r.location_id, r.quantity, r.employee_id)
        for r in done.ledger.collect()
    )
    assert ledger == [
        ("bad", "QUALITY_FAIL", None, 4, 12),
        ("full", "RECEIVING", None, 9, 11), ("full", "STOCK_ADJUSTMENT", None, 9, 11),
        ("ok", "PUT_AWAY", 1, 4, 11), ("ok", "RECEIVING", None, 4, 11),
    ]


ORDERS = "order_id int, status string"
STATES = ["Pending", "Picking", "Packed", "Shipped", "Delivered", "Cancelled", "Returned"]


def all_states(frame):
    return frame(ORDERS, *enumerate(STATES))


def items(frame, *rows):
    return frame("order_id int, product_id int, quantity int, unit_price decimal(10,2)", *rows)


def test_status_guards(frame):
    state = all_states(frame)
    lines = items(frame, *[(i, 5, 2, None) for i in range(7)])
    asked = frame("order_id int, employee_id int, seq int", *[(i, 9, i) for i in range(8)],
                  (1, 9, 100))
    packed = lifecycle.op_pack(asked, state, lines)
    assert {s for s, ok in accepted(packed).items() if ok} == {1}
    reasons = {r.seq: r.reason for r in packed.decisions.collect()}
    assert reasons[100] == "already done" and reasons[7] == "not found"
    assert [(r.transaction_type, r.quantity, r.employee_id) for r in packed.ledger.collect()] == [
        ("PACKING", 2, 9)
    ]
    shipments = frame(ORDERS, (3, "In Transit"), (4, "Delivered"), (5, "Failed"))
    asked = frame("order_id int, delivery_date string, seq int", *[(i, "d", i) for i in range(7)])
    delivered = lifecycle.op_deliver(asked, shipments, lines)
    assert {s for s, ok in accepted(delivered).items() if ok} == {3}


SHIP = (
    "order_id int, carrier string, shipping_cost decimal(10,2), tracking_number string, "
    "ship_date string, seq int"
)


def test_ship_deducts_reserved_bins_in_sequence(frame):
    state = frame(ORDERS, (1, "Packed"), (2, "Packed"), (3, "Picking"))
    lines = items(frame, (1, 5, 3, None), (1, 5, 1, None), (2, 5, 4, None), (3, 5, 9, None))
    stock = frame(INVENTORY, (5, 1, 9, 2, 0), (5, 2, 9, 0, 0), (5, 3, 9, 4, 0))
    asked = frame(SHIP, *[(i, "UPS", None, f"T{i}", "d", 10 - i) for i in (1, 2, 3)])
    done = lifecycle.op_ship(asked, state, lines, stock)
    assert {r.order_id: r.accepted for r in done.decisions.collect()} == {1: True, 2: True, 3: False}
    # order 2 has the lower sequence number; order 1 finds 2 of its 4 units
    ledger = sorted((r.reference_id, r.location_id, r.quantity) for r in done.ledger.collect())
    assert ledger == [("ORDER-1", 3, 2), ("ORDER-2", 1, 2), ("ORDER-2", 3, 2)]
    delta = {r.location_id: r.quantity_on_hand for r in done.changes["inventory_delta"].collect()}
    assert delta == {1: -2, 3: -4}
    after = upsert_inventory(stock, done.changes["inventory_delta"]).collect()
    assert {r.location_id: (r.quantity_on_hand, r.quantity_reserved) for r in after} == {
        1: (7, 0), 2: (9, 0), 3: (5, 0)
    }


def test_complete_pick_needs_a_pick_list(frame):
    state = frame("order_id int, picking_employee_id int", (1, 4), (2, 4))
    lines = items(frame, (1, 5, 3, None), (2, 6, 1, None))
    products = frame("product_id int, sku string, product_name string", (5, "a", "A"), (6, "b", "B"))
    stock = frame(INVENTORY, (5, 1, 9, 2, 0), (5, 2, 9, 1, 0), (6, 1, 9, 0, 0))
    room = frame(LOCATIONS, (1, "A", 1, 1, 1, 5, 5), (2, "A", 1, 1, 2, 5, 5))
    done = lifecycle.op_complete_pick(
        frame("order_id int", (1,), (2,)), state, lines, products, stock, room
    )
    assert {r.order_id: r.accepted for r in done.decisions.collect()} == {1: True, 2: False}
    # every reserved bin repeats the whole line
    assert sorted((r.location_id, r.quantity, r.employee_id) for r in done.ledger.collect()) == [
        (1, 3, 4), (2, 3, 4)
    ]
    assert done.changes["order_items"].count() == 1


def test_returns(frame):
    state = frame(ORDERS, (1, "Delivered"), (2, "Delivered"), (3, "Shipped"), (4, "Delivered"))
    from decimal import Decimal

    lines = items(
        frame, (1, 5, 3, Decimal("2.50")), (1, 6, 1, Decimal("1.00")), (2, 5, 2, Decimal("4.00")),
        (4, 9, 1, Decimal("1.25")),
    )
    stock = frame(INVENTORY, (5, 8, 1, 0, 0), (5, 7, 1, 0, 0))
    asked = frame(
        "order_id int, product_id int, qty int, reason string, return_date string, seq int",
        (1, 5, 4, "Damaged", "d", 1),  # more than bought
        (1, 5, 2, "Buyer Remorse", "d", 2),
        (1, 6, 1, "Damaged", "d", 3),  # the order is returned by now
        (2, 7, 1, "Damaged", "d", 4),  # not in the order
        (2, 5, 2, "Defective", "d", 5),
        (3, 5, 1, "Damaged", "d", 6),  # not delivered
        (4, 9, 1, "Incorrect Item", "d", 7),  # no bin to go back to
    )
    done = returning.op_return(asked, state, lines, stock)
    assert {r.seq: r.reason_refused for r in done.decisions.collect()} == {
        1: "more than bought", 2: None, 3: "order already returned", 4: "product not in order",
        5: None, 6: "order not delivered", 7: None,
    }
    returns = {r.order_id: (r.refund_amount, r.fully_returned) for r in done.changes["returns"].collect()}
    assert returns == {
        1: (Decimal("5.00"), False), 2: (Decimal("8.00"), True), 4: (Decimal("1.25"), True)
    }
    ledger = sorted(
        (r.reference_id, r.transaction_type, r.location_id, r.quantity)
        for r in done.ledger.collect()
    )
    assert ledger == [
        ("ORDER-1", "RETURN_INSPECTED", None, 2), ("ORDER-1", "STOCK_ADJUSTMENT", 7, 2),
        ("ORDER-2", "QUALITY_FAIL", None, 2), ("ORDER-2", "RETURN_INSPECTED", None, 2),
        ("ORDER-4", "RETURN_INSPECTED", None, 1),
    ]


MOVES = "product_id int, from_location int, to_location int, qty int, employee_id int, seq int"


def move_in_sequence(asked, stock, room):
    bins = {(p, loc): [on, res] for p, loc, on, res, _ in stock}
    space = {b[0]: b[5] - b[6] for b in room}
    decisions = {}
    for product, source, target, qty, _, seq in sorted(asked, key=lambda a: a[-1]):
        have = bins.get((product, source))
        ok = have is not None and have[0] - have[1] >= qty and space.get(target, -1) >= qty > 0
        decisions[seq] = ok
        if ok:
            have[0] -= qty
            bins.setdefault((product, target), [0, 0])[0] += qty
            space[source] += qty
            space[target] -= qty
    return decisions, {k: v[0] for k, v in bins.items()}


@pytest.mark.parametrize("seed", range(3))
def test_moves_equal_sequential(frame, seed):
    rng = random.Random(seed)
    stock = [(p, loc, rng.randint(0, 20), 0, 0) for p in range(3) for loc in range(5)]
    held = {loc: sum(s[2] for s in stock if s[1] == loc) for loc in range(6)}
    room = [(loc, "A", 1, 1, loc, held[loc] + rng.randint(1, 15), held[loc]) for loc in range(6)]
    asked = [
        (rng.randint(0, 2), rng.randint(0, 5), rng.randint(0, 6), rng.randint(1, 9), 1, i)
        for i in range(60)
    ]
    stock_frame = frame(INVENTORY, *stock)
    done = moves.op_move_stock(frame(MOVES, *asked), stock_frame, frame(LOCATIONS, *room))
    decisions, bins = move_in_sequence(asked, stock, room)
    assert accepted(done) == decisions
    after = upsert_inventory(stock_frame, done.changes["inventory_delta"]).collect()
    got = {(r.product_id, r.location_id): r.quantity_on_hand for r in after}
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in bins.items() if v}
    assert sum(got.values()) == sum(s[2] for s in stock)


def test_default_price_and_total(frame):
    from decimal import Decimal

    lines = frame(
        "order_id int, product_id int, quantity int, unit_price decimal(10,2)",
        (1, 5, 2, None), (1, 5, 1, Decimal("0.00")), (2, 5, 3, Decimal("4.20")),
    )
    products = frame("product_id int, sale_price decimal(10,2)", (5, Decimal("9.99")))
    priced = orders.op_default_price(lines, products)
    assert sorted(r.unit_price for r in priced.collect()) == [
        Decimal("4.20"), Decimal("9.99"), Decimal("9.99")
    ]
    state = frame("order_id int, total_amount decimal(10,2)", (1, None), (2, None), (3, None))
    totals = {r.order_id: r.total_amount for r in orders.op_order_total(state, priced).collect()}
    assert totals == {1: Decimal("29.97"), 2: Decimal("12.60"), 3: Decimal("0.00")}


def test_status_of_reserved_orders_needs_no_allocation(frame, monkeypatch):
    def refuse(*_):
        raise AssertionError("stock was allocated")

    monkeypatch.setattr(reserve, "laid_out", refuse)
    done = reserve.op_reserve(
        frame("order_id int, seq int, employee_id int", (1, 1, 7), (2, 2, 8)),
        frame("order_id int, product_id int, quantity int", (1, 1, 5), (2, 1, 6)),
        frame("product_id int, location_id int, quantity_on_hand int, quantity_reserved int, quantity_allocated int",
              (1, 1, 10, 0, 0)))
    assert "orders" in done.changes
    assert [tuple(r) for r in done.changes["orders"].collect()] == [(1, "Picking", 7)]
    assert [r.order_id for r in done.changes["order_items"].collect()] == [1]


def test_chain_allocates_shipments_only_for_stock_and_ledger(spark, monkeypatch):
    """The status of orders and lines follows from the decisions of the steps."""
    shipped = []
    plain = lifecycle.allocate
    monkeypatch.setattr(lifecycle, "allocate", lambda *a: shipped.append(1) or plain(*a))
    tables = chain.Tables(
        spark.createDataFrame([(1, "Pending", None, None), (2, "Packed", 3, 4), (3, "Pending", None, None)],
                              "order_id bigint, status string, picking_employee_id int, packing_employee_id int"),
        spark.createDataFrame([(1, 5, 2, "Pending"), (2, 5, 3, "Packed"), (3, 5, 9, "Pending")],
                              "order_id bigint, product_id bigint, quantity int, item_status string"),
        spark.createDataFrame([(5, 1, 8, 3, 0)], INVENTORY.replace("int", "bigint")),
        spark.createDataFrame([], "order_id bigint, tracking_number string, carrier string, "
                              "shipping_cost decimal(10,2), ship_date string, delivery_date string, status string"))
    asked = spark.createDataFrame([(1, 1, 7), (3, 3, 7)], "order_id bigint, seq bigint, employee_id bigint")
    sent = spark.createDataFrame(
        [(i, i, 7, "UPS", None, f"T{i}", "d", "e") for i in (1, 2, 3)],
        "order_id bigint, seq bigint, employee_id bigint, carrier string, shipping_cost decimal(10,2), "
        "tracking_number string, ship_date string, delivery_date string")
    done = chain.fulfil(tables, asked, sent)
    assert {r.order_id: r.status for r in done.tables.orders.collect()} == {1: "Delivered", 2: "Delivered", 3: "Pending"}
    assert {r.order_id: r.item_status for r in done.tables.order_items.collect()} == {
        1: "Shipped", 2: "Shipped", 3: "Pending"}
    assert not shipped
    stock = done.tables.inventory.first()
    assert (stock.quantity_on_hand, stock.quantity_reserved) == (3, 0)
    assert {r.transaction_type: r.units for r in chain.ledger_totals(done.ledger).collect()} == {
        "RESERVATION": 2, "PICKING": 2, "PACKING": 2, "SHIPPING": 5, "DELIVERY": 5}
    assert len(shipped) == 1
