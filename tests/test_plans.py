"""Joins with hot keys, running totals over blocks, allocation and sequential decisions."""

import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows_of
from stockloom.operators import lookups
from stockloom.plans import allocate as allocation
from stockloom.plans import lookup, resolve
from stockloom.plans.components import components
from stockloom.plans.allocate import allocate, laid_out
from stockloom.plans.combine import one_row
from stockloom.plans.scan import BLOCK, running, with_blocks
from stockloom.plans.scratch import Scratch


def hot_lines(spark, n=6000):
    """A third of the rows hold one key, two rows hold none."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500)
    lines = spark.range(n).select(
        F.when(F.col("id") < 2, F.lit(None)).otherwise(key).alias("k"), F.col("id").alias("v")
    )
    dim = spark.range(480).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    return lines, dim


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_lookup_equals_plain_join(spark, setting, how):
    lines, dim = hot_lines(spark)
    expected = rows_of(lines.join(dim, "k", how))
    assert rows_of(lookup.lookup_join(lines, dim, "k", how)) == expected
    setting(lookup.MAX_ROWS_KEY, 10)
    assert not lookup.fits_broadcast(dim)
    assert 7 in [r.k for r in lookup.hot_keys(lines, "k").collect()]
    assert rows_of(lookup.lookup_join(lines, dim, "k", how)) == expected


def test_salting_spreads_the_hot_key(spark, setting):
    setting(lookup.MAX_ROWS_KEY, 10)
    setting("spark.sql.autoBroadcastJoinThreshold", -1)
    setting("spark.sql.adaptive.enabled", "false")
    lines, dim = hot_lines(spark)
    joined = lookup.lookup_join(lines, dim, "k", "inner")
    parts = joined.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1
    assert max(r["count"] for r in parts) < 2000 * 0.7


@pytest.fixture
def shuffled(setting):
    """Joins as beyond the broadcast bound, without run-time changes."""
    setting(lookup.MAX_ROWS_KEY, 10)
    setting("spark.sql.autoBroadcastJoinThreshold", -1)
    setting("spark.sql.adaptive.enabled", "false")


def parts_of(df):
    return {r["p"]: r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()}


@pytest.mark.parametrize("others", [500, 1])
def test_rows_without_a_key_are_spread(spark, shuffled, others):
    lines = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, F.col("id") % others).alias("k"), F.col("id").alias("v"))
    dim = spark.range(480).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    joined = lookup.lookup_join(lines, dim, "k", "left")
    assert rows_of(joined) == rows_of(lines.join(dim, "k", "left"))
    found = joined.select(F.spark_partition_id().alias("p"), "k").collect()
    sizes = Counter(r.p for r in found if r.k is None)
    assert len(sizes) == 4 and max(sizes.values()) < 3000 * 0.5


def test_hot_product_only_among_the_asked_orders_and_in_one_order(frame, spark, shuffled):
    # Product 1 is rare in all lines, but fills the one order asked for.
    items = spark.range(20_000).select(
        F.when(F.col("id") < 2000, F.lit(1)).otherwise(F.col("id") % 900 + 2).cast("int").alias("product_id"),
        F.when(F.col("id") < 2000, F.lit(7)).otherwise(F.col("id") + 100).cast("int").alias("order_id"),
        (F.col("id") % 50 + 1).cast("int").alias("quantity"), F.col("id").cast("int").alias("order_item_id"))
    products = spark.range(1000).select(
        F.col("id").cast("int").alias("product_id"), F.lit("s").alias("sku"), F.lit("n").alias("product_name"))
    stock = frame("product_id int, location_id int, quantity_reserved int",
                  *[(p, loc, 1) for p in range(40) for loc in range(1, 4)])
    rooms = frame("location_id int, zone string, aisle int, shelf int, bin int", *[(i, "A", 1, 1, i) for i in range(40)])
    rows = lookups.pick_rows(frame("order_id int", (7,)), items, products, stock, rooms)
    parts = parts_of(rows)
    assert sum(parts.values()) == 6000
    assert len(parts) > 1 and max(parts.values()) < 6000 * 0.8


def test_broadcast_bounds(spark, setting):
    texts = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("t"))
    assert lookup.fits_broadcast(texts)
    setting(lookup.MAX_BYTES_KEY, 50_000)
    assert not lookup.fits_broadcast(texts)


def test_running_totals_equal_one_window(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id") % 40).alias("k"),
        ((F.col("id") * 7919) % 5003).alias("seq"),
        (F.col("id") % 11).alias("v"),
    )
    blocks = with_blocks(rows, ["k", "seq"], 6)
    got = running(blocks, ["k"], ["seq"], sums={"s": F.col("v")}, latest={"m": F.col("v")})
    w = Window.partitionBy("k").orderBy("seq")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    expected = rows.select(
        "k", "seq", "v", F.coalesce(F.sum("v").over(before), F.lit(0)).alias("s"),
        F.max("v").over(w).alias("m"),
    )
    assert rows_of(got.drop(BLOCK)) == rows_of(expected)
    sizes = [r["count"] for r in blocks.groupBy(BLOCK).count().collect()]
    assert len(sizes) == 6 and max(sizes) < 5000 / 6 * 1.6  # the hot key spans blocks


def first_come(supplies, demands):
    """Sequential allocation of one key: [(supply id, amount)], [(demand id, amount)]."""
    left = [list(s) for s in supplies]
    out = []
    for demand, amount in demands:
        for bin_ in left:
            take = min(amount, bin_[1])
            if take > 0:
                out.append((bin_[0], demand, take))
                bin_[1] -= take
                amount -= take
    return out


@pytest.mark.parametrize("seed", range(3))
def test_allocation_equals_sequential(spark, frame, seed):
    rng = random.Random(seed)
    supplies, demands, expected = [], [], []
    for key in range(12):
        # key 0 is hot on both sides
        n = 300 if key == 0 else rng.randint(0, 6)
        s = [(i, rng.choice([0, 1, 3, 10, 50])) for i in range(n)]
        d = [(j, rng.choice([0, 1, 2, 5, 40])) for j in range(n if key == 0 else rng.randint(0, 6))]
        supplies += [(key, *x) for x in s]
        demands += [(key, *x) for x in d]
        expected += [(key, *x) for x in first_come(s, d)]
    supply = laid_out(frame("k int, s int, q int", *supplies), ["k"], ["s"], "q")
    demand = laid_out(frame("k int, d int, q int", *demands), ["k"], ["d"], "q")
    got = allocate(supply, demand, ["k"], ["s"], ["d"])
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)


@pytest.mark.parametrize("hot_rows", [500_000, 25, 1])
def test_allocation_cuts_only_hot_keys_into_blocks(frame, monkeypatch, hot_rows):
    monkeypatch.setattr(allocation, "HOT_ROWS", hot_rows)
    blocks = []
    monkeypatch.setattr(allocation, "with_blocks", lambda *a: blocks.append(1) or with_blocks(*a))
    rng = random.Random(5)
    sides = [[(k, i, rng.choice([0, 1, 4, 9, None])) for k in (1, 2, 3, None) for i in range(30 if k == 1 else 5)]
             for _ in "sd"]
    expected = []
    for k in (1, 2, 3, None):
        expected += [(k, *x) for x in first_come(*[[(i, q or 0) for key, i, q in side if key == k] for side in sides])]
    got = allocate(laid_out(frame("k int, s int, q int", *sides[0]), ["k"], ["s"], "q"),
                   laid_out(frame("k int, d int, q int", *sides[1]), ["k"], ["d"], "q"), ["k"], ["s"], ["d"])
    assert rows_of(got) == sorted(expected, key=lambda t: [(v is None, str(v)) for v in t])
    assert len(blocks) == (0 if hot_rows > 25 else 3)


def sequential(lines, levels):
    """Decisions request by request; lines: (seq, resource, need, delta)."""
    level = dict(levels)
    decisions = {}
    for seq in sorted({line[0] for line in lines}):
        mine = [line for line in lines if line[0] == seq]
        decisions[seq] = all(n is None or level.get(r, 0) >= n for _, r, n, _ in mine)
        if decisions[seq]:
            for _, r, _, delta in mine:
                level[r] = level.get(r, 0) + delta
    return decisions


@pytest.mark.parametrize("seed, rounds, rows", [(0, 2, 500_000), (1, 1, 500_000), (2, 1, 12), (3, 100, 1)])
def test_decisions_equal_sequential(frame, monkeypatch, seed, rounds, rows):
    """Also where components are asked for at once, are too large, or are never asked for."""
    monkeypatch.setattr(resolve, "ROUNDS", rounds)
    monkeypatch.setattr(resolve, "COMPONENT_ROWS", rows)
    rng = random.Random(seed)
    resources = ["hot"] + [f"r{i}" for i in range(5)]
    lines = []
    for seq in range(120):
        touched = rng.sample(resources[1:], rng.randint(1, 2))
        touched += ["hot"] if rng.random() < 0.5 else []
        for r in touched:
            amount = rng.randint(1, 9)
            if rng.random() < 0.3:
                lines.append((seq, r, None, amount))
            else:
                lines.append((seq, r, amount, -amount))
    levels = [(r, rng.randint(0, 60)) for r in resources[:-1]]
    got = resolve.resolve(
        frame("seq bigint, resource string, need int, delta int", *lines),
        frame("resource string, level int", *levels),
    )
    assert {r.seq: r.accepted for r in got.collect()} == sequential(lines, levels)


def test_rounds_need_no_blocks_without_hot_resources(frame, monkeypatch):
    """Every round deals what is in doubt by resource."""
    monkeypatch.setattr(resolve, "ROUNDS", 100)
    monkeypatch.setattr(resolve, "with_blocks", lambda *_: pytest.fail("rows were cut into blocks"))
    rng = random.Random(8)
    lines = [(seq, r, n, -n) for seq in range(60) for r in rng.sample("abcd", 2) for n in [rng.randint(1, 9)]]
    levels = [(r, 40) for r in "abc"]
    got = resolve.resolve(frame("seq bigint, resource string, need int, delta int", *lines),
                          frame("resource string, level int", *levels))
    assert {r.seq: r.accepted for r in got.collect()} == sequential(lines, levels)


def test_a_long_chain_takes_few_rounds(frame, monkeypatch):
    """Each request waits for the one before; the end of the chain hangs on its beginning."""
    calls = []
    plain = resolve._round
    monkeypatch.setattr(resolve, "_round", lambda state: calls.append(1) or plain(state))
    lines = [(0, "r0", 5, -5)]
    for seq in range(1, 200):
        lines += [(seq, f"r{seq - 1}", 1, -1), (seq, f"r{seq}", None, 1)]
    levels = [(f"r{i}", 0 if i else 5) for i in range(200)]
    got = resolve.resolve(frame("seq bigint, resource string, need int, delta int", *lines),
                          frame("resource string, level int", *levels))
    assert {r.seq: r.accepted for r in got.collect()} == sequential(lines, levels)
    assert len(calls) <= 3


@pytest.mark.parametrize("seed", range(2))
def test_components_equal_walking(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(None, 3), (7, 7), edges[0]]
    near = {}
    for a, b in edges:
        if a is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for start in sorted(near):
        queue = [start] if start not in want else []
        while queue:
            node = queue.pop()
            if node not in want:
                want[node] = start
                queue += near[node]
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_one_row_keeps_columns_of_empty_frames(frame):
    a = frame("x int", (1,))
    b = frame("y string")
    assert [tuple(r) for r in one_row(a, b).collect()] == [(1, None)]


@pytest.mark.parametrize("hot_rows", [500_000, 20])
def test_resources_that_never_run_short_are_not_ordered(frame, monkeypatch, hot_rows):
    """Blocks are made for hot resources only, and rounds for none; repeated rows of a request count once."""
    monkeypatch.setattr(resolve, "HOT_ROWS", hot_rows)
    blocks = []
    monkeypatch.setattr(resolve, "with_blocks", lambda *a: blocks.append(1) or with_blocks(*a))
    lines = [(seq, r, 2, -2) for seq in range(30) for r in ("hot", f"r{seq % 7}")]
    lines += [(40, "r1", 5, -5), (40, "r1", None, 5), (41, "r9", 1, -1), (None, "r2", 90, -90)]
    levels = [("hot", 60), *[(f"r{i}", 15) for i in range(7)]]
    got = resolve.refused(frame("seq bigint, resource string, need int, delta int", *lines),
                          frame("resource string, level int", *levels), merge=True)
    assert [r.seq for r in got.collect()] == [41]
    assert len(blocks) == (hot_rows == 20)


@pytest.mark.parametrize("seed", range(2))
def test_decisions_with_hot_resources_equal_sequential(frame, monkeypatch, seed):
    monkeypatch.setattr(resolve, "HOT_ROWS", 25)
    rng = random.Random(seed)
    lines = []
    for seq in range(80):
        for r in rng.sample(["hot", "r1", "r2", "r3"], 2):
            amount = rng.randint(1, 9)
            lines.append((seq, r, None, amount) if rng.random() < 0.4 else (seq, r, amount, -amount))
    levels = [("hot", 20), ("r1", 15)]
    got = resolve.resolve(frame("seq bigint, resource string, need int, delta int", *lines),
                          frame("resource string, level int", *levels))
    assert {r.seq: r.accepted for r in got.collect()} == sequential(lines, levels)


def test_pick_list_orders_rows_in_blocks_for_large_orders_only(frame, monkeypatch):
    items = [(o, p, 1 + p % 3) for o in (1, 2) for p in range(1, 13) if o == 1 or p < 4]
    bins = [(p, loc, 9, 1 + loc % 2, 0) for p in range(1, 13) for loc in range(1, 2 + p)]
    args = (
        frame("order_id int", (1,), (2,)), frame("order_id int, product_id int, quantity int", *items),
        frame("product_id int, sku string, product_name string", *[(p, f"s{p}", f"n{p}") for p in range(1, 13)]),
        frame("product_id int, location_id int, quantity_on_hand int, quantity_reserved int, quantity_allocated int",
              *bins),
        frame("location_id int, zone string, aisle int, shelf int, bin int",
              *[(loc, "AB"[loc % 2], loc % 3, 1, loc) for loc in range(1, 15)]),
    )
    blocks = []
    monkeypatch.setattr(lookups, "with_blocks", lambda *a: blocks.append(1) or with_blocks(*a))
    plain = rows_of(lookups.pick_list(*args))
    assert not blocks
    expected = rows_of(lookups.pick_rows(*args).withColumn(
        "pick_sequence", F.row_number().over(Window.partitionBy("order_id").orderBy(
            "zone", "aisle", "shelf", "bin", "location_id", "product_id", "quantity")))
        .select("order_id", "product_id", "location_id", "quantity", F.col("pick_sequence").cast("bigint")))
    short = lookups.pick_list(*args).select("order_id", "product_id", "location_id", "quantity", "pick_sequence")
    assert rows_of(short) == expected
    monkeypatch.setattr(lookups, "ORDER_PARTS", 15)
    assert rows_of(lookups.pick_list(*args)) == plain
    assert len(blocks) == 1


def test_pick_list_carries_bins_as_ids_where_places_fit_a_broadcast(frame, setting, monkeypatch):
    args = (
        frame("order_id int", (1,), (2,), (2,), (None,)),
        frame("order_id int, product_id int, quantity int", (1, 1, 5), (1, 2, 1), (2, 1, 3), (2, 1, 3), (2, None, 1),
              (None, 1, 1), (1, 9, 1)),
        frame("product_id int, sku string, product_name string", (1, "s1", None), (2, None, "n2"), (2, "t2", "n2"),
              (None, "x", "x")),
        frame("product_id int, location_id int, quantity_on_hand int, quantity_reserved int, quantity_allocated int",
              *[(p, loc, 9, 1, 0) for p in (1, 2, None) for loc in (1, 2, 2, 3, None, 77)], (1, 4, 9, 0, 0)),
        frame("location_id int, zone string, aisle int, shelf int, bin int", (1, "B", 1, 1, 1), (2, "A", 2, 1, 2),
              (3, None, 1, 1, 3), (3, "A", None, 1, 3), (None, "A", 1, 1, 1), (4, "A", 1, 1, 4)),
    )
    columns = ["order_id", "product_id", "location_id", "zone", "aisle", "quantity", "sku", "product_name"]
    kept, plain = [], Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df: kept.append(df.schema.simpleString()) or plain(self, df))
    got = lookups.pick_list(*args)
    assert kept and not any("zone" in schema for schema in kept)
    numbers = [(r[0], r[1]) for r in sorted(rows_of(got.select("order_id", "pick_sequence")))]
    assert numbers == [(1, n) for n in range(1, 16)] + [(2, n) for n in range(1, 11)]
    assert Counter(rows_of(got.select(*columns))) == Counter(rows_of(lookups.pick_rows(*args).select(*columns)))
    setting(lookup.MAX_ROWS_KEY, 0)
    early = lookups.pick_list(*args)
    assert early.columns == got.columns
    assert Counter(rows_of(early.select(*columns))) == Counter(rows_of(got.select(*columns)))
    assert any("zone" in schema for schema in kept)
