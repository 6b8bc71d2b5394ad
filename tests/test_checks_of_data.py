"""First divergence of the ledger, quarantine of rows, and work sessions."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from stockloom.operators import divergence, sessions
from stockloom.schema import SCHEMAS
from stockloom.sources import quarantine

START = datetime(2024, 1, 1)
ENTRIES = "product_id bigint, location_id bigint, at timestamp_ntz, entry_id bigint, amount int"
COUNTS = "product_id bigint, location_id bigint, at timestamp_ntz, quantity_on_hand int"


def day(n):
    return None if n is None else START + timedelta(days=n)


@pytest.mark.parametrize("seed", range(2))
def test_divergence_equals_walking(frame, seed):
    rng = random.Random(seed)
    entries, counts = [], []
    for number in range(400):  # one bin holds most entries
        place = (1, 1) if rng.random() < 0.6 else (rng.randint(1, 4), rng.randint(1, 2))
        entries.append((*place, day(rng.randint(0, 40)) if rng.random() < 0.97 else None, number, rng.choice([None, 1, -2, 5])))
    for place in {e[:2] for e in entries} | {(9, 9)}:
        for n in rng.sample(range(0, 45), 6):
            true = sum(e[4] or 0 for e in entries if e[:2] == place and e[2] is not None and e[2] <= day(n))
            off = rng.choice([0, 0, 1]) if place != (1, 1) else int(n > 30)
            counts.append((*place, day(n), None if rng.random() < 0.1 else true + off))
    counts.append((1, 1, None, 5))
    want = []
    for place in {c[:2] for c in counts}:
        good = None
        for _, _, at, held in sorted((c for c in counts if c[:2] == place and c[2] and c[3] is not None), key=lambda c: c[2]):
            own = [e for e in entries if e[:2] == place and e[2] is not None]
            balance = sum(e[4] or 0 for e in own if e[2] <= at)
            if held == balance:
                good = at
                continue
            first = min(((e[2], e[3]) for e in own if e[2] <= at and (good is None or e[2] > good)), default=(None, None))
            want.append((*place, at, held, balance, held - balance, good, first[1], first[0]))
            break
    got = divergence.first_divergence(frame(ENTRIES, *entries), frame(COUNTS, *counts))
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and want


def test_divergence_deals_rows_by_bin_and_cuts_only_hot_bins(frame, monkeypatch):
    rng = random.Random(3)
    entries = [((1, 1) if n % 2 else (rng.randint(1, 3), rng.randint(1, 3)))
               + (day(rng.randint(0, 30)), n, rng.choice([None, 1, 3])) for n in range(300)]
    entries += [(None, 1, day(1), 900, 5), (1, None, day(1), 901, 5), (2, 2, None, 902, 5), (2, 2, day(1), None, 5)]
    counts = [(p, q, day(n), rng.choice([0, 3, None])) for p in range(1, 5) for q in range(1, 4) for n in (0, 9, 9, 20)]
    args = (frame(ENTRIES, *entries), frame(COUNTS, *counts))
    blocks, plain = [], divergence.with_blocks
    monkeypatch.setattr(divergence, "with_blocks", lambda *a: blocks.append(1) or plain(*a))
    got = divergence.first_divergence(*args)
    # Entries and counts are shuffled once each, and not again for their sums.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "rangepartitioning" not in plan
    assert rows_of(got) and not blocks
    monkeypatch.setattr(divergence, "HOT_ROWS", 100)
    assert rows_of(divergence.first_divergence(*args)) == rows_of(got)
    assert len(blocks) == 1
    monkeypatch.setattr(divergence, "HOT_ROWS", 0)
    assert rows_of(divergence.first_divergence(*args)) == rows_of(got)


def test_divergence_of_nothing(frame):
    assert divergence.first_divergence(frame(ENTRIES), frame(COUNTS)).collect() == []
    got = divergence.first_divergence(frame(ENTRIES), frame(COUNTS, (1, 1, START, 4), (2, 2, START, 0)))
    assert rows_of(got) == [(1, 1, START, 4, 0, 4, None, None, None)]


def test_lines_that_do_not_fit_go_aside(spark, tmp_path):
    lines = ["category_id,category_name,color", "1,a,red", "two,b,blue", "3,c", "4,d,x,y", ",e,green", '5,"f, g",z']
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    read = quarantine.load_checked(spark, str(tmp_path / "t.csv"), "categories", "csv")
    assert read.good.schema == SCHEMAS["categories"]
    assert rows_of(read.good) == sorted([(1, "a", None), (5, "f, g", None), (None, "e", None)], key=lambda r: (r[0] is None, str(r[0])))
    assert rows_of(read.report()) == [("categories", "cast(category_id)", 1), ("categories", "malformed", 2)]
    assert rows_of(read.drift.select("column", "problem")) == [("color", "extra"), ("description", "missing")]
    assert read.bad.count() == 3 and {r.category_id for r in read.bad.collect()} >= {"two"}


def test_types_of_parquet_files_are_converted(spark, frame, tmp_path):
    rows = frame("category_id string, category_name int, description string", ("1", 5, None), ("x", 6, "d"), (None, 7, "e"))
    rows.write.parquet(str(tmp_path / "t"))
    read = quarantine.load_checked(spark, str(tmp_path / "t"), "categories")
    assert rows_of(read.good) == [(1, "5", None), (None, "7", "e")]
    assert rows_of(read.report()) == [("categories", "cast(category_id)", 1)]
    assert {(r.column, r.problem, r.found) for r in read.drift.collect()} == {
        ("category_id", "type", "string"), ("category_name", "type", "int")}
    # Tables that fit pass unchanged.
    frame("category_id bigint, category_name string, description string", (1, "a", None)).select(
        F.col("category_id"), "category_name", "description").write.parquet(str(tmp_path / "u"))
    fits = quarantine.load_checked(spark, str(tmp_path / "u"), "categories")
    assert fits.drift.collect() == [] and fits.bad.collect() == [] and rows_of(fits.good) == [(1, "a", None)]


def test_sessions_end_at_gaps(frame):
    at = [0, 30, 150, 271, 271, 272, None]
    orders = frame("order_id int, order_date timestamp_ntz, picking_employee_id int", *[
        (i, None if m is None else START + timedelta(minutes=m, seconds=20), 7) for i, m in enumerate(at)],
        (90, START, None), (91, START, 8))
    got = rows_of(sessions.work_sessions(orders, "picking_employee_id"))
    # 0, 30 and 150 go together, 271 comes 121 minutes later.
    assert [r[:4] for r in got] == [(7, 6, 2, 150 + 1 + 30), (8, 1, 1, 15)]
    assert got[1][4] == 4.0
    assert rows_of(sessions.work_sessions(orders.limit(0), "picking_employee_id")) == []
