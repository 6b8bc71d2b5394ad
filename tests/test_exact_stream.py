"""The stream that counts each change once with its ids in files."""

import random
from datetime import datetime, timedelta

import pytest

from conftest import rows_of
from stockloom.operators import occupancy
from stockloom.sources.files import Files
from stockloom.streaming.exact_occupancy import CHANGE, ExactTotals

START = datetime(2024, 1, 1)


def made(seed, n, days=10):
    rng = random.Random(seed)
    return [(i, START + timedelta(days=rng.uniform(0, days)), rng.randint(1, 5), rng.randint(0, 9), rng.randint(0, 9))
            for i in range(n)]


def wanted(rows):
    total = {}
    for _, _, place, old, new in {r[0]: r for r in rows}.values():
        total[place] = total.get(place, 0) + new - old
    return sorted(total.items())


@pytest.mark.parametrize("every", [2, 100])
def test_late_and_repeated_changes_count_once(spark, frame, tmp_path, every):
    rows = made(1, 120)
    rng = random.Random(2)
    store = ExactTotals(spark, str(tmp_path), compact_every=every)
    for number in range(5):
        fresh = rows[number * 24 : number * 24 + 24]
        again = rng.sample(rows[: number * 24], 12) if number else []
        batch = frame(CHANGE, *fresh, *again, *fresh[:5])
        store.add(batch, number)
        store.add(batch, number)  # a batch repeated after it was done
    assert rows_of(store.totals()) == wanted(rows)
    assert rows_of(store.late()) == []


def test_a_batch_that_failed_half_way_is_done_again(spark, frame, tmp_path, monkeypatch):
    store = ExactTotals(spark, str(tmp_path))
    store.add(frame(CHANGE, *made(3, 10)), 0)
    rows = made(3, 30)
    with monkeypatch.context() as m:
        m.setattr(Files, "create", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.add(frame(CHANGE, *rows), 1)
    assert rows_of(store.totals()) == wanted(rows[:10])
    store.add(frame(CHANGE, *rows), 1)
    assert rows_of(store.totals()) == wanted(rows)


def test_ids_are_bounded_by_the_lateness(spark, frame, tmp_path):
    store = ExactTotals(spark, str(tmp_path), lateness_days=2, compact_every=1)
    for day in range(8):
        at = START + timedelta(days=day)
        store.add(frame(CHANGE, (day, at, 1, 0, 1), (100 + day, at, 2, 0, 1)), day)
        assert store._ids().count() <= 2 * 4
    # Inside the lateness a repeated change is told, beyond it is set aside.
    store.add(frame(CHANGE, (6, START + timedelta(days=6), 1, 0, 1), (1, START + timedelta(days=1), 1, 0, 1),
                    (200, START, 3, 0, 1)), 8)
    assert rows_of(store.totals()) == [(1, 8), (2, 8)]
    assert sorted(r.change_id for r in store.late().collect()) == [1, 200]
    # Only what is valid is kept on disk.
    assert len(Files(spark).names(f"{tmp_path}/compacted")) == 1
    assert Files(spark).names(f"{tmp_path}/batches") == []


def test_only_days_of_the_batch_are_read(spark, frame, tmp_path):
    store = ExactTotals(spark, str(tmp_path))
    rows = made(4, 200, days=30)
    store.add(frame(CHANGE, *rows), 0)
    ids = store._ids().filter("day = 19723")
    files = [f for f in ids._jdf.queryExecution().optimizedPlan().toString().split() if f]
    assert files and ids.count() == sum(r[1].date() == START.date() for r in rows)
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_odd_rows(spark, frame, tmp_path):
    store = ExactTotals(spark, str(tmp_path), lateness_days=1)
    store.add(frame(CHANGE), 0)
    store.add(frame(CHANGE, (None, START, 1, 0, 4), (None, START, 1, 0, 4), (5, None, 1, None, 2), (6, START, None, 1, 3)), 1)
    store.add(frame(CHANGE, (5, None, 1, None, 2), (None, None, 1, 0, 1)), 2)
    assert rows_of(store.totals()) == [(1, 11), (None, 2)]


def test_stream_equals_batch(spark, frame, tmp_path):
    rows = made(6, 300)
    source = str(tmp_path / "in")
    for part in (rows[200:], rows[:150], rows[100:250]):
        frame(CHANGE, *part).coalesce(1).write.mode("append").parquet(source)
    changes = spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", 1).parquet(source)
    store = ExactTotals(spark, str(tmp_path / "store"), compact_every=2)
    store.follow(changes, str(tmp_path / "cp"), available_now=True).awaitTermination()
    batch = occupancy.occupancy_delta(spark.read.parquet(source).dropDuplicates(["change_id"]))
    assert rows_of(store.totals()) == rows_of(batch) == wanted(rows)
