"""The versioned stock table: what is written, what stays readable, and who may write."""

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from stockloom.sources.files import Files
from stockloom.sources.sinks import upsert_inventory
from stockloom.sources.stock_store import Conflict, StockStore

INVENTORY = (
    "product_id int, location_id int, quantity_on_hand int, quantity_reserved int, "
    "quantity_allocated int"
)
DELTA = "product_id int, location_id int, quantity_on_hand int"


@pytest.fixture
def stock(spark):
    return spark.range(20_000).select(
        (F.col("id") % 500).cast("int").alias("product_id"), (F.col("id") / 500).cast("int").alias("location_id"),
        F.lit(9).alias("quantity_on_hand"), F.lit(2).alias("quantity_reserved"), F.lit(0).alias("quantity_allocated"))


def test_versions_equal_plain_merging(spark, frame, stock, tmp_path):
    store = StockStore(spark, str(tmp_path))
    store.create(stock, buckets=32)
    first = frame(DELTA, (1, 1, -2), (1, 1, 1), (1, 900, 7), (-5, None, 3))
    second = frame(INVENTORY, (1, 900, 1, 1, 1), (7, 7, 0, 5, None))
    assert store.merge(first, "a").version == 1
    assert store.merge(second, "b").version == 2
    after = [rows_of(stock)]
    for delta in (first, second):
        after.append(rows_of(upsert_inventory(spark.createDataFrame(after[-1], INVENTORY), delta.na.fill(0, [
            c for c in delta.columns if c.startswith("quantity")]))))
    for version, rows in enumerate(after):
        assert rows_of(store.stock(version)) == rows
    assert rows_of(store.stock()) == after[2]
    store.rebucket(5)
    assert rows_of(store.stock()) == after[2] and len(store.manifest().holders) == 5


def test_bytes_written_follow_the_change(spark, frame, stock, tmp_path):
    store, files = StockStore(spark, str(tmp_path)), Files(spark)
    made = store.create(stock, buckets=64)
    whole = files.size(f"{tmp_path}/stock/{made.folders[0]}")
    made = store.merge(frame(DELTA, (3, 3, 1)), "one bin")
    assert sum(f.startswith("000000000001") for f in made.folders) == 1
    assert made.holders.count(1) == 1 and made.holders.count(0) == 63
    one = files.size(f"{tmp_path}/stock/{made.folders[1]}")
    assert 0 < one < whole / 20
    # The plan reads the one bucket's file only.
    assert len(store._read(made, [made.holders.index(1)]).inputFiles()) == 1


def test_an_old_version_stays_readable_while_others_write(spark, frame, stock, tmp_path):
    store = StockStore(spark, str(tmp_path))
    store.create(stock, buckets=8)
    reader = store.stock()  # planned before, run after the changes
    units = stock.agg(F.sum("quantity_on_hand")).first()[0]
    for k in range(3):
        store.merge(frame(DELTA, (k, 1, 100)), str(k))
    assert reader.agg(F.sum("quantity_on_hand")).first()[0] == units
    assert store.stock().agg(F.sum("quantity_on_hand")).first()[0] == units + 300
    assert store.vacuum(keep=2) == [0, 1]
    assert store.versions() == [2, 3]
    for version in (2, 3):
        assert store.stock(version).agg(F.sum("quantity_on_hand")).first()[0] == units + 100 * version


def test_one_of_two_writers_fails_and_changes_nothing(spark, frame, stock, tmp_path):
    ledger = frame("transaction_type string, product_id int, quantity int", ("RECEIVING", 1, 5))
    store = StockStore(spark, str(tmp_path))
    store.create(stock, buckets=4)

    class Slow(StockStore):
        def _commit(self, made):
            if made.batch == "slow":
                store.merge(frame(DELTA, (1, 1, 10)), "fast", ledger)
            super()._commit(made)

    with pytest.raises(Conflict):
        Slow(spark, str(tmp_path)).merge(frame(DELTA, (1, 1, 1000)), "slow", ledger)
    assert store.versions() == [0, 1] and store.manifest().batch == "fast"
    assert store.stock().filter("product_id = 1 AND location_id = 1").first().quantity_on_hand == 19
    assert rows_of(store.ledger()) == [(1, 5, "RECEIVING", 1)]
    # Tried again from the new version, the change goes through; the lost folder can go.
    store.merge(frame(DELTA, (1, 1, 1000)), "slow", ledger)
    assert store.stock().filter("product_id = 1 AND location_id = 1").first().quantity_on_hand == 1019
    before = len(Files(spark).names(f"{tmp_path}/stock"))
    store.vacuum(keep=1)
    assert len(Files(spark).names(f"{tmp_path}/stock")) < before


def test_a_batch_is_applied_once_with_its_ledger(spark, frame, stock, tmp_path):
    ledger = frame("transaction_type string, product_id int, quantity int", ("RECEIVING", 1, 5), ("PICKING", 2, None))
    store = StockStore(spark, str(tmp_path))
    assert store.create(stock, buckets=4).version == 0 and store.ledger() is None
    for _ in range(2):
        assert store.merge(frame(DELTA, (1, 1, 5)), "x", ledger).version == 1
    store.merge(frame(DELTA), "nothing")
    assert store.versions() == [0, 1, 2]
    assert store.ledger(0) is None
    assert rows_of(store.ledger(1)) == rows_of(store.ledger(2)) == [(1, 5, "RECEIVING", 1), (2, None, "PICKING", 1)]


def test_sums_beyond_an_int(spark, frame, tmp_path):
    store = StockStore(spark, str(tmp_path))
    store.create(frame(INVENTORY, (1, 1, 2**31 - 1, 0, 0)), buckets=2)
    store.merge(frame(DELTA, (1, 1, 2**31 - 1), (1, 1, 5)), "a")
    assert rows_of(store.stock()) == [(1, 1, 2**32 + 3, 0, 0)]


def test_an_empty_table(spark, frame, tmp_path):
    store = StockStore(spark, str(tmp_path))
    assert store.create(frame(INVENTORY)).holders.count(-1) == len(store.manifest().holders)
    assert rows_of(store.stock()) == []
    store.merge(frame(DELTA, (4, 4, 4)), "a")
    assert rows_of(store.stock()) == [(4, 4, 4, 0, 0)]
