"""Sources, sinks, occupancy from snapshots and from a stream."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR, rows_of
from stockloom.operators import occupancy
from stockloom.queries import change_rows, stream_occupancy
from stockloom.schema import SCHEMAS
from stockloom.session import ensure_checkpoints, scratch_path, shared_dir
from stockloom.sources import sinks, tables
from stockloom.sources.warehouse import DERIVED, Warehouse, needed
from stockloom.streaming import occupancy as stream

INVENTORY = (
    "product_id int, location_id int, quantity_on_hand int, quantity_reserved int, "
    "quantity_allocated int"
)


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    ensure_checkpoints(spark)
    assert shared_dir(spark).rstrip("/") in spark.sparkContext.getCheckpointDir()


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_load_reads_what_was_written(spark, tmp_path, fmt):
    schema = SCHEMAS["categories"]
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], schema)
    df.write.format(fmt).option("header", "true").save(str(tmp_path / "categories"))
    loaded = tables.load(spark, str(tmp_path), fmt, ["categories"])["categories"]
    assert loaded.schema == schema
    assert rows_of(loaded) == rows_of(df)


def test_empty_tables_are_refused(frame):
    full, empty = frame("a int", (1,)), frame("a int")
    tables.require_nonempty(orders=full)
    with pytest.raises(tables.EmptySource, match="products"):
        tables.require_nonempty(orders=full, products=empty)


def test_ledger_batches_are_idempotent(spark, frame, tmp_path):
    rows = frame("transaction_type string, quantity int", ("PICKING", 1), ("PACKING", 2))
    for batch in ("1", "2", "2"):
        sinks.append_ledger(rows, str(tmp_path), batch)
    stored = spark.read.option("basePath", str(tmp_path)).parquet(f"{tmp_path}/batch_id=*")
    assert stored.groupBy("batch_id").count().count() == 2
    assert stored.count() == 4


def test_upsert_adds_and_inserts(frame):
    stock = frame(INVENTORY, (1, 1, 5, 2, 0))
    delta = frame("product_id int, location_id int, quantity_on_hand int",
                  (1, 1, -2), (1, 1, 1), (1, 2, 7))
    assert rows_of(sinks.upsert_inventory(stock, delta)) == [(1, 1, 4, 2, 0), (1, 2, 7, 0, 0)]


def test_snapshot_never_overwrites(frame, tmp_path):
    df = frame("a int", (1,))
    path = str(tmp_path / "s")
    assert sinks.write_snapshot(df, path).count() == 1
    with pytest.raises(Exception, match="exist"):
        sinks.write_snapshot(df, path)


def test_stored_tables_equal_derived_ones(spark):
    plain, stored = Warehouse(spark, SF_DIR), Warehouse(spark, SF_DIR).store("inventory", "returns_")
    assert rows_of(stored.inventory) == rows_of(plain.inventory)
    assert rows_of(stored.returns_) == rows_of(plain.returns_)
    assert needed(["shipments"]) == ["wh_orders0", "wh_orders", "shipments"]
    assert set(needed(list(DERIVED))) == set(DERIVED)


def test_occupancy_changes_lead_to_the_new_snapshot(frame):
    before = frame(INVENTORY, (1, 1, 5, 2, 1), (2, 1, 1, 0, 0), (3, 2, 4, 0, 0))
    after = frame(INVENTORY, (1, 1, 6, 2, 1), (3, 2, 4, 0, 0), (4, 3, 2, 1, 0))
    changes = occupancy.stock_changes(before, after)
    assert rows_of(changes) == [(1, 1, 0), (1, 8, 9), (3, 0, 3)]
    delta = occupancy.occupancy_delta(changes)
    locations = frame("location_id int, current_capacity int", (1, 9), (2, 4), (3, 0))
    assert rows_of(occupancy.apply_occupancy(locations, delta)) == [(1, 9), (2, 4), (3, 3)]
    assert rows_of(occupancy.op_occupancy(after)) == [(1, 9), (2, 4), (3, 3)]


CHANGES = (
    "change_id long, changed_at timestamp, location_id long, old_total long, new_total long"
)


@pytest.mark.parametrize("lateness", ["1 hour", "1 day"])
def test_stream_counts_a_change_once(spark, frame, tmp_path, lateness):
    source = tmp_path / "in"
    at = datetime(2024, 1, 1)
    first = [(1, at, 1, 0, 5), (2, at, 2, 0, 3)]
    again = [(2, at, 2, 0, 3), (3, at, 1, 5, 4)]
    checkpoint, path = str(tmp_path / "cp"), str(tmp_path / "out")
    for batch in (first, again):
        frame(CHANGES, *batch).coalesce(1).write.mode("append").parquet(str(source))
        changes = spark.readStream.schema(CHANGES).parquet(str(source))
        totals = stream.running_occupancy(changes, lateness)
        stream.write_totals(totals, path, checkpoint, available_now=True).awaitTermination()
    assert rows_of(stream.latest_totals(spark, path)) == [(1, 4), (2, 3)]


def test_stream_equals_batch(spark):
    rows = change_rows(Warehouse(spark, SF_DIR).driver("events"))
    source = scratch_path(spark, "changes")
    rows.repartition(3).write.parquet(source)
    changes = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    expected = rows_of(occupancy.occupancy_delta(rows))
    # No change is later than this: the files are read in any order of time.
    assert rows_of(stream.run_to_end(changes, "36500 days")) == expected


def test_stream_reads_a_folder_of_events_in_any_order_of_time(spark, tmp_path):
    events = Warehouse(spark, SF_DIR).driver("events")
    folder = str(tmp_path / "events.parquet")
    for days in (400, 0, 200):  # files come in this order, one a batch
        moved = events.withColumn("ts", F.col("ts") + F.expr(f"interval {days} days")).withColumn(
            "event_id", F.col("event_id") + days * 10**9)
        moved.select(events.columns).coalesce(1).write.mode("append").parquet(folder)
    expected = rows_of(occupancy.occupancy_delta(change_rows(spark.read.parquet(folder))))
    assert expected
    for files in (1, 1000):
        assert rows_of(stream_occupancy(spark, str(tmp_path), files)) == expected
    assert rows_of(stream_occupancy(spark, SF_DIR)) == rows_of(
        occupancy.occupancy_delta(change_rows(events)))
