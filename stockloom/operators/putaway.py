"""Receiving and put-away."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.operators.outcome import Event, Outcome, ledger_events, ledger_rows
from stockloom.plans.allocate import allocate, laid_out
from stockloom.plans.lookup import lookup_join
from stockloom.plans.resolve import resolve
from stockloom.plans.scan import saved
from stockloom.schema import NOTES

AISLE_ORDER = ["zone", "aisle", "shelf", "bin", "location_id"]


def op_put_away(receipts: DataFrame, locations: DataFrame) -> Outcome:
    """Fill free bin space in (zone, aisle, shelf, bin) order with each receipt in sequence.

    receipts: product_id, qty, employee_id, reference_id, seq (unique). A receipt may be
    split over bins and is refused whole when the space left does not hold it; later,
    smaller ones can still pass. All receipts share one run of bins, so sequence and bins
    are each one ordered axis, cut into blocks that many tasks work on.
    """
    asked = receipts.withColumn("seq", F.col("seq").cast("bigint"))
    room = locations.select(
        *AISLE_ORDER, (F.col("max_capacity") - F.col("current_capacity")).alias("free")
    ).filter("free > 0")
    valid = asked.filter("qty >= 0")
    whole = F.lit(0).alias("resource")
    verdicts = resolve(
        valid.select("seq", whole, F.col("qty").alias("need"), (-F.col("qty")).alias("delta")),
        room.groupBy(whole).agg(F.sum("free").alias("level")),
    )
    decisions = (
        asked.join(verdicts, "seq", "left")
        .withColumn("accepted", F.coalesce("accepted", F.lit(False)))
        .withColumn("reason", F.when(~F.col("accepted"), F.lit("no room")))
    )

    def effects():
        stored = decisions.filter("accepted").select(
            whole, "seq", "product_id", "qty", "employee_id", "reference_id"
        )
        placements = allocate(
            laid_out(room.withColumn("resource", F.lit(0)), ["resource"], AISLE_ORDER, "free"),
            laid_out(stored, ["resource"], ["seq"], "qty"),
            ["resource"],
            ["location_id"],
            ["seq", "product_id", "employee_id", "reference_id"],
        )
        placements = saved(placements.drop("resource"))
        ledger = ledger_rows(
            placements, "PUT_AWAY", location=F.col("location_id"),
            employee=F.col("employee_id"), reference=F.col("reference_id"),
            notes=NOTES["put_away"],
        )
        return ledger, {
            "placements": placements,
            "inventory_delta": placements.groupBy("product_id", "location_id").agg(
                F.sum("quantity").cast("bigint").alias("quantity_on_hand")
            ),
        }

    return Outcome(decisions, effects)


def op_receive(
    receipts: DataFrame, suppliers: DataFrame, products: DataFrame, locations: DataFrame
) -> Outcome:
    """Check in supplier shipments, then put away those that pass inspection.

    receipts: supplier_id, product_id, qty, reference_id, qa_passed, receiver_id,
    inspector_id, seq (unique). Unknown suppliers or products leave no trace; a failed
    inspection leaves a QUALITY_FAIL row only; a pass leaves a RECEIVING row and, without
    room, a STOCK_ADJUSTMENT row that names no bin.
    """
    asked = receipts.withColumn("seq", F.col("seq").cast("bigint"))
    known = lookup_join(
        asked, suppliers.select("supplier_id", F.lit(True).alias("has_supplier")),
        "supplier_id", "left"
    )
    known = lookup_join(
        known, products.select("product_id", F.lit(True).alias("has_product")),
        "product_id", "left"
    )
    # Read by the put-away, the decisions and the ledger: looked up once.
    checked = saved(known.withColumn(
        "refusal",
        F.when(F.col("has_supplier").isNull(), F.lit("unknown supplier"))
        .when(F.col("has_product").isNull(), F.lit("unknown product"))
        .when(~F.col("qa_passed"), F.lit("failed inspection")),
    ).drop("has_supplier", "has_product"))
    passed = checked.filter("refusal IS NULL")
    stored = op_put_away(
        passed.select(
            "product_id", "qty", F.col("receiver_id").alias("employee_id"), "reference_id", "seq"
        ),
        locations,
    )
    outcome = stored.decisions.select("seq", "accepted", "reason")
    decisions = (
        checked.join(outcome, "seq", "left")
        .withColumn("accepted", F.coalesce("accepted", F.lit(False)))
        .withColumn("reason", F.coalesce("refusal", "reason"))
        .drop("refusal")
    )
    refused = stored.decisions.filter("NOT accepted")
    reference = F.col("reference_id")

    def effects():
        failed = F.col("refusal") == "failed inspection"
        inspected = [
            Event("QUALITY_FAIL", failed, None, F.col("inspector_id"), reference, NOTES["qa_fail"]),
            Event(
                "RECEIVING", F.col("refusal").isNull(), None, F.col("receiver_id"), reference,
                NOTES["qa_pass"],
            ),
        ]
        no_room = ledger_rows(
            refused, "STOCK_ADJUSTMENT", "qty", employee=F.col("employee_id"),
            reference=reference, notes=NOTES["no_room"],
        )
        parts = [ledger_events(checked, inspected, "qty"), stored.ledger, no_room]
        return reduce(DataFrame.unionByName, parts), stored.changes

    return Outcome(decisions, effects)
