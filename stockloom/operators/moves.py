"""Moves of stock between bins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom.functions.scalars import available
from stockloom.operators.outcome import Outcome, ledger_rows
from stockloom.plans.lookup import lookup_join
from stockloom.plans.resolve import refused
from stockloom.plans.scan import saved
from stockloom.schema import MOVE_REFERENCE, NOTES


def op_move_stock(requests: DataFrame, inventory: DataFrame, locations: DataFrame) -> Outcome:
    """Move unreserved stock to bins with space, requests in sequence.

    requests: product_id, from_location, to_location, qty, employee_id, seq (unique). An
    accepted move also gives the destination stock and the source space for later ones.
    """
    asked = requests.withColumn("seq", F.col("seq").cast("bigint"))

    def resource(kind, product, location):
        return F.struct(
            F.lit(kind).alias("kind"), product.cast("bigint").alias("product_id"),
            location.cast("bigint").alias("location_id"),
        )

    def stock(product, location):
        return resource(0, product, location)

    def space(location):
        return resource(1, F.lit(-1), location)

    stock_levels = inventory.select(
        stock(F.col("product_id"), F.col("location_id")).alias("resource"),
        available().alias("level"), "product_id", "location_id",
    )
    space_levels = locations.select(
        space(F.col("location_id")).alias("resource"),
        (F.col("max_capacity") - F.col("current_capacity")).alias("level"), "location_id",
    )
    # Quantities are positive, so a source bin without a row (level 0) fails by itself; the
    # destination has to be looked up.
    known = locations.select(F.col("location_id").alias("to_location"), F.lit(True).alias("known"))
    valid = lookup_join(
        asked, known, "to_location", "left"
    )

    qty = F.col("qty").cast("bigint")
    source, target = F.col("from_location"), F.col("to_location")
    nothing = F.lit(None).cast("bigint")

    def effect(of, need, delta):
        return F.struct(of.alias("resource"), need.alias("need"), delta.alias("delta"))

    effects = F.array(
        effect(stock(F.col("product_id"), source), qty, -qty),
        effect(stock(F.col("product_id"), target), nothing, qty),
        effect(space(target), qty, -qty),
        effect(space(source), nothing, qty),
    )
    fits = F.coalesce(F.col("known") & (qty > 0) & F.col("seq").isNotNull(), F.lit(False))
    lines = valid.filter("known AND qty > 0").select("seq", F.explode(effects).alias("e")).select("seq", "e.*")
    no = refused(
        lines,
        stock_levels.select("resource", "level").unionByName(
            space_levels.select("resource", "level")
        ),
        merge=True,
    )
    # A sequence number is decided as a whole, should several requests have the same.
    fitting = F.max(fits).over(Window.partitionBy("seq"))
    decisions = saved(
        valid.join(no.withColumn("_refused", F.lit(True)), "seq", "left")
        .withColumn("accepted", F.col("_refused").isNull() & F.col("seq").isNotNull() & fitting)
        .withColumn(
            "reason",
            F.when(F.col("known").isNull(), F.lit("unknown destination"))
            .when(qty <= 0, F.lit("quantity not positive"))
            .when(~F.col("accepted"), F.lit("no stock or no space")),
        )
        .drop("known", "_refused")
    )
    def effects():
        moved = decisions.filter("accepted")
        out = moved.select("product_id", source.alias("location_id"), (-qty).alias("q"))
        into = moved.select("product_id", target.alias("location_id"), qty.alias("q"))
        delta = out.unionByName(into).groupBy("product_id", "location_id").agg(
            F.sum("q").cast("bigint").alias("quantity_on_hand")
        )
        ledger = ledger_rows(
            moved, "STOCK_ADJUSTMENT", "qty", location=target, employee=F.col("employee_id"),
            reference=F.lit(MOVE_REFERENCE),
            notes=F.concat(F.lit(NOTES["moved_from"]), source.cast("string")),
        )
        return ledger, {"inventory_delta": delta}

    return Outcome(decisions, effects)
