"""Where the ledger first departs from the counted stock."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom.plans.lookup import heavy_hashes
from stockloom.plans.scan import running, saved, with_blocks

BIN = ["product_id", "location_id"]
HOT_ROWS = 500_000  # entries and counts of one bin, beyond which they are cut into blocks
NAMED_BINS = 1_000  # that the sketch can name


def balances_at(entries: DataFrame, counts: DataFrame) -> DataFrame:
    """The counts (product_id, location_id, at, quantity_on_hand) with ``balance``: the sum of the
    bin's entries up to and including their time.

    entries: product_id, location_id, at, entry_id, amount (signed). Both are laid on one axis per bin
    and totals run along it in blocks, so a bin with a third of all entries fills many tasks and
    entries are never paired with counts. Rows without a bin or a time are left out.
    """
    axis = entries.select(
        *BIN, "at", F.lit(0).alias("kind"), F.col("entry_id").cast("bigint").alias("entry_id"),
        F.coalesce(F.col("amount").cast("bigint"), F.lit(0)).alias("amount"),
        F.lit(None).cast("bigint").alias("quantity_on_hand"),
    ).unionByName(counts.select(
        *BIN, "at", F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("entry_id"),
        F.lit(0).cast("bigint").alias("amount"), F.col("quantity_on_hand").cast("bigint").alias("quantity_on_hand"),
    )).dropna(subset=[*BIN, "at"])
    order = ["at", "kind", "entry_id"]
    placed = with_blocks(axis, [*BIN, *order])
    summed = running(placed, BIN, order, sums={"balance": F.col("amount")})
    return summed.filter("kind = 1").select(*BIN, "at", "quantity_on_hand", "balance")


def first_divergence(entries: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per bin of which a count differs from the ledger: the first such count, the last
    one before it that agreed, and the first entry between the two, with which it can have begun.

    (product_id, location_id, counted_at, quantity_on_hand, balance, gap, agreed_at, entry_id,
    entry_at); the entry is null where none lies between. Counts without a quantity say nothing.

    Entries and counts are dealt by bin once, and those of a bin are gone through in one task. A bin
    with more than HOT_ROWS of them is cut into blocks instead; a sketch names such bins, and which
    ones it names affects speed only.
    """
    entries = entries.select(*BIN, "at", "entry_id", "amount").dropna(subset=[*BIN, "at"])
    counts = counts.select(*BIN, "at", "quantity_on_hand").dropna()
    hot = heavy_hashes(entries.select(*BIN).unionByName(counts.select(*BIN)), BIN, HOT_ROWS, NAMED_BINS)
    if hot is None:
        found = _by_bin(entries, counts)
    else:
        place = F.xxhash64(*BIN) == F.col("_hot")
        plain, large = ([rows.join(F.broadcast(hot), place, how) for rows in (entries, counts)]
                        for how in ("left_anti", "left_semi"))
        found = _by_bin(*plain).unionByName(_in_blocks(*large))
    return found.select(
        *BIN, F.col("first.at").alias("counted_at"), F.col("first.quantity_on_hand").alias("quantity_on_hand"),
        F.col("first.balance").alias("balance"),
        (F.col("first.quantity_on_hand") - F.col("first.balance")).alias("gap"), "agreed_at",
        F.col("entry.entry_id").alias("entry_id"), F.col("entry.at").alias("entry_at"))


def _by_bin(entries: DataFrame, counts: DataFrame) -> DataFrame:
    """(product_id, location_id, first, agreed_at, entry), all rows of a bin in one task."""
    # Grouped and taken apart again: counts that come dealt by bin are not dealt once more.
    counts = counts.groupBy(*BIN).agg(
        F.collect_list(F.struct("at", F.col("quantity_on_hand").cast("bigint").alias("value"))).alias("c")
    ).select(*BIN, F.explode("c").alias("c"))
    axis = entries.select(
        *BIN, "at", F.lit(0).alias("kind"), "entry_id", F.coalesce(F.col("amount").cast("bigint"), F.lit(0)).alias("value"),
    ).repartition(*BIN).unionByName(counts.select(
        *BIN, "c.at", F.lit(1).alias("kind"), F.lit(None).cast(entries.schema["entry_id"].dataType).alias("entry_id"),
        "c.value",
    ))
    whole = Window.partitionBy(*BIN)
    before = whole.orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, -1)
    count = F.col("kind") == 1
    summed = axis.withColumn(
        "balance", F.coalesce(F.sum(F.when(~count, F.col("value"))).over(before), F.lit(0)))
    wrong = F.when(count & (F.col("value") != F.col("balance")),
                   F.struct("at", F.col("value").alias("quantity_on_hand"), "balance"))
    spans = summed.withColumn("first", F.min(wrong).over(whole)).filter("first IS NOT NULL")
    agreed = F.when(count & (F.col("value") == F.col("balance")) & (F.col("at") < F.col("first.at")), F.col("at"))
    spans = spans.withColumn("agreed_at", F.max(agreed).over(whole))
    between = ~count & (F.col("at") <= F.col("first.at")) & (
        F.col("agreed_at").isNull() | (F.col("at") > F.col("agreed_at")))
    return spans.groupBy(*BIN).agg(
        F.first("first").alias("first"), F.first("agreed_at").alias("agreed_at"),
        F.min(F.when(between, F.struct("at", "entry_id"))).alias("entry"))


def _in_blocks(entries: DataFrame, counts: DataFrame) -> DataFrame:
    """The same rows, for few bins with many entries or counts."""
    seen = saved(balances_at(entries, counts))
    wrong = seen.filter("quantity_on_hand <> balance").groupBy(*BIN).agg(
        F.min(F.struct("at", "quantity_on_hand", "balance")).alias("first"))
    agreed = (
        seen.filter("quantity_on_hand = balance").join(wrong, BIN)
        .filter(F.col("at") < F.col("first.at")).groupBy(*BIN).agg(F.max("at").alias("agreed_at"))
    )
    spans = saved(wrong.join(agreed, BIN, "left"))
    between = (
        entries.select(*BIN, "at", "entry_id").join(spans, BIN)
        .filter((F.col("at") <= F.col("first.at"))
                & (F.col("agreed_at").isNull() | (F.col("at") > F.col("agreed_at"))))
        .groupBy(*BIN).agg(F.min(F.struct("at", "entry_id")).alias("entry"))
    )
    return spans.join(between, BIN, "left").select(*BIN, "first", "agreed_at", "entry")
