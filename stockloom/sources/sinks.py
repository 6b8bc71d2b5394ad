"""Writing extracts, ledger rows and stock snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.plans.lookup import shuffle_partitions

# Names of the exported extracts.
BASE_EXTRACTS = [
    "products", "orders", "customers", "warehouse_locations", "employees", "suppliers",
    "transactions",
]
KPI_EXTRACTS = ["carrier_performance_kpi", "monthly_sales_trend", "kpi_summary_dashboard"]


def export_csv(frames: dict[str, DataFrame], path: str, names: list[str]) -> dict[str, str]:
    """Write each named frame as a CSV folder with header lines; returns the paths.

    Every task writes its own part file: nothing is gathered in one task.
    """
    written = {}
    for name in names:
        target = f"{path.rstrip('/')}/{name}"
        frames[name].write.mode("overwrite").option("header", "true").csv(target)
        written[name] = target
    return written


def append_ledger(rows: DataFrame, path: str, batch_id: str) -> None:
    """Append ledger rows under their batch id; writing a batch again replaces it.

    Partitions are ``batch_id`` and ``transaction_type``, so type filters prune files and a
    job repeated after a failure leaves no double rows.
    """
    (
        rows.write.mode("overwrite")
        .partitionBy("transaction_type")
        .parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
    )


def replace_ledger_months(rows: DataFrame, path: str) -> None:
    """Write ledger rows (transaction_type, at, ...) in the place of their types and months.

    A (type, month) that occurs in ``rows`` is replaced as a whole, all others stay, so a corrected
    or repeated batch of whole months is exact. Rows are dealt by type, month and a spread of
    their columns: a month with a third of the rows is written by several tasks.
    """
    spark = rows.sparkSession
    month = F.date_format("at", "yyyy-MM")
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(max(shuffle_partitions(spark) // 8, 1)))
    (
        rows.withColumn("month", month).repartition("transaction_type", "month", spread)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("transaction_type", "month").parquet(path)
    )


def ledger_of_months(ledger: DataFrame, months: DataFrame) -> DataFrame:
    """Ledger rows of the months in a table (month, ...), which may itself be filtered.

    The join is on the partition column, so the months that are left of the table when the query
    runs decide which folders of the ledger are opened.
    """
    return ledger.join(F.broadcast(months.select("month").distinct()), "month", "left_semi")


def upsert_inventory(inventory: DataFrame, delta: DataFrame) -> DataFrame:
    """Stock after adding changes, new (product, location) pairs included.

    ``delta`` has product_id, location_id and any of the quantity columns; several rows
    per bin are added up.
    """
    keys = ["product_id", "location_id"]
    amounts = ["quantity_on_hand", "quantity_reserved", "quantity_allocated"]
    missing = [c for c in amounts if c not in delta.columns]
    changes = delta.select(
        *keys, *[c for c in amounts if c in delta.columns], *[F.lit(0).alias(c) for c in missing]
    )
    return (
        inventory.select(*keys, *amounts)
        .unionByName(changes)
        .groupBy(*keys)
        .agg(*[F.sum(c).cast("bigint").alias(c) for c in amounts])
    )


def apply_updates(table: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """The rows of ``table`` with the columns of ``changes`` put in where the key matches.

    ``changes`` has one row per key, like the order, line and shipment changes of the stock
    rules; its other columns replace those of the same name, a null included. Keys that the
    table lacks are left out.
    """
    columns = [c for c in changes.columns if c not in key and c in table.columns]
    new = changes.select(*key, F.struct(*columns).alias("_new"))
    joined = table.join(new, key, "left")
    return joined.select(
        *[
            F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}").cast(table.schema[c].dataType))
            .otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in table.columns
        ]
    )


def add_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """New rows, like shipments, added to a table; columns they lack are null."""
    known = [F.col(c).cast(table.schema[c].dataType).alias(c) for c in table.columns if c in rows.columns]
    return table.unionByName(rows.select(*known), allowMissingColumns=True)


def write_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write a new snapshot to an unused path and read it back."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
