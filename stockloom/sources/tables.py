"""Reading the tables of the data model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.schema import SCHEMAS


class EmptySource(ValueError):
    """Raised where a report would run on no orders or no products."""


def load(
    spark: SparkSession, path: str, fmt: str = "parquet", tables: list[str] | None = None
) -> dict[str, DataFrame]:
    """Tables below ``path``, one folder or file per table, with explicit schemas.

    Lazy: what an operator does not use is pruned from the scan.
    """
    options = {"header": "true"} if fmt == "csv" else {}
    root = path.rstrip("/")
    return {
        name: spark.read.format(fmt).schema(SCHEMAS[name]).options(**options).load(f"{root}/{name}")
        for name in tables or SCHEMAS
    }


def load_jdbc(
    spark: SparkSession,
    url: str,
    partitions: dict[str, tuple[str, int, int, int]],
    tables: list[str] | None = None,
    **options: str,
) -> dict[str, DataFrame]:
    """Tables of a database, each read in parallel slices of a numeric column.

    ``partitions``: table -> (column, lowest value, highest value, number of slices).
    """
    frames = {}
    for name in tables or SCHEMAS:
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", name)
        if name in partitions:
            column, low, high, slices = partitions[name]
            reader = reader.options(
                partitionColumn=column, lowerBound=str(low), upperBound=str(high),
                numPartitions=str(slices),
            )
        frames[name] = reader.options(**options).load()
    return frames


def row_presence(frames: dict[str, DataFrame]) -> DataFrame:
    """(table_name, has_rows) per table; reads at most one row of each partition."""
    checks = [
        df.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_rows")).select(
            F.lit(name).alias("table_name"), "has_rows"
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, checks)


def require_nonempty(**frames: DataFrame) -> None:
    """Refuse to report on empty tables; reads at most one row of each."""
    empty = [name for name, df in frames.items() if df.limit(1).isEmpty()]
    if empty:
        raise EmptySource(f"no rows in: {', '.join(empty)}")
