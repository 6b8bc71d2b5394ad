"""Joins of a large table to a smaller one, safe against hot keys.

A lookup side that is proven small (its rows and bytes are counted first) is broadcast: the
large side is then not shuffled at all, so a hot key cannot hurt. Beyond the bound both sides
are shuffled, and keys with more rows than a mean partition are spread: their rows get as many
salts as the key fills partitions, and only their lookup rows are repeated once per salt. Rows
without a key match nothing and are spread over all partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.plans.scratch import run_once

MAX_ROWS_KEY = "spark.stockloom.broadcast.maxRows"
MAX_BYTES_KEY = "spark.stockloom.broadcast.maxBytes"
MAX_ROWS = 500_000
MAX_BYTES = 64 << 20

# Keys that a sketch can name at most, and counters it keeps per key named.
NAMED_KEYS = 10_000
COUNTERS = 40


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fits_broadcast(dim: DataFrame) -> bool:
    """True if the frame is within the row and byte bounds.

    Rows, text lengths and array sizes are added up inside the map tasks; no row is shuffled for it.
    """
    spark = dim.sparkSession
    max_rows = int(spark.conf.get(MAX_ROWS_KEY, str(MAX_ROWS)))
    max_bytes = int(spark.conf.get(MAX_BYTES_KEY, str(MAX_BYTES)))
    width = F.lit(16 * len(dim.columns)).cast("bigint")
    for field in dim.schema:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            width = width + 96 * F.coalesce(F.size(F.col(field.name)), F.lit(0))
    size: Row = dim.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")
    ).first()
    return size.n <= max_rows and size.b <= max_bytes


def hot_keys(fact: DataFrame, key: str) -> DataFrame | None:
    """(key, salts) of the keys with more rows than a mean partition, from one sketch pass.

    There are at most as many as partitions, and each gets four salts per partition it would
    fill, as salts can meet in one partition. The sketch has a fixed size and nothing is shuffled by key. Which keys are listed
    affects speed only, never the result. None if there are none.
    """
    spark = fact.sparkSession
    partitions = shuffle_partitions(spark)
    named = min(partitions, NAMED_KEYS)
    tracked = min(named * COUNTERS, 1_000_000)
    top = fact.agg(
        F.expr(f"approx_top_k({key}, {named}, {tracked})").alias("top"),
        F.count(F.lit(1)).alias("n"),
    )
    salts = F.ceil(4 * F.col("t.count") * partitions / F.col("n")).cast("int")
    rows = (
        top.select(F.explode("top").alias("t"), "n")
        .filter((F.col("t.count") * partitions > F.col("n")) & F.col("t.item").isNotNull())
        .select(F.col("t.item").alias(key), salts.alias("_salts"))
    )
    found = rows.collect()
    return spark.createDataFrame(found, rows.schema) if found else None


def heavy_hashes(rows: DataFrame, key: str | list[str], bound: int, named: int | None = None) -> DataFrame | None:
    """(_hot) xxhash64 of the keys with more than ``bound`` rows, from one sketch pass; None without any.

    For keys whose rows are better not gone through in one task. Which ones are named affects speed only.
    With ``named`` keys at most the rows are not counted before.
    """
    if named is None:
        n = rows.count()
        if n <= bound:
            return None
        named = min(n // bound + 1, NAMED_KEYS)
    with run_once(rows.sparkSession):
        top = rows.select(F.xxhash64(*([key] if isinstance(key, str) else key)).alias("_hot")).agg(
            F.expr(f"approx_top_k(_hot, {named}, {min(named * COUNTERS, 1_000_000)})").alias("top"))
        found = top.select(F.explode("top").alias("t")).filter(F.col("t.count") > bound).select("t.item").collect()
    return rows.sparkSession.createDataFrame([(r[0],) for r in found], "_hot bigint") if found else None


def lookup_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``fact`` to ``dim``, inner or left; several rows of ``dim`` may share a key."""
    if fits_broadcast(dim):
        return fact.join(F.broadcast(dim), key, how)
    hot = hot_keys(fact.select(key), key)
    spread = F.xxhash64(*fact.columns)
    everywhere = F.pmod(spread, F.lit(8 * shuffle_partitions(fact.sparkSession)))
    if hot is None:
        # Rows without a key are spread even so: they are kept, but have nothing to meet.
        salted = fact.withColumn("_salt", F.when(F.col(key).isNull(), everywhere).otherwise(0).cast("int"))
        # Always 0, but not a literal: with a literal the salt would drop out of the join key.
        zero = F.pmod(F.xxhash64(key), F.lit(1)).cast("int")
        return salted.join(dim.withColumn("_salt", zero), [key, "_salt"], how).drop("_salt")
    salts = F.coalesce("_salts", F.lit(1))
    salted = fact.join(F.broadcast(hot), key, "left").withColumn(
        "_salt",
        F.when(F.col(key).isNull(), everywhere).otherwise(F.pmod(spread, salts)).cast("int"),
    ).drop("_salts")
    repeated = dim.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))
    ).drop("_salts")
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")
