"""Reading tables whose files may hold rows or columns that do not fit the data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.schema import SCHEMAS

CORRUPT = "_malformed_line"


@dataclass
class Checked:
    """good: rows that fit, with the table's schema. bad: all others as read, with ``reasons``.

    drift: (column, problem, found, expected) of the files' columns: missing, extra, type.
    """

    table: str
    good: DataFrame
    bad: DataFrame
    drift: DataFrame

    def report(self) -> DataFrame:
        """(table_name, reason, n_rows); a row with several reasons counts under each."""
        counts = self.bad.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(
            F.count(F.lit(1)).alias("n_rows"))
        return counts.select(F.lit(self.table).alias("table_name"), "reason", "n_rows")


def load_checked(spark: SparkSession, path: str, table: str, fmt: str = "parquet") -> Checked:
    """A table of the data model from files of any columns.

    Values are converted one by one: a row goes aside if a value that is there cannot be read as
    its column's type (``cast(column)``), or if a CSV line has too few or too many values
    (``malformed``; its values are not judged). Columns that the files lack are null, further ones
    are left out of the good rows. Nothing is thrown away and no row is in both parts.
    """
    if fmt == "csv":
        names = spark.read.option("header", "true").csv(path).columns
        texts = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
        # Lines are told from their number of values, so none may be skipped while reading.
        raw = spark.read.schema(texts).option("header", "true").option("mode", "PERMISSIVE").option(
            "columnNameOfCorruptRecord", CORRUPT).option("columnPruning", "false").csv(path)
    else:
        raw = spark.read.format(fmt).load(path)
        names = raw.columns
    expected = SCHEMAS[table]
    found = {f.name: f.dataType for f in raw.schema if f.name != CORRUPT}

    drift = [(f.name, "missing", None, f.dataType.simpleString()) for f in expected if f.name not in found]
    drift += [(c, "extra", k.simpleString(), None) for c, k in found.items() if c not in expected.names]
    drift += [(f.name, "type", found[f.name].simpleString(), f.dataType.simpleString()) for f in expected
              if fmt != "csv" and f.name in found and found[f.name] != f.dataType]

    typed, wrong = [], []
    for field in expected:
        if field.name not in found:
            typed.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(f"`{field.name}`")
        read = value.try_cast(field.dataType)
        typed.append(read.alias(field.name))
        if found[field.name] != field.dataType:
            wrong.append(F.when(value.isNotNull() & read.isNull(), F.lit(f"cast({field.name})")))
    reasons = F.array_compact(F.array(*wrong)) if wrong else F.array().cast("array<string>")
    if CORRUPT in raw.columns:
        reasons = F.when(F.col(CORRUPT).isNotNull(), F.array(F.lit("malformed"))).otherwise(reasons)
    judged = raw.withColumn("reasons", reasons)
    return Checked(
        table, judged.filter(F.size("reasons") == 0).select(*typed), judged.filter(F.size("reasons") > 0),
        spark.createDataFrame(drift, "column string, problem string, found string, expected string"))
