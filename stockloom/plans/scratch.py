"""Intermediate tables in the shared folder that are removed when they are no longer read."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from stockloom.session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def run_once(spark: SparkSession) -> Iterator[None]:
    """For an execution whose plan is not run again: its shuffle files are removed when it ends."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


class Scratch:
    """Numbered Parquet tables below one new folder of the shared folder.

    A table cuts the lineage like a checkpoint and survives lost executors, but can be removed
    as soon as a later one replaces it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, scratch_path(spark, name)
        self.number = self.oldest = 0

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{self.number}"
        self.number += 1
        with run_once(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove_older(self) -> None:
        """Remove all tables but the newest."""
        for number in range(self.oldest, self.number - 1):
            self._delete(f"{self.base}/{number}")
        self.oldest = max(self.number - 1, 0)

    def remove(self) -> None:
        self._delete(self.base)

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
