"""Session set-up, written tables and Arrow batches shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.session import ensure_checkpoints, scratch_path, tune

BATCH_ROWS = 2000
# Text bytes that a task turns into arrays at once; a longer text is a step of its own.
STEP_BYTES = 512 << 10
# Narrow rows that a task takes where ``few`` joins partitions.
TASK_ROWS = 100_000


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of the library, the shared folder, and Arrow batches of bounded rows."""
    tune(spark)
    ensure_checkpoints(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def few(df: DataFrame, rows: int, per: int = TASK_ROWS) -> DataFrame:
    """A frame of about ``rows`` rows in no more partitions than these need, ``per`` rows in each.

    The shuffle partitions are meant for the largest tables. Each of them costs a task and, where the
    rows are kept, a file, for which Hadoop starts a process that sets its mode.
    """
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, rows // per + 1))


class Work:
    """Tables of one run below the shared folder; ``drop`` removes those no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = prepare(spark)
        self.base = scratch_path(spark, name)

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write the rows as Parquet in the shared folder and read them back."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            fs.delete(path, True)


def shared(spark: SparkSession, value) -> Broadcast:
    """A dataclass instance as a broadcast of its plain fields.

    Broadcasts name classes by their module, which executors may lack; tasks make the instance
    anew with ``cls(**shared.value)``.
    """
    return spark.sparkContext.broadcast(dict(vars(value)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str, n: int):
    """crc32 of an id as text, modulo n; a null id counts as remainder 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n)), F.lit(0))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and its n + 1 offsets; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    first, last = int(bounds[0]), int(bounds[-1])
    return np.frombuffer(data, np.uint8)[first:last], bounds - first


def steps(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that one step holds about STEP_BYTES of text, whole rows only."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, bounds = text_buffer(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(bounds, bounds[start] + STEP_BYTES, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop
        # Workers serve many tasks: what a batch needed goes back to the system.
        pa.default_memory_pool().release_unused()
