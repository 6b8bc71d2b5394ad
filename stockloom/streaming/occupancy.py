"""Occupied space per location kept up to date from a stream of stock changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockloom.operators.occupancy import occupancy_delta
from stockloom.session import scratch_path


def running_occupancy(changes: DataFrame, lateness: str) -> DataFrame:
    """Streaming total of (new_total - old_total) per location.

    changes: change_id, changed_at, location_id, old_total, new_total. A change delivered
    again within ``lateness`` counts once. Ids older than that are dropped, which bounds the
    state; changes that arrive later than that are left out, so give the longest delay.
    """
    timed = changes.withColumn("changed_at", F.col("changed_at").cast("timestamp"))
    once = timed.withWatermark("changed_at", lateness).dropDuplicatesWithinWatermark(["change_id"])
    return occupancy_delta(once)


def write_totals(
    totals: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Write the changed totals of every micro batch to its own folder below ``path``.

    A batch repeated after a failure replaces its folder, so every total is stored once.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = (
        totals.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def latest_totals(spark: SparkSession, path: str) -> DataFrame:
    """The newest total of every location from the stored batches."""
    stored = spark.read.option("basePath", path).parquet(path)
    return stored.groupBy("location_id").agg(
        F.max_by("delta", "batch_id").alias("current_capacity")
    )


def run_to_end(changes: DataFrame, lateness: str) -> DataFrame:
    """Process everything the stream holds now and return the totals."""
    spark = changes.sparkSession
    path = scratch_path(spark, "occupancy")
    checkpoint = scratch_path(spark, "occupancy-checkpoint")
    totals = running_occupancy(changes, lateness)
    write_totals(totals, path, checkpoint, available_now=True).awaitTermination()
    return latest_totals(spark, path)
