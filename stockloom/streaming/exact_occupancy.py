"""Occupied space per location from a stream, each change counted once, without state in memory.

The ids of the changes that were counted lie in files by day. A micro batch reads the days that
occur in it and counts what is not among them. Its ids and its totals are written below the batch's
own number and become valid with one marker file, so a batch that Spark repeats after a failure is
counted once. Every ``compact_every`` batches the totals and ids are put together; with a lateness,
days that lie further back than that are dropped then. Changes older than the lateness cannot be
told from repeated ones: they are not counted, but kept aside.

    root/done/<batch>.json, root/compact/<batch>.json        what is valid
    root/batches/<batch>/ids/day=<day>, .../delta            of one batch
    root/compacted/<batch>/ids/day=<day>, .../totals         of all up to a batch
    root/late/batch=<batch>                                  set aside
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockloom.operators.occupancy import occupancy_delta
from stockloom.plans.scratch import Scratch
from stockloom.session import scratch_path
from stockloom.sources.files import Files

IDS = "change_id bigint, day int"
DELTA = "location_id bigint, delta bigint"
CHANGE = "change_id bigint, changed_at timestamp, location_id bigint, old_total bigint, new_total bigint"
NO_DAY = -(2**31)  # of changes without a time, which are never late


class ExactTotals:
    def __init__(self, spark: SparkSession, root: str, lateness_days: int | None = None, compact_every: int = 20):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)
        self.lateness, self.every = lateness_days, compact_every

    # ---- what is stored

    def _numbers(self, kind: str) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(f"{self.root}/{kind}") if n.endswith(".json"))

    def _base(self) -> int:
        return max(self._numbers("compact"), default=-1)

    def _after(self, base: int) -> list[int]:
        return [b for b in self._numbers("done") if b > base]

    def _newest_day(self) -> int | None:
        kept = [json.loads(self.files.text(f"{self.root}/done/{b}.json"))["newest_day"]
                for b in self._numbers("done")[-1:]]
        return kept[0] if kept else None

    def _horizon(self) -> int | None:
        """The first day that can still be told apart; earlier ones are late."""
        newest = self._newest_day()
        return None if self.lateness is None or newest is None else newest - self.lateness

    def _ids(self) -> DataFrame:
        base = self._base()
        paths = [f"{self.root}/compacted/{base}/ids"] if base >= 0 else []
        paths += [f"{self.root}/batches/{b}/ids" for b in self._after(base)]
        if not paths:
            return self.spark.createDataFrame([], IDS)
        reads = [self.spark.read.schema(IDS).option("basePath", p).parquet(p) for p in paths]
        return reduce(DataFrame.unionByName, reads)

    def totals(self) -> DataFrame:
        """(location_id, current_capacity) of all changes counted so far."""
        return self._summed().withColumnRenamed("delta", "current_capacity")

    def _summed(self) -> DataFrame:
        base = self._base()
        paths = [f"{self.root}/compacted/{base}/totals"] if base >= 0 else []
        paths += [f"{self.root}/batches/{b}/delta" for b in self._after(base)]
        if not paths:
            return self.spark.createDataFrame([], DELTA)
        return self.spark.read.schema(DELTA).parquet(*paths).groupBy("location_id").agg(
            F.sum("delta").alias("delta"))

    def late(self) -> DataFrame:
        """Changes that came too late to be counted, with the batch that brought them."""
        if not self.files.names(f"{self.root}/late"):
            return self.spark.createDataFrame([], f"{CHANGE}, batch bigint")
        return self.spark.read.schema(f"{CHANGE}, batch bigint").parquet(f"{self.root}/late")

    # ---- adding

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Count one micro batch: change_id, changed_at, location_id, old_total, new_total.

        A change without an id cannot be told from others and always counts; one without a time
        is looked up among its like. A null total is 0.
        """
        if batch_id in self._numbers("done") or batch_id <= self._base():
            return
        own, aside = f"{self.root}/batches/{batch_id}", f"{self.root}/late/batch={batch_id}"
        self.files.remove(own)
        self.files.remove(aside)
        work = Scratch(self.spark, "stream")
        rows = batch.select(
            F.col("change_id").cast("bigint").alias("change_id"),
            F.col("changed_at").cast("timestamp").alias("changed_at"),
            F.col("location_id").cast("bigint").alias("location_id"),
            *[F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(c) for c in ("old_total", "new_total")],
        ).withColumn("day", F.coalesce(F.unix_date(F.to_date("changed_at")), F.lit(NO_DAY)))
        # Repeated ids of this batch count once; rows without an id stay apart by a number.
        alone = F.when(F.col("change_id").isNull(), F.monotonically_increasing_id())
        rows = work.keep(rows.withColumn("_alone", alone).dropDuplicates(["change_id", "_alone"]).drop("_alone"))
        days = [r.day for r in rows.select("day").distinct().collect()]
        horizon = self._horizon()
        if horizon is not None:
            old = (F.col("day") < horizon) & (F.col("day") != NO_DAY)
            if any(NO_DAY != d < horizon for d in days):
                rows.filter(old).drop("day").write.parquet(aside)
            rows, days = rows.filter(~old), [d for d in days if d >= horizon or d == NO_DAY]
        # Only files of days in this batch are opened.
        seen = self._ids().filter(F.col("day").isin(days)) if days else self._ids().limit(0)
        fresh = work.keep(rows.join(seen, ["day", "change_id"], "left_anti"))
        fresh.filter("change_id IS NOT NULL").select("change_id", "day").repartition(
            max(len(days), 1), "day").write.partitionBy("day").parquet(f"{own}/ids")
        occupancy_delta(fresh).write.parquet(f"{own}/delta")
        work.remove()
        newest = max((d for d in days if d != NO_DAY), default=None)
        before = self._newest_day()
        newest = before if newest is None else newest if before is None else max(newest, before)
        self.files.create(f"{self.root}/done/{batch_id}.json", json.dumps({"newest_day": newest}))
        if len(self._after(self._base())) >= self.every:
            self.compact(batch_id)

    def compact(self, batch_id: int) -> None:
        """Put totals and ids up to a counted batch together and remove what they came from."""
        target, horizon, base = f"{self.root}/compacted/{batch_id}", self._horizon(), self._base()
        gone = self._after(base)
        self.files.remove(target)
        ids = self._ids()
        if horizon is not None:
            ids = ids.filter((F.col("day") >= horizon) | (F.col("day") == NO_DAY))
        ids.repartition("day", F.pmod("change_id", F.lit(8))).write.partitionBy("day").parquet(f"{target}/ids")
        self._summed().write.parquet(f"{target}/totals")
        self.files.create(f"{self.root}/compact/{batch_id}.json", "{}")
        for number in gone:
            self.files.remove(f"{self.root}/batches/{number}")
            if number != batch_id:  # the newest marker also holds the newest day
                self.files.remove(f"{self.root}/done/{number}.json")
        if base >= 0:
            self.files.remove(f"{self.root}/compact/{base}.json")
            self.files.remove(f"{self.root}/compacted/{base}")
            if base not in gone:
                self.files.remove(f"{self.root}/done/{base}.json")

    def follow(self, changes: DataFrame, checkpoint: str, available_now: bool = False) -> StreamingQuery:
        writer = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.add)
        if available_now:
            writer = writer.trigger(availableNow=True)
        return writer.start()


def run_to_end(changes: DataFrame, lateness_days: int | None = None) -> DataFrame:
    """Count everything the stream holds now and return the totals."""
    spark = changes.sparkSession
    store = ExactTotals(spark, scratch_path(spark, "occupancy"), lateness_days)
    store.follow(changes, scratch_path(spark, "occupancy-checkpoint"), available_now=True).awaitTermination()
    return store.totals()
