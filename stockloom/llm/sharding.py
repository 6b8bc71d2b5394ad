"""Sharding over fixed virtual slots.

Records are hashed into a few thousand slots, bytes are added up per slot, and a small table
maps every slot to a shard. The table has versions: version 0 deals the slots round robin;
rebalancing edits the newest version, moving only slots out of shards above the mean, and
stores the result as the next one. Records never need another hash, only the newest map.

The map has one row per slot, a parameter, so it is the one thing collected and broadcast.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm.common import Work
from stockloom.plans.scan import running, with_blocks

MAP = "version int, slot int, shard int, bytes bigint"


@dataclass(frozen=True)
class Params:
    slots: int = 4096
    shards: int = 16


def slotted(docs: DataFrame, slots: int) -> DataFrame:
    """doc_id, size, text_crc32 and the virtual slot of every record.

    The slot hashes the id and the text's checksum, so rows without an id spread too.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
    ).withColumn("virtual", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int"))


def slot_bytes(records: DataFrame) -> DataFrame:
    return records.groupBy("virtual").agg(F.sum("size").alias("bytes"))


def first_map(slots: int, shards: int) -> dict[int, int]:
    return {slot: slot % shards for slot in range(slots)}


def rebalanced(current: dict[int, int], sizes: dict[int, int], shards: int) -> dict[int, int]:
    """An edited map: near-equal bytes per shard with few moves.

    Every shard keeps its slots, largest first, as far as they fit under the mean; the others
    go, largest first, to whichever shard is lightest. Shards beyond those in use may be
    added; a slot of a removed shard always moves.
    """
    mean = sum(sizes.values()) / shards
    load = [0] * shards
    edited: dict[int, int] = {}
    moving: list[tuple[int, int]] = []
    for slot in sorted(current, key=lambda s: (-sizes.get(s, 0), s)):
        size, shard = sizes.get(slot, 0), current[slot]
        if shard < shards and load[shard] + size <= mean:
            edited[slot], load[shard] = shard, load[shard] + size
        else:
            moving.append((size, slot))
    lightest = [(bytes_, shard) for shard, bytes_ in enumerate(load)]
    heapq.heapify(lightest)
    for size, slot in moving:
        bytes_, shard = heapq.heappop(lightest)
        edited[slot] = shard
        heapq.heappush(lightest, (bytes_ + size, shard))
    return edited


class SlotMaps:
    """The versions of a slot map, one Parquet folder each, under one path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def store(self, version: int, shards: dict[int, int], sizes: dict[int, int]) -> DataFrame:
        rows = [(version, s, shards[s], sizes.get(s, 0)) for s in sorted(shards)]
        folder = f"{self.path}/version={version}"
        self.spark.createDataFrame(rows, MAP).coalesce(1).drop("version").write.mode(
            "overwrite").parquet(folder)
        return self.load(version)

    def load(self, version: int) -> DataFrame:
        return self.spark.read.schema("slot int, shard int, bytes bigint").parquet(
            f"{self.path}/version={version}")

    def as_dict(self, version: int) -> dict[int, int]:
        return {r.slot: r.shard for r in self.load(version).select("slot", "shard").collect()}


def placed(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Records with the shard of their virtual slot; the map is one row per slot."""
    shards = slot_map.select(F.col("slot").alias("virtual"), "shard")
    return records.join(F.broadcast(shards), "virtual")


def shard(docs: DataFrame, p: Params | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot) for every row.

    ``docs``: doc_id, text; other columns are ignored. ``size`` is the text's UTF-8 bytes plus
    1 (null: 1). The law is ``bytes``: shards hold near-equal sums of ``size``. ``slot`` is the
    row's place in its shard, 0, 1, 2, ... without gaps, in the order of virtual slot and
    doc_id. ``grown_shard`` is null, as it belongs to another law.

    Every row is placed, also repeated ones and those without an id or text. Rows equal in id
    and text share a virtual slot. An empty table gives no rows.
    """
    p = p or Params()
    work = Work(docs.sparkSession, "sharding")
    records = work.keep(slotted(docs, p.slots), "records")
    sizes = {r.virtual: r.bytes for r in slot_bytes(records).collect()}  # one row per slot
    maps = SlotMaps(work.spark, work.path("map"))
    maps.store(0, first_map(p.slots, p.shards), sizes)
    newest = maps.store(1, rebalanced(maps.as_dict(0), sizes, p.shards), sizes)

    rows = placed(records, newest).withColumn("_row", F.monotonically_increasing_id())
    order = ["virtual", "doc_id", "text_crc32", "_row"]
    # Places are counted over ranges of the order, so no task sees a whole shard.
    numbered = running(with_blocks(rows, ["shard", *order]), ["shard"], order,
                       sums={"slot": F.lit(1).cast("bigint")})
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.col("virtual").alias("virtual_slot"),
    )


def loads(shards: Iterable[tuple[int, int]]) -> dict[int, int]:
    """Bytes per shard of (shard, bytes) pairs."""
    out: dict[int, int] = {}
    for number, size in shards:
        out[number] = out.get(number, 0) + size
    return out
