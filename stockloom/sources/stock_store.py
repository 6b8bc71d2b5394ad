"""Stock and its ledger as one versioned table: changes are merged bucket by bucket.

Bins lie in buckets by a hash of their key. A change reads and writes the buckets that it
touches; all others stay where an earlier change wrote them. A version is a manifest, a small
file that names for every bucket the folder that holds it. Manifests are created once and never
changed, so a version that someone reads stays as it is, and of two writers who start from the
same version one fails with ``Conflict``; each writes to a folder of its own, so the loser's rows
are never seen. The ledger rows of a change are written beside its buckets and become visible with
the same manifest.

    root/manifests/<version>.json
    root/stock/<version>-<writer>/bucket=<bucket>/...
    root/ledger/<version>-<writer>/transaction_type=<type>/...
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.plans.lookup import shuffle_partitions
from stockloom.plans.scratch import Scratch
from stockloom.sources.files import Files

KEYS = ["product_id", "location_id"]
AMOUNTS = ["quantity_on_hand", "quantity_reserved", "quantity_allocated"]
STOCK = "product_id bigint, location_id bigint, " + ", ".join(f"{c} bigint" for c in AMOUNTS)
BUCKET_ROWS = 500_000
LEAST_BUCKETS = 16
MOST_BUCKETS = 65_536


class Conflict(RuntimeError):
    """Another writer made the next version first."""


@dataclass(frozen=True)
class Manifest:
    version: int
    batch: str  # the change that made it
    folders: list[str]  # of the stock
    holders: list[int]  # of each bucket, the folder that holds it, by its place; -1: no rows
    ledgers: list[str]  # folders of ledger rows
    schema: str  # of the ledger; empty without one


class StockStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    # ---- versions

    def versions(self) -> list[int]:
        names = self.files.names(f"{self.root}/manifests")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        at = self.versions()[-1] if version is None else version
        return Manifest(**json.loads(self.files.text(f"{self.root}/manifests/{at:012d}.json")))

    def _commit(self, made: Manifest) -> None:
        path = f"{self.root}/manifests/{made.version:012d}.json"
        if not self.files.create(path, json.dumps(asdict(made))):
            raise Conflict(f"version {made.version} exists")

    @staticmethod
    def _name(version: int) -> str:
        return f"{version:012d}-{uuid.uuid4().hex}"

    # ---- reading

    def stock(self, version: int | None = None) -> DataFrame:
        """The stock at a version, the newest by default; a bucket is read where it lies."""
        return self._read(self.manifest(version))

    def _read(self, at: Manifest, only: list[int] | None = None) -> DataFrame:
        by: dict[int, list[int]] = {}
        for bucket in range(len(at.holders)) if only is None else only:
            if at.holders[bucket] >= 0:
                by.setdefault(at.holders[bucket], []).append(bucket)
        parts = []
        for holder, buckets in sorted(by.items()):
            folder = f"{self.root}/stock/{at.folders[holder]}"
            rows = self.spark.read.schema(f"{STOCK}, bucket int").option("basePath", folder)
            parts.append(rows.parquet(*[f"{folder}/bucket={b}" for b in buckets]))
        if not parts:
            return self.spark.createDataFrame([], STOCK)
        return reduce(DataFrame.unionByName, parts).select(*KEYS, *AMOUNTS)

    def ledger(self, version: int | None = None) -> DataFrame | None:
        """All ledger rows up to a version, with the version that wrote each; None without any."""
        at = self.manifest(version)
        if not at.ledgers:
            return None
        parts = []
        for name in at.ledgers:
            folder = f"{self.root}/ledger/{name}"
            rows = self.spark.read.schema(f"{at.schema}, transaction_type string").option("basePath", folder)
            parts.append(rows.parquet(folder).withColumn("version", F.lit(int(name[:12])).cast("bigint")))
        return reduce(DataFrame.unionByName, parts)

    # ---- writing

    def create(self, stock: DataFrame, buckets: int | None = None) -> Manifest:
        """Version 0 from rows of stock; rows of one bin are added up.

        The number of ``buckets`` follows the rows where it is not given.
        """
        if buckets is None:
            buckets = min(max(LEAST_BUCKETS, stock.count() // BUCKET_ROWS + 1), MOST_BUCKETS)
        nothing = Manifest(-1, "", [], [-1] * buckets, [], "")
        made = self._written(nothing, self._laid_out(_added_up(stock), buckets), list(range(buckets)), "")
        self._commit(made)
        return made

    def merge(self, delta: DataFrame, batch: str, ledger: DataFrame | None = None) -> Manifest:
        """The version after adding ``delta``, several rows per bin and new bins included.

        ``delta``: product_id, location_id and any of the quantities. ``ledger``: rows with a
        transaction_type, stored with the same version. A batch that a kept version was made
        from is not applied again; that version is returned.
        """
        before = self.manifest()
        for version in reversed(self.versions()):
            if (seen := self.manifest(version)).batch == batch:
                return seen
        buckets = len(before.holders)
        # The change is added up per bin first, so a bin that many rows change is one row.
        staged = Scratch(self.spark, "delta")
        changes = staged.keep(self._laid_out(_added_up(delta), buckets))
        touched = sorted(r.bucket for r in changes.select("bucket").distinct().collect())
        held = self._laid_out(self._read(before, touched), buckets)
        # Rows are dealt by bucket, which is part of this grouping: they move once.
        both = self._dealt(held.unionByName(changes), len(touched))
        rows = both.groupBy("bucket", *KEYS).agg(*[F.sum(c).alias(c) for c in AMOUNTS])
        made = self._written(before, rows, touched, batch)
        staged.remove()
        if ledger is not None:
            name = self._name(made.version)
            ledger.write.partitionBy("transaction_type").parquet(f"{self.root}/ledger/{name}")
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ledger.schema
                               if f.name != "transaction_type")
            made = replace(made, ledgers=[*made.ledgers, name], schema=schema)
        self._commit(made)
        return made

    @staticmethod
    def _laid_out(rows: DataFrame, buckets: int) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*KEYS), F.lit(buckets)).cast("int"))

    def _dealt(self, rows: DataFrame, buckets: int) -> DataFrame:
        """One task writes a bucket, so a bucket is one file."""
        return rows.repartition(max(min(buckets, shuffle_partitions(self.spark)), 1), "bucket")

    def _written(self, before: Manifest, rows: DataFrame, touched: list[int], batch: str) -> Manifest:
        """The next manifest, with these rows in place of the touched buckets."""
        name = self._name(before.version + 1)
        folder = f"{self.root}/stock/{name}"
        self._dealt(rows, len(touched)).write.partitionBy("bucket").parquet(folder)
        there = {int(n.split("=")[1]) for n in self.files.names(folder) if n.startswith("bucket=")}
        # Folders that no bucket lies in any more are left out of the list.
        holder = {b: before.folders[h] for b, h in enumerate(before.holders) if h >= 0}
        holder |= dict.fromkeys(there, name)
        folders = sorted(set(holder.values()))
        place = {f: i for i, f in enumerate(folders)}
        holders = [place[holder[b]] if b in holder else -1 for b in range(len(before.holders))]
        return Manifest(before.version + 1, batch, folders, holders, before.ledgers, before.schema)

    def rebucket(self, buckets: int) -> Manifest:
        """The same stock in another number of buckets, as a new version; reads and writes all rows."""
        before = self.manifest()
        nothing = replace(before, folders=[], holders=[-1] * buckets, batch="")
        made = self._written(nothing, self._laid_out(self._read(before), buckets), list(range(buckets)), "")
        self._commit(made)
        return made

    def vacuum(self, keep: int = 1) -> list[int]:
        """Remove all but the newest ``keep`` versions and the stock that these do not need.

        Folders of writers who failed go too, if their version has been made by another. Ledger
        rows are never removed. Returns the versions removed.
        """
        versions = self.versions()
        kept = [self.manifest(v) for v in versions[-keep:]]
        for version in versions[:-keep]:
            self.files.remove(f"{self.root}/manifests/{version:012d}.json")
        needed = {f for m in kept for f in m.folders}
        for name in self.files.names(f"{self.root}/stock"):
            if name not in needed and int(name[:12]) <= versions[-1]:
                self.files.remove(f"{self.root}/stock/{name}")
        return versions[:-keep]


def _added_up(rows: DataFrame) -> DataFrame:
    """One row per bin with all quantities; those that ``rows`` lacks are 0."""
    amounts = [
        F.coalesce(F.sum(F.col(c).cast("bigint")), F.lit(0).cast("bigint")).alias(c) if c in rows.columns
        else F.lit(0).cast("bigint").alias(c) for c in AMOUNTS
    ]
    return rows.groupBy(*[F.col(k).cast("bigint").alias(k) for k in KEYS]).agg(*amounts)
