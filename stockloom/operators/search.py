"""Product search over a stored index of trigrams.

Names, SKUs and category names are cut into runs of three letters. Postings (trigram -> product, and
trigram -> category) lie sorted in files by a hash of the trigram, products in buckets by a hash of
their number. A search takes the rarest trigrams of the term, reads their postings, keeps what
occurs in all of them, fetches those products from their buckets and checks the whole pattern on
them. The result equals a scan with the same pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.functions.scalars import or_zero
from stockloom.plans.lookup import fits_broadcast, lookup_join, shuffle_partitions

GRAM = 3
PARTS = 64  # folders of postings
MOST_GRAMS = 4  # trigrams of a term that are looked up
MOST_IDS = 5_000  # product numbers that are pushed into the file scan
PRODUCT = ["product_id", "sku", "product_name", "category_id", "category_name", "sale_price"]


def _grams(text: Column) -> Column:
    """The distinct trigrams of a lower-cased text; none for shorter texts and null."""
    low = F.lower(text)
    places = F.sequence(F.lit(1), F.char_length(low) - (GRAM - 1))
    cut = F.transform(places, lambda i: F.substr(low, i, F.lit(GRAM)))
    return F.when(F.char_length(low) >= GRAM, F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))


def literal_runs(pattern: str) -> list[str]:
    """What a LIKE pattern holds between its wildcards; a backslash takes the next letter plainly."""
    runs, held, i = [], "", 0
    while i < len(pattern):
        if pattern[i] == "\\" and i + 1 < len(pattern):
            held, i = held + pattern[i + 1], i + 2
            continue
        if pattern[i] in "%_":
            runs.append(held)
            held = ""
        else:
            held += pattern[i]
        i += 1
    return [r for r in [*runs, held] if r]


class ProductIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def build(self, products: DataFrame, categories: DataFrame, buckets: int | None = None) -> ProductIndex:
        """Write the index to an unused path; the number of product buckets follows the rows."""
        named = lookup_join(
            products.select("product_id", "sku", "product_name", "category_id", "sale_price"),
            categories.select("category_id", "category_name"), "category_id", "left").select(*PRODUCT)
        buckets = buckets or max(8, products.count() // 100_000 + 1)
        place = F.pmod(F.xxhash64("product_id"), F.lit(buckets)).cast("int")
        named.withColumn("bucket", place).repartition("bucket").sortWithinPartitions(
            "bucket", "product_id").write.partitionBy("bucket").parquet(f"{self.path}/products")
        own = F.array_distinct(F.concat(_grams(F.col("product_name")), _grams(F.col("sku"))))
        self._post(named.select(F.explode(own).alias("gram"), F.col("product_id").alias("id"),
                                place.alias("bucket")), "by_product")
        self._post(categories.select(F.explode(_grams(F.col("category_name"))).alias("gram"),
                                     F.col("category_id").alias("id"), F.lit(0).alias("bucket")).distinct(),
                   "by_category")
        return self

    def _post(self, rows: DataFrame, name: str) -> None:
        part = F.pmod(F.xxhash64("gram"), F.lit(PARTS)).cast("int")
        rows = rows.withColumn("part", part)
        # A trigram of every product fills many tasks: rows are dealt by trigram and product.
        spread = F.pmod(F.xxhash64("id"), F.lit(max(shuffle_partitions(self.spark) // 8, 1)))
        rows.repartition("part", spread).sortWithinPartitions("part", "gram", "id").write.partitionBy(
            "part").parquet(f"{self.path}/{name}")
        rows.groupBy("part", "gram").agg(F.count(F.lit(1)).alias("n")).repartition("part").sortWithinPartitions(
            "part", "gram").write.partitionBy("part").parquet(f"{self.path}/{name}_counts")

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def _holding(self, name: str, grams: list[tuple[str, int]]) -> DataFrame:
        """(id, bucket) of the postings that hold all of the rarest trigrams."""
        texts, parts = [g for g, _ in grams], sorted({p for _, p in grams})
        counts = self._read(f"{name}_counts", "gram string, n bigint, part int").filter(
            F.col("part").isin(parts) & F.col("gram").isin(texts)).collect()
        if len(counts) < len(texts):  # a trigram that occurs nowhere
            return self.spark.createDataFrame([], "id bigint, bucket int")
        rarest = [r.gram for r in sorted(counts, key=lambda r: (r.n, r.gram))[:MOST_GRAMS]]
        parts = sorted({p for g, p in grams if g in rarest})
        rows = self._read(name, "gram string, id bigint, bucket int, part int").filter(
            F.col("part").isin(parts) & F.col("gram").isin(rarest))
        return rows.groupBy("id", "bucket").agg(F.count(F.lit(1)).alias("n")).filter(
            F.col("n") == len(rarest)).select("id", "bucket")

    def candidates(self, term: str) -> DataFrame | None:
        """(product_id, bucket) of all products that the term may name; None if that cannot be told.

        It cannot for terms without three letters in a row.
        """
        # The engine's own lower case, so that index, term and check agree.
        low = self.spark.range(1).select(F.lower(F.lit(f"%{term}%")).alias("p")).first().p
        runs = [r for r in literal_runs(low) if len(r) >= GRAM]
        if not runs:
            return None
        texts = sorted({r[i : i + GRAM] for r in runs for i in range(len(r) - GRAM + 1)})
        grams = self.spark.createDataFrame([(t,) for t in texts], "gram string").select(
            "gram", F.pmod(F.xxhash64("gram"), F.lit(PARTS)).cast("int").alias("part")).collect()
        pairs = [(r.gram, r.part) for r in grams]
        by_category = self._holding("by_category", pairs).select(F.col("id").alias("category_id"))
        own = self._holding("by_product", pairs).select(F.col("id").alias("product_id"), "bucket")
        if by_category.isEmpty():
            return own
        # Products of the categories: their numbers alone are read.
        rows = self._products().select("product_id", "bucket", "category_id")
        of = lookup_join(rows, by_category, "category_id").select("product_id", "bucket")
        return own.unionByName(of).distinct()

    def _products(self) -> DataFrame:
        return self._read("products", "product_id bigint, sku string, product_name string, category_id bigint, "
                                      "category_name string, sale_price decimal(10,2), bucket int")

    def find(self, term: str) -> DataFrame:
        """The products that ``search_products`` finds, without their stock."""
        rows, found = self._products(), self.candidates(term)
        if found is not None:
            some = found.limit(MOST_IDS + 1).collect()
            if len(some) <= MOST_IDS:  # buckets and row groups without them are skipped
                rows = rows.filter(F.col("bucket").isin(sorted({r.bucket for r in some}))
                                   & F.col("product_id").isin([r.product_id for r in some]))
            else:
                ids = found.select("product_id")
                rows = rows.join(F.broadcast(ids) if fits_broadcast(ids) else ids, "product_id", "left_semi")
        pattern = f"%{term}%"
        return rows.filter(
            F.col("product_name").ilike(pattern) | F.col("sku").ilike(pattern) | F.col("category_name").ilike(pattern)
        ).select("product_id", "sku", "product_name", "category_name", "sale_price")

    def search(self, term: str, inventory: DataFrame) -> DataFrame:
        """``search_products`` through the index."""
        found = self.find(term)
        ids = found.select("product_id")
        held = inventory.join(F.broadcast(ids) if fits_broadcast(ids) else ids, "product_id", "left_semi")
        stock = held.groupBy("product_id").agg(F.sum("quantity_on_hand").alias("on_hand"))
        return found.join(stock, "product_id", "left").select(
            *found.columns, or_zero("on_hand").alias("quantity_on_hand"))
