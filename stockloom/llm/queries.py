"""The operators of this subpackage as queries over one data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm import (
    decontaminate, embed_dup, language_id, license_scan, near_dup, phrases, pieces, quality,
    sharding, spelling, token_counts, toxicity, warc,
)
from stockloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_subspace_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("matches")


def op4_virtual_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op5_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document before and after three edits derived from its own text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    edited = docs.withColumn("edits", token_counts.derived_edits(F.col("doc_id"), F.col("text")))
    return token_counts.counted(edited, ["doc_id"]).drop("edited")


def op6_language_bitmasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict(table(spark, sf_dir, "documents"))


def op7_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, ["doc_id"], pieces.load(), check=True)


def op9_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"), payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_nb_support_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_phrase_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_edit_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.groups(table(spark, sf_dir, "documents"))


def registry() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_minhash_near_dedup,
            op2_subspace_near_dedup,
            op3_license_scan,
            op4_virtual_slot_shards,
            op5_edit_token_counts,
            op6_language_bitmasks,
            op7_template_decontamination,
            op8_sentencepiece,
            op9_weak_toxicity,
            op10_warc_round_trip,
            op11_nb_support_vectors,
            op12_phrase_tries,
            op13_edit_transducer,
        )
    }
