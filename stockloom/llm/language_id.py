"""Language identification with bit-sliced Bloom filters of byte n-grams.

Every language has a Bloom filter of its frequent four-byte grams; the filters are stored
sliced, one word of language bits per filter position, so the positions of a gram are read
once for all languages and combined with AND. A text's bits are counted per language, the share
of grams found is corrected for the filter's false positives, and the largest share decides.

The filters come from a bounded sample per language: ``sample_rows`` texts expected, drawn by a
hash of the id. A gram enters a language's filter when it makes at least ``least_share`` of
that sample's grams, so a language has at most 1 / least_share grams whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import crc_mod, prepare, shared, steps, text_buffer

UNKNOWN = "und"


@dataclass(frozen=True)
class Params:
    sample_rows: int = 3000  # texts expected per language
    least_share: float = 1e-5
    least_ratio: float = 0.05  # of the language in which the gram is most frequent
    bits: int = 20  # log2 of the filter positions
    hashes: int = 3
    seed: int = 17


@dataclass(frozen=True)
class Model:
    languages: list[str]
    filters: np.ndarray  # (words of 64 languages, positions)
    false_rate: np.ndarray  # per language
    fallback: str


#: Bytes of letters: ASCII letters and all bytes of longer characters.
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True

_FACTORS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


def padded(text: Column) -> Column:
    return F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" "))


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Four-byte grams of padded texts as integers, and each text's first (n + 1 entries).

    The two inner bytes are letters; the outer ones may be a word's edge, written as a blank.
    """
    data, bounds = text_buffer(column)
    letter = LETTER[data]
    clean = np.where(letter, data, 32).astype(np.uint32)
    n = len(data)
    if n < 4:
        return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
    key = clean[:-3] | clean[1:-2] << 8 | clean[2:-1] << 16 | clean[3:] << 24
    good = letter[1:-2] & letter[2:-1]
    # Texts start and end with a blank, so a gram across two texts has a blank inside.
    at = np.flatnonzero(good)
    return key[at], np.searchsorted(at, bounds)


def positions(key: np.ndarray, k: int, bits: int) -> np.ndarray:
    mixed = key.astype(np.uint64) * np.uint64(_FACTORS[k])
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * np.uint64(_FACTORS[3])) >> np.uint64(64 - bits)).astype(np.int64)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "padded"):
        langs = batch.column(0).dictionary_encode()
        code = np.asarray(langs.indices)
        key, first = grams(batch.column(1))
        owner = np.repeat(code, np.diff(first)).astype(np.uint64)
        both, n = np.unique(owner << np.uint64(32) | key, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [langs.dictionary.take(pa.array((both >> np.uint64(32)).astype(np.int64))),
             pa.array((both & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n.astype(np.int64))],
            names=["lang", "gram", "n"])


def fit(docs: DataFrame, p: Params | None = None) -> Model:
    """A model from the rows of ``docs`` (doc_id, text, lang) with a lang and a text."""
    p = p or Params()
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL")
    # One row per language; the sampling rates are joined as a table of that size.
    # Rows are drawn by id and text, as ids may be missing or repeat; exact copies count once.
    key = F.xxhash64("doc_id", "text")
    sizes = rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("size"),
        F.approx_count_distinct(key, 0.02).alias("differ"))
    sizes = docs.sparkSession.createDataFrame(sizes.collect(), "lang string, size bigint, differ bigint")
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(p.seed)), F.lit(1 << 30)) / (1 << 30)
    sample = rows.join(F.broadcast(sizes), "lang").filter(draw * F.col("differ") < p.sample_rows).select(
        "lang", "doc_id", "text", key.alias("key"))
    # The sample is bounded, and so are the keys that repeat in it; only their texts are shuffled.
    copies = [r.key for r in sample.groupBy("lang", "key").agg(F.count(F.lit(1)).alias("n"))
              .filter("n > 1").select("key").distinct().collect()]
    if copies:
        copied = F.broadcast(docs.sparkSession.createDataFrame([(k,) for k in copies], "key bigint"))
        sample = sample.join(copied, "key", "left_anti").unionByName(
            sample.join(copied, "key", "left_semi").select(sample.columns).distinct())
    counts = sample.select("lang", padded(F.col("text")).alias("padded")).mapInArrow(
        _counter, "lang string, gram bigint, n bigint"
    ).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(totals), "lang").select(
        "lang", "gram", (F.col("n") / F.col("total")).alias("share"))
    # At most 1 / least_share grams per language come back.
    frequent = shares.filter(F.col("share") >= p.least_share).collect()

    seen = {r.lang: r.size for r in sizes.collect()}
    languages = sorted(seen)
    code = {x: i for i, x in enumerate(languages)}
    most: dict[int, float] = {}
    for r in frequent:
        most[r.gram] = max(most.get(r.gram, 0.0), r.share)
    filters = np.zeros(((len(languages) + 63) // 64, 1 << p.bits), np.uint64)
    for lang in languages:
        own = np.array([r.gram for r in frequent
                        if r.lang == lang and r.share >= p.least_ratio * most[r.gram]], np.uint32)
        word, bit = divmod(code[lang], 64)
        for k in range(p.hashes):
            filters[word, positions(own, k, p.bits)] |= np.uint64(1 << bit)
    fill = np.array([float(((filters[c // 64] >> np.uint64(c % 64)) & np.uint64(1)).mean())
                     for c in range(len(languages))])
    fallback = min(languages, key=lambda x: (-seen[x], x), default=UNKNOWN)
    return Model(languages, filters, fill**p.hashes, fallback)


def _identifier(sent, p: Params) -> Callable:
    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**sent.value)
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in steps(batches, "padded"):
            n = batch.num_rows
            at = batch.schema.get_field_index("padded")
            known = np.asarray(batch.column(batch.schema.get_field_index("has_letter")), bool)
            key, first = grams(batch.column(at))
            total = np.diff(first)
            share = np.zeros((n, len(model.languages) or 1))
            places = [positions(key, k, p.bits) for k in range(p.hashes)]
            for word in range(len(model.filters)):
                slice_ = model.filters[word]
                mask = slice_[places[0]]
                for place in places[1:]:
                    mask &= slice_[place]
                for code in range(word * 64, min(word * 64 + 64, len(model.languages))):
                    bit = (mask >> np.uint64(code % 64)) & np.uint64(1)
                    found = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
                    rate = (found[first[1:]] - found[first[:-1]]) / np.maximum(total, 1)
                    false = model.false_rate[code]
                    share[:, code] = (rate - false) / max(1 - false, 1e-9)
            best = share.argmax(1)
            score = np.clip(share[np.arange(n), best], 0, 1)
            best = np.where(known & bool(model.languages), best, len(model.languages))
            pred = names[best]
            pred[known & (total == 0)] = model.fallback
            score[~known | (total == 0)] = 0
            keep = [i for i, x in enumerate(batch.schema.names) if x not in ("padded", "has_letter")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(pred, pa.string()), pa.array(score)],
                names=[*(batch.schema.names[i] for i in keep), "lang_pred", "score"])

    return identify


def identify(docs: DataFrame, model: Model, keep: list[str], p: Params | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred and score (0 to 1) from ``text`` alone.

    ``und`` with score 0 when the text is null or has no letter. A text too short for a gram
    gets the most frequent language with score 0; ties go to the first by name. Without any
    language learned all rows are ``und``. Names in ``keep`` may not be lang_pred or score.
    """
    p = p or Params()
    spark = prepare(docs.sparkSession)
    rows = docs.select(
        *keep, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter"),
        padded(F.col("text")).alias("padded"))
    sent = shared(spark, model)  # a fixed number of filter positions
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return rows.mapInArrow(_identifier(sent, p), f"{kinds}, lang_pred string, score double")


def train_rows(docs: DataFrame) -> DataFrame:
    """The rows that may be learned from: crc32 of the id modulo 4 is not 2."""
    return docs.filter(crc_mod("doc_id", 4) != 2)


def predict(docs: DataFrame, p: Params | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs`` (doc_id, text, lang).

    Learns from the rows that are not held out. Rows with a null doc_id count as not held out.
    """
    model = fit(train_rows(docs), p)
    rows = docs.select("doc_id", "text", (crc_mod("doc_id", 4) == 2).alias("held_out"))
    return identify(rows, model, ["doc_id", "held_out"], p)
