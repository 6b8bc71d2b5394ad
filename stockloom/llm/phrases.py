"""Collocations of two and more words per language, counted with double-array tries.

Candidates grow level by level as in Apriori: a phrase is counted by its hash only where both
parts of one word less are frequent, and is a candidate if its hash is met often enough. What
tasks know of frequent parts is a bitmap of fixed size over hashes; hashes that meet only add
candidates, they never lose one. Each candidate's text is listed once, from the documents of one
shard in which it stands. The candidates, single words among them, are dealt into tries of a bounded
number of keys. One pass over the text sends every phrase that can be a candidate to the task of its
trie, equal ones of a step once with their number: there all of them advance together through
its states, and the states that accept a phrase are counted. These counts are exact, whatever the hashes did.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockloom.llm import double_array
from stockloom.llm.common import Work, steps, text_buffer
from stockloom.llm.textwords import BASE, LOWER, WordHasher, mix, powers
from stockloom.plans.lookup import lookup_join, shuffle_partitions
from stockloom.plans.scratch import run_once

UNKNOWN = "und"
#: A piece ends at one of .,;:!? or a line end; words are parted by blanks and tabs.
PIECE_END = np.zeros(256, bool)
PIECE_END[[*b".,;:!?", 10, 11, 12, 13]] = True
SEPARATOR = PIECE_END.copy()
SEPARATOR[[9, 32]] = True
KEY_BITS, SHARD_BITS = 48, 8
TURNS = (0x9E3779B1, 0x85EBCA77)  # how a shard moves the bits of a key
PART_BYTES, HELD_BYTES = 32 << 10, 4 << 20  # of phrases that a task gathers, for each part and at most
LANG_END, SHIFT = 1, 2  # labels of the tries: key end 0, language end 1, bytes from 2


@dataclass(frozen=True)
class Params:
    words: int = 3  # longest phrase
    least: int = 10  # occurrences of a candidate
    share: int = 50  # percent: a part goes when a longer candidate is at least so frequent
    top: int = 2000  # phrases per language
    word_bits: int = 26  # log2 of the bits that stand for frequent words
    phrase_bits: int = 27  # the same for frequent phrases of one length
    trie_keys: int = 400_000  # keys of one trie, and 24 times as many bytes
    buckets: int = 64  # parts of a language that are ranked apart first


def lang_codes(langs: list[str]) -> np.ndarray:
    """A hash of each language's name."""
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little")
                     for x in langs], np.uint64)


def total_keys(langs: list[str]) -> np.ndarray:
    """Negative keys under which the words of each language are added up."""
    return -1 - (lang_codes(langs) >> np.uint64(1)).view(np.int64)


class Tokens:
    """Words of one step of rows (lang, text): hashes, neighbours, and the words as bytes."""

    def __init__(self, hasher: WordHasher, batch: pa.RecordBatch):
        data, bounds = text_buffer(batch.column(1))
        self.hashes, starts, ends, first = hasher(data, bounds)
        langs = batch.column(0).dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        owner = np.repeat(np.arange(batch.num_rows), np.diff(first))
        self.lang = np.asarray(langs.indices)[owner]
        breaks = np.concatenate([[0], np.cumsum(PIECE_END[data], dtype=np.int32)])
        #: Whether the next word stands in the same piece.
        self.joined = np.zeros(len(starts), bool)
        self.joined[:-1] = (owner[1:] == owner[:-1]) & (breaks[starts[1:]] == breaks[ends[:-1]])
        #: The words as lower-case bytes, each with a blank behind it, or a line end at the piece's end.
        size = ends - starts
        self.at = np.concatenate([[0], np.cumsum(size + 1)])
        self.ends = self.at[1:] - 1
        self.text = np.full(int(self.at[-1]), 10, np.uint8)
        inside = np.ones(len(self.text), bool)
        inside[self.ends] = False
        self.text[inside] = LOWER[data[np.arange(int(size.sum())) + np.repeat(
            starts - np.concatenate([[0], np.cumsum(size)[:-1]]), size)]]
        self.text[self.ends[self.joined]] = 32
        self.lang_hash = lang_codes(self.langs)[self.lang]
        #: The shard of each word's document, from all its words.
        total = np.concatenate([[np.uint64(0)], np.cumsum(self.hashes)])
        self.shard = (mix(total[first[1:]] - total[first[:-1]]) >> np.uint64(64 - SHARD_BITS))[owner]

    def keys(self, width: int) -> np.ndarray:
        """Hash (KEY_BITS) of the phrase of ``width`` words from each word on, with its language."""
        factor = powers(BASE, width + 2)
        out = self.lang_hash + factor[width + 1 : width + 2] * np.uint64(width)
        n = len(out)
        for k in range(width):
            out[: n - k] += self.hashes[k:] * factor[k + 1]
        return mix(out) >> np.uint64(64 - KEY_BITS)

    def whole(self, width: int) -> np.ndarray:
        """Whether ``width`` words from this one on stand in one piece."""
        good = np.ones(len(self.hashes), bool)
        n = len(good)
        for k in range(width - 1):
            good[: n - k] &= self.joined[k:]
            good[max(n - k, 0) :] = False
        return good

    def phrases(self, chosen: np.ndarray, width: int) -> tuple[pa.Array, pa.Array]:
        """(languages, phrases) that start at the chosen words."""
        begin, end = self.at[chosen], self.ends[chosen + width - 1]
        size = end - begin
        offsets = np.concatenate([[0], np.cumsum(size)])
        data = self.text[np.arange(int(offsets[-1])) + np.repeat(begin - offsets[:-1], size)]
        text = pa.Array.from_buffers(pa.large_string(), len(chosen), [
            None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])
        return pa.array(self.langs, pa.string()).take(pa.array(self.lang[chosen])), text.cast(pa.string())


def places(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a bitmap of 2 ** bits bits that stand for a key: its upper and lower ones."""
    return key >> np.uint64(KEY_BITS - bits), key & np.uint64((1 << bits) - 1)


def met(bitmap: np.ndarray, key: np.ndarray, shard: np.ndarray | None = None) -> np.ndarray:
    """Whether the bits of each key, or of each key with its shard, are set."""
    bits = int(len(bitmap) * 64).bit_length() - 1
    good = np.ones(len(key), bool)
    for place, turn in zip(places(key, bits), TURNS, strict=True):
        if shard is not None:
            place = place ^ (shard * np.uint64(turn) & np.uint64((1 << bits) - 1))
        word = bitmap[(place >> np.uint64(6)).astype(np.int64)]
        good &= ((word >> (place & np.uint64(63))) & np.uint64(1)) != 0
    return good


def bitmap(keys: DataFrame, bits: int, shards: bool) -> np.ndarray:
    """A bitmap of 2 ** bits bits of the rows (key, shard), with or without the shard.

    Its size is fixed, whatever the number of keys.
    """
    ends = [f"shiftright(key, {KEY_BITS - bits})", f"key & {(1 << bits) - 1}"]
    if shards:
        ends = [f"({e}) ^ (cast(shard as bigint) * {t} & {(1 << bits) - 1})" for e, t in zip(ends, TURNS, strict=True)]
    cells = keys.select(F.explode(F.array(*[F.expr(e) for e in ends])).alias("place")).groupBy(
        F.expr("shiftright(place, 6)").alias("cell")
    ).agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("word"))
    rows = cells.toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows["cell"].to_numpy()] = rows["word"].to_numpy().view(np.uint64)
    return out


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[Tokens]:
    hasher = WordHasher(SEPARATOR, LOWER)
    for batch in steps(batches):
        tokens = Tokens(hasher, batch)
        if len(tokens.hashes):
            yield tokens


def _support_counter(sent: Broadcast | None, width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens in _texts(batches):
            good = tokens.whole(width)
            if sent is not None:  # both parts must be frequent
                part = met(sent.value, tokens.keys(width - 1))
                good &= part
                good[:-1] &= part[1:]
            # Sorted by key and shard at once: the first of a key has its smallest shard.
            packed = np.sort(tokens.keys(width)[good] << np.uint64(SHARD_BITS) | tokens.shard[good])
            key = packed >> np.uint64(SHARD_BITS)
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
            if width == 1:
                words = np.bincount(tokens.lang, minlength=len(tokens.langs)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(total_keys(tokens.langs)), pa.array(np.zeros(len(words), np.int32)), pa.array(words)],
                    names=["key", "shard", "n"])
            yield pa.RecordBatch.from_arrays([
                pa.array(key[first].view(np.int64)),
                pa.array((packed[first] & np.uint64((1 << SHARD_BITS) - 1)).astype(np.int32)),
                pa.array(np.diff(np.append(first, len(key))).astype(np.int32))], names=["key", "shard", "n"])

    return run


def _lister(sent: Broadcast, p: Params) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens in _texts(batches):
            for width in range(1, p.words + 1):
                key = tokens.keys(width)
                at = np.flatnonzero(tokens.whole(width) & met(sent.value[width - 1], key, tokens.shard))
                key, one = np.unique(key[at], return_index=True)
                lang, phrase = tokens.phrases(at[one], width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), lang, phrase], names=["key", "lang", "phrase"])

    return run


def _dealer(sent: Broadcast, parts: int, p: Params) -> Callable:
    """Phrases that can be candidates, as rows (part, kind 1, lang, phrases by lines, their numbers).

    Phrases are gathered over steps until there are PART_BYTES for each part, or HELD_BYTES, so rows
    follow the bytes and not steps times parts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, int] = {}
        held: list[tuple[np.ndarray, ...]] = []
        waiting = 0
        for tokens in _texts(batches):
            code = np.array([langs.setdefault(x, len(langs)) for x in tokens.langs], np.int64)
            for width in range(1, p.words + 1):
                key = tokens.keys(width)
                at = np.flatnonzero(tokens.whole(width) & met(sent.value[width - 1], key))
                if len(at):
                    held.append(_distinct(tokens, key[at], at, width, parts, code))
                    waiting += len(held[-1][3])
            if waiting > min(parts * PART_BYTES, HELD_BYTES):
                yield _dealt(held, langs)
                held, waiting = [], 0
        if held:
            yield _dealt(held, langs)

    return run


def _distinct(tokens: Tokens, key: np.ndarray, at: np.ndarray, width: int, parts: int,
              code: np.ndarray) -> tuple[np.ndarray, ...]:
    """(part, language, bytes, text by lines, number) of the different phrases that start at the words ``at``."""
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    lang = tokens.lang[at]
    begin, size = tokens.at[at], tokens.ends[at + width - 1] - tokens.at[at]
    # Neighbours are one phrase where all their bytes are equal; an equal hash is not enough.
    same = np.zeros(len(at), bool)
    same[1:] = (key[1:] == key[:-1]) & (lang[1:] == lang[:-1]) & (size[1:] == size[:-1])
    twice = np.flatnonzero(same)
    if len(twice):
        wide = size[twice]
        first = np.concatenate([[0], np.cumsum(wide)])
        step = np.arange(int(first[-1])) - np.repeat(first[:-1], wide)
        equal = (tokens.text[np.repeat(begin[twice], wide) + step]
                 == tokens.text[np.repeat(begin[twice - 1], wide) + step])
        same[twice] = np.logical_and.reduceat(equal, first[:-1])
    one = np.flatnonzero(~same)
    number = np.diff(np.append(one, len(at))).astype(np.int32)
    size = size[one] + 1
    text = _gathered(tokens.text, begin[one], size)
    text[np.cumsum(size) - 1] = 10
    return (key[one] % np.uint64(parts)).astype(np.int64), code[lang[one]], size, text, number


def _gathered(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of the given stretches, one behind the other."""
    bounds = np.concatenate([[0], np.cumsum(size)])
    return data[np.arange(int(bounds[-1])) + np.repeat(begin - bounds[:-1], size)]


def _dealt(held: list[tuple[np.ndarray, ...]], langs: dict[str, int]) -> pa.RecordBatch:
    """One row per part and language."""
    part, lang, size, text, number = (np.concatenate(x) for x in zip(*held, strict=True))
    begin = np.cumsum(size) - size
    order = np.lexsort((lang, part))
    part, lang, number = part[order], lang[order], number[order]
    text, size = _gathered(text, begin[order], size[order]), size[order]
    row = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (lang[1:] != lang[:-1])]))
    bounds = np.concatenate([[0], np.cumsum(size)])

    def blobs(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.large_binary(), len(row), [
            None, pa.py_buffer(cuts.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())

    return pa.RecordBatch.from_arrays([
        pa.array(part[row].astype(np.int32)), pa.array(np.ones(len(row), np.int32)),
        pa.array(list(langs), pa.string()).take(pa.array(lang[row])),
        blobs(text, np.append(bounds[row], bounds[-1])), blobs(number, 4 * np.append(row, len(part)))],
        names=["part", "kind", "lang", "text", "numbers"])


class PartCounter:
    """The trie of one part and the counts of its phrases."""

    def __init__(self) -> None:
        self.rows: list[pa.RecordBatch] = []
        self.trie: dict | None = None

    def add(self, lang: pa.Array, text: pa.Array, numbers: pa.Array) -> None:
        if self.trie is None:
            self.trie = trie_of(pa.Table.from_batches(self.rows))
            self.counts = np.zeros(len(self.trie["phrase"]), np.int64)
            self.states: dict[str, int] = {}
        base, check = self.trie["base"], self.trie["check"]
        langs = lang.to_pylist()
        for x in set(langs) - self.states.keys():
            self.states[x] = double_array.start(base, check, [b + SHIFT for b in x.encode()] + [LANG_END])
        flat = np.frombuffer(b"".join(text.to_pylist()), np.uint8)
        weight = [np.frombuffer(x, np.int32) for x in numbers.to_pylist()]
        state = np.repeat([self.states[x] for x in langs], [len(w) for w in weight])
        at = np.concatenate([[0], np.flatnonzero(flat == 10)[:-1] + 1])
        stops = np.zeros(256, bool)
        stops[10] = True
        found, weight = double_array.walk(
            base, check, flat, at, state, stops, SHIFT, np.concatenate(weight).astype(np.int64))
        np.add.at(self.counts, found, weight)

    def counted(self) -> Iterator[pa.RecordBatch]:
        if self.trie is not None:
            seen = pa.array(np.flatnonzero(self.counts))
            yield pa.RecordBatch.from_arrays(
                [self.trie["lang"].take(seen).cast(pa.string()), self.trie["phrase"].take(seen),
                 pa.array(self.counts).take(seen)], names=["lang", "phrase", "n"])


def _part_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the candidates; rows come sorted by part and kind, candidates (kind 0) first."""
    now, counter = None, PartCounter()
    for batch in batches:
        part, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero((part[1:] != part[:-1]) | (kind[1:] != kind[:-1])) + 1
        for start, stop in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if start == stop:
                continue
            if part[start] != now:
                yield from counter.counted()
                now, counter = part[start], PartCounter()
            lang, text, numbers = (batch.column(i).slice(start, stop - start) for i in (2, 3, 4))
            if kind[start] == 0:
                counter.rows.append(pa.RecordBatch.from_arrays([lang, text.cast(pa.string())], names=["lang", "phrase"]))
            elif counter.rows:  # without candidates there is nothing to count
                counter.add(lang, text, numbers)
    yield from counter.counted()


def _named_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(total_keys(batch.column(0).to_pylist()))], names=["lang", "key"])


def trie_of(rows: pa.Table) -> dict:
    """The trie of the rows (lang, phrase), with both columns in the order of its key numbers."""
    rows = rows.sort_by([("lang", "ascending"), ("phrase", "ascending")])
    lang, phrase = rows["lang"].combine_chunks(), rows["phrase"].combine_chunks()
    head, head_at = text_buffer(lang)
    tail, tail_at = text_buffer(phrase)
    a, b = np.diff(head_at), np.diff(tail_at)
    first = np.concatenate([[0], np.cumsum(a + b + 2)])
    flat = np.zeros(int(first[-1]), np.int16)  # a key's end is 0

    def put(data: np.ndarray, bounds: np.ndarray, begin: np.ndarray) -> None:
        size = np.diff(bounds)
        flat[np.arange(len(data)) + np.repeat(begin - bounds[:-1], size)] = data.astype(np.int16) + SHIFT

    put(head, head_at, first[:-1])
    flat[first[:-1] + a] = LANG_END
    put(tail, tail_at, first[:-1] + a + 1)
    base, check = double_array.build(flat, first)
    return {"base": base, "check": check, "lang": lang.dictionary_encode(), "phrase": phrase}


def candidates(work: Work, texts: DataFrame, p: Params) -> tuple[DataFrame, DataFrame, list[np.ndarray]]:
    """(candidates (key, lang, phrase) of one word and more, words (lang, n), bitmaps by length)."""
    spark: SparkSession = work.spark
    maps, lists = [], []
    for width in range(1, p.words + 1):
        sent = spark.sparkContext.broadcast(maps[-1]) if maps else None
        with run_once(spark):
            often = work.keep(
                texts.mapInArrow(_support_counter(sent, width), "key bigint, shard int, n int")
                .groupBy("key").agg(F.sum("n").alias("n"), F.min("shard").alias("shard"))
                .filter(F.col("n") >= p.least), f"often{width}")
        if width == 1:
            names = texts.select("lang").distinct().mapInArrow(_named_totals, "lang string, key bigint")
            totals = work.keep(often.join(names, "key").select("lang", "n"), "totals")
            often = often.filter("key >= 0")
        bits = p.word_bits if width == 1 else p.phrase_bits
        maps.append(bitmap(often, bits, False))
        lists.append(bitmap(often, bits, True))
        work.drop(f"often{width}")
        if sent is not None:
            sent.destroy()
    sent = spark.sparkContext.broadcast(lists)
    with run_once(spark):
        listed = work.keep(
            texts.mapInArrow(_lister(sent, p), "key bigint, lang string, phrase string").distinct(), "candidates")
    sent.destroy()
    return listed, totals, maps


def counted(work: Work, texts: DataFrame, listed: DataFrame, maps: list[np.ndarray], p: Params) -> DataFrame:
    """(lang, phrase, n) of all candidates; one pass over the texts for all tries, one task for each of them."""
    spark: SparkSession = work.spark
    size = listed.agg(F.count(F.lit(1)).alias("n"), F.coalesce(
        F.sum(F.octet_length("phrase") + F.octet_length("lang")), F.lit(0)).alias("bytes")).first()
    parts = max(size.n // p.trie_keys, size.bytes // (24 * p.trie_keys), shuffle_partitions(spark)) + 1
    sent = spark.sparkContext.broadcast(maps)
    schema = "part int, kind int, lang string, text binary, numbers binary"
    keys = listed.select(
        F.pmod("key", F.lit(parts)).cast("int").alias("part"), F.lit(0).alias("kind"), "lang",
        F.col("phrase").cast("binary").alias("text"), F.lit(None).cast("binary").alias("numbers"))
    met_there = texts.mapInArrow(_dealer(sent, parts, p), schema)
    with run_once(spark):
        found = work.keep(
            keys.unionByName(met_there).repartition(parts, "part").sortWithinPartitions("part", "kind")
            .mapInArrow(_part_counts, "lang string, phrase string, n bigint").filter(F.col("n") >= p.least), "counts")
    sent.destroy()
    return found


def scored(often: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words and more among exact counts.

    ``often``: (lang, phrase, n) with every contiguous part of every phrase.
    """
    phrases = often.filter("contains(phrase, ' ')")
    left = often.select(F.concat_ws("\x01", "lang", "phrase").alias("_first"), F.col("n").alias("l"))
    right = often.select(F.concat_ws("\x01", "lang", "phrase").alias("_rest"), F.col("n").alias("r"))
    parts = F.split("phrase", " ")
    cuts = phrases.withColumn("_words", parts).withColumn(
        "k", F.explode(F.sequence(F.lit(1), F.size("_words") - 1)))
    cuts = cuts.select(
        "lang", "phrase", F.col("n").alias("a"), "k",
        F.concat_ws("\x01", "lang", F.array_join(F.slice("_words", F.lit(1), F.col("k")), " ")).alias("_first"),
        F.concat_ws("\x01", "lang", F.array_join(
            F.slice("_words", F.col("k") + 1, F.size("_words")), " ")).alias("_rest"))
    cuts = lookup_join(lookup_join(cuts, left, "_first"), right, "_rest")
    # Whole numbers of up to 38 digits; the quotient is at most a million.
    big = "cast(a as decimal(19, 0))"
    cuts = cuts.withColumn("score", F.expr(
        f"(cast(1000000 as decimal(38, 0)) * {big} * {big}) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"))
    return cuts.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("_cut")
    ).select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")


def _subsumed(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, longest) of parts: the largest count of a longer phrase that holds them."""
    words = F.split("phrase", " ")
    held = phrases.withColumn("_words", words).filter(F.size("_words") > 2).withColumn(
        "_size", F.explode(F.sequence(F.lit(2), F.size("_words") - 1)))
    held = held.withColumn("_at", F.explode(F.sequence(F.lit(1), F.size("_words") - F.col("_size") + 1)))
    return held.select("lang", F.array_join(F.slice("_words", F.col("_at"), F.col("_size")), " ").alias("phrase"),
                       "n").groupBy("lang", "phrase").agg(F.max("n").alias("longest"))


def collocations(docs: DataFrame, p: Params | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language.

    ``docs``: lang, text; other columns are ignored. A null language is ``und``; null, empty and
    blank texts have no word; texts are read whole and equal rows all count. Equal scores go by
    the larger count, then by the phrase's bytes. An empty table gives no rows.
    """
    p = p or Params()
    work = Work(docs.sparkSession, "phrases")
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text").filter("text IS NOT NULL")
    listed, totals, maps = candidates(work, texts, p)
    often = counted(work, texts, listed, maps, p)

    rated = scored(often)
    rated = rated.join(_subsumed(often), ["lang", "phrase"], "left").filter(
        f"longest IS NULL OR 100 * longest < {p.share} * a").drop("longest")
    best = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(p.buckets))
    near = rated.withColumn("_part", part).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*best))
    ).filter(F.col("_rank") <= p.top)
    ranked = near.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")
    ).filter(F.col("rank") <= p.top)
    out = ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return work.keep(out, "best")
