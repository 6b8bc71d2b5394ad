"""Near-duplicate documents: MinHash bands for candidates, odd sketches to sift them, full
shingle sets to confirm.

1. Every text becomes a set of 64-bit hashes of its five-word shingles, MinHash samples of
   that set, band keys over the samples, and an odd sketch. The sketch folds one-permutation
   samples (the least hash in each of ``bins`` ranges) into a parity bitmap: each sample flips
   one bit, so the bits in which two bitmaps differ tell how many samples differ, most
   precisely where nearly all agree. Sets smaller than the bins are folded almost whole.
2. Texts with the same set are one class; its smallest id stands for it.
3. Band buckets give candidates. First every member is compared with the smallest of its
   bucket. Then, in buckets whose members still lie in several components, every member
   outside the bucket's largest component is compared with the members of the others. Pairs
   inside a component need no comparison, so a group of thousands of copies costs about one
   comparison per copy and band, not one per pair; no pair that could join two components is
   left out.
4. Candidates whose sketches differ by ``sigmas`` standard errors more than at the threshold
   are dropped, inside the join that makes them. The rest are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.llm.common import Work, few, steps, text_buffer
from stockloom.llm.components import components
from stockloom.llm.textwords import MIX, WordHasher, mix, windows

# Ids up to this many are broadcast to pick the texts to compare (16 bytes each); beyond it
# they are joined by shuffle.
BROADCAST_IDS = 1_000_000

# Rows with a sketch and bands, about 1 KB each, that a task takes.
WIDE_ROWS = 10_000
# Pairs that a task confirms on their texts, which it sorts and holds in part.
TEXT_PAIRS = 5_000


@dataclass(frozen=True)
class Params:
    """``percent``: least similarity. At 75, 60 bands of 6 samples miss a pair of exactly that
    similarity with a chance of 8 in a million, and more similar ones more rarely."""

    width: int = 5
    percent: int = 75
    bands: int = 60
    rows: int = 6
    sketch_bits: int = 4096
    bins: int = 8192
    sigmas: float = 4.5

    @property
    def samples(self) -> int:
        return self.bands * self.rows


def most_bits(shingles: Column, used: Column, p: Params) -> Column:
    """Sketch bits in which a pair at the threshold may differ.

    ``shingles``: the sizes of both sets together; ``used``: the bins in use together. The
    union spreads over the bins; a bin's least hash is shared with the chance of the
    similarity, and what is not shared differs. The bound is ``sigmas`` standard errors wider:
    of the samples, which vanish when the bins hold the whole sets, and of folding them.

    A second bound holds for certain, and is the lesser for small sets: a bit differs by a sample
    that only one set has, which is a shingle of one set alone or one that its bin hides in the
    other, and shingles that meet in one bit only make less of them.
    """
    j, n = p.percent / 100, p.sketch_bits
    union = shingles / (1 + j)
    filled = p.bins * (1 - F.exp(-union / p.bins))
    lost = F.greatest(union - filled, F.lit(0.0))  # hashes hidden by a lesser one in their bin
    sampling = filled * j * (1 - j) * lost / union + lost * F.exp(-2 * union / p.bins)
    differ = F.greatest(used - 2 * j * filled, F.lit(0.0))
    fade = F.exp(-4 * differ / n)
    folding = F.greatest(n / 4 * (1 - fade) - differ * fade, F.lit(0.0))
    likely = n / 2 * (1 - F.exp(-2 * differ / n)) + p.sigmas * F.sqrt(4 * sampling + folding) + 4
    # Whole numbers, so that a pair of exactly the threshold is not lost by rounding.
    certain = F.floor(shingles * (100 - p.percent) / (100 + p.percent) + 1e-6) + shingles - used
    return F.least(likely, certain.cast("double"))


def shingle_sets(words: WordHasher, column: pa.Array, width: int):
    """Distinct shingle hashes of each text, and each text's first one (n + 1 entries).

    A text with fewer words than ``width`` has its whole word sequence as one shingle; one
    without words has none.
    """
    data, bounds = text_buffer(column)
    hashes, _, _, first = words(data, bounds)
    values, _, runs = windows(hashes, first, width)
    owner = np.repeat(np.arange(len(column)), np.diff(runs))
    counts = np.diff(first)
    for n in range(1, width):  # short texts: one run over all their words
        short = np.flatnonzero(counts == n)
        if len(short):
            at = first[:-1][short]
            total = np.zeros(len(short), np.uint64)
            for k in range(n):
                total = mix(total * MIX + hashes[at + k] + np.uint64(n))
            values, owner = np.concatenate([values, total]), np.concatenate([owner, short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[fresh], owner[fresh]
    return values, np.searchsorted(owner, np.arange(len(column) + 1))


SIGNATURE = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_shingles", T.LongType()),
    T.StructField("set_a", T.LongType()),
    T.StructField("set_b", T.LongType()),
    T.StructField("bands", T.ArrayType(T.LongType())),
    T.StructField("sketch", T.ArrayType(T.LongType())),
    T.StructField("used", T.LongType()),
])


def odd_sketches(values: np.ndarray, owner: np.ndarray, n: int, p: Params):
    """Parity bitmaps of n sets (64-bit words in a row) and the bins each set uses."""
    hashed = mix(values + MIX)
    order = np.lexsort((hashed, owner))
    hashed, owner = hashed[order], owner[order]
    bin_ = hashed >> np.uint64(64 - (p.bins - 1).bit_length())
    least = np.ones(len(hashed), bool)
    least[1:] = (bin_[1:] != bin_[:-1]) | (owner[1:] != owner[:-1])
    hashed, owner = hashed[least], owner[least]
    place = mix(hashed) >> np.uint64(64 - (p.sketch_bits - 1).bit_length())
    flips = np.bincount(owner * p.sketch_bits + place.astype(np.int64), minlength=n * p.sketch_bits)
    words = np.packbits((flips & 1).astype(np.uint8)).view(np.int64)
    return words, np.bincount(owner, minlength=n)


def _signer(p: Params) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.Generator(np.random.PCG64(7))
        odd = rng.integers(0, 1 << 63, p.samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        flip = rng.integers(0, 1 << 63, p.samples, dtype=np.uint64)
        weight = rng.integers(0, 1 << 63, p.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        words = WordHasher()
        for batch in steps(batches):
            values, first = shingle_sets(words, batch.column(1), p.width)
            sizes = np.diff(first)
            full = np.flatnonzero(sizes)
            sample = np.zeros((len(full), p.samples), np.uint64)
            if len(full):
                starts = first[:-1][full]
                for k in range(p.samples):
                    sample[:, k] = np.minimum.reduceat((values ^ flip[k]) * odd[k], starts)
                set_a = np.add.reduceat(values, starts)
                set_b = np.add.reduceat(mix(values ^ MIX), starts)
            else:
                set_a = set_b = np.zeros(0, np.uint64)
            numbers = np.arange(p.bands, dtype=np.uint64) * MIX
            keys = (sample.reshape(-1, p.bands, p.rows) * weight).sum(2, dtype=np.uint64)
            keys = mix(keys + numbers)
            sketch, used = odd_sketches(values, np.repeat(np.arange(len(full)), sizes[full]), len(full), p)

            n = batch.num_rows
            mask = sizes == 0

            def spread(values, mask=mask, full=full, n=n):
                out = np.zeros(n, np.int64)
                out[full] = values.view(np.int64)
                return pa.array(out, mask=mask)

            def lists(flat, width, mask=mask, n=n):
                offsets = np.concatenate([[0], np.cumsum(np.where(mask, 0, width))])
                return pa.ListArray.from_arrays(
                    pa.array(offsets.astype(np.int32)), pa.array(flat), mask=pa.array(mask))

            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes.astype(np.int64)), spread(set_a), spread(set_b),
                 lists(keys.ravel().view(np.int64), p.bands),
                 lists(sketch, p.sketch_bits // 64), spread(used)],
                names=SIGNATURE.fieldNames())

    return sign


def _confirmer(p: Params) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keep the pairs (a, b, text, other) whose full sets meet the threshold."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHasher()
        for wide in steps(batches, "text"):
            for batch in steps(iter([wide]), "other"):
                n = batch.num_rows
                left, left_at = shingle_sets(words, batch.column(2), p.width)
                right, right_at = shingle_sets(words, batch.column(3), p.width)
                left_n, right_n = np.diff(left_at), np.diff(right_at)
                owner = np.concatenate([np.repeat(np.arange(n), left_n),
                                        np.repeat(np.arange(n), right_n)])
                both = np.concatenate([left, right])
                order = np.lexsort((both, owner))
                both, owner = both[order], owner[order]
                same = (both[1:] == both[:-1]) & (owner[1:] == owner[:-1])
                shared = np.bincount(owner[1:][same], minlength=n)
                linked = 100 * shared >= p.percent * (left_n + right_n - shared)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(linked))

    return confirm


def signatures(docs: DataFrame, p: Params) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _signer(p), SIGNATURE)


def _alike(p: Params) -> Column:
    """Whether the odd sketches of rows with columns sa, na, ua and sb, nb, ub allow a link."""
    # Word by word inside the expression: written out, the generated method is too long to be compiled.
    differ = F.aggregate(
        F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, bits: total + bits)
    # Sets of sizes too far apart share too little, whatever they share.
    sizes = 100 * F.least("na", "nb") >= p.percent * F.greatest("na", "nb")
    return sizes & (differ <= most_bits(F.col("na") + F.col("nb"), F.col("ua") + F.col("ub"), p))


def _sketched(reps: DataFrame, side: str) -> DataFrame:
    return reps.select(F.col("doc_id").alias(side), F.col("sketch").alias(f"s{side}"),
                       F.col("n_shingles").alias(f"n{side}"), F.col("used").alias(f"u{side}"))


def _confirmed(work: Work, name: str, pairs: DataFrame, docs: DataFrame, p: Params) -> DataFrame:
    """Links among candidate pairs, on the texts of the documents that occur in them."""
    pairs = work.keep(pairs, f"{name}_pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).distinct().unionByName(
        pairs.select(F.col("b").alias("doc_id")).distinct())
    n = pairs.count()
    if n * 2 <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(
        ids, "doc_id", "left_semi")
    left = texts.select(F.col("doc_id").alias("a"), "text")
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("other"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text", "other")
    both = few(both, n, TEXT_PAIRS)
    return work.keep(both.mapInArrow(_confirmer(p), "a bigint, b bigint"), name)


def _same_document(known: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) that join the classes of a doc_id which rows with different sets repeat."""
    sets = known.groupBy("doc_id", "set_a", "set_b", "n_shingles").count()
    several = sets.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return sets.join(several, "doc_id", "left_semi").join(
        classes, ["set_a", "set_b", "n_shingles"]
    ).select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))


def near_duplicates(docs: DataFrame, p: Params | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, n_class) for every row of ``docs``.

    ``docs``: doc_id, text; other columns are ignored. Two documents are linked when
    100 * shared >= percent * union on their sets of shingles; ``component_id`` is the smallest
    doc_id reachable over links, ``kept`` tells the document of that id, ``n_class`` counts the
    rows with the same set.

    Null or blank texts have no shingle, link with nothing and are kept. A row with a null
    doc_id cannot be named in a link: its component is null and it is kept. Rows that repeat a
    doc_id are one document with several texts; each row comes back with its own count. An
    empty table gives no rows.
    """
    p = p or Params()
    work = Work(docs.sparkSession, "near_dup")
    signed = work.keep(signatures(docs, p), "signed")
    known = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    n_docs = signed.count()
    classes = work.keep(few(
        known.groupBy("set_a", "set_b", "n_shingles")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n_class")), n_docs),
        "classes")

    # One row per class, the one of its smallest id.
    reps = known.join(
        classes.select("set_a", "set_b", "n_shingles", F.col("rep").alias("doc_id")),
        ["set_a", "set_b", "n_shingles", "doc_id"], "left_semi",
    ).dropDuplicates(["set_a", "set_b", "n_shingles"]).select("doc_id", "n_shingles", "bands", "sketch", "used")
    reps = work.keep(few(reps, n_docs, WIDE_ROWS), "reps")
    keyed = reps.select("doc_id", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(
        F.min("doc_id").alias("pivot"), F.max("doc_id").alias("_last")
    ).filter("_last > pivot").select("key", "pivot")
    members = work.keep(few(
        keyed.join(buckets, "key").select("key", "pivot", "doc_id"), n_docs * p.bands), "members")
    n_members = members.count()

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        # A repeated doc_id may have several sketches; any of them may link.
        near = pairs.join(_sketched(reps, "a"), "a").join(
            _sketched(reps, "b"), "b").filter(_alike(p))
        return _confirmed(work, name, few(near.select("a", "b").distinct(), n_members), docs, p)

    def in_components(found: DataFrame) -> DataFrame:
        return few(members.join(_small(found.withColumnRenamed("node", "doc_id")), "doc_id", "left").select(
            "key", "pivot", "doc_id", F.coalesce("component", "doc_id").alias("component")), n_members)

    # Each document is compared with one pivot, the smallest of its buckets, and then with the
    # smallest and the largest of those of its buckets that lie in other components: members of a
    # large group meet each other's pivots no more, and few of its buckets stay mixed.
    once = members.filter("doc_id > pivot").groupBy("doc_id").agg(F.min("pivot").alias("a"))
    links = linked(once.select("a", F.col("doc_id").alias("b")), "once")
    for name, pick in (("stars", F.min), ("ends", F.max)):
        placed = work.keep(in_components(work.keep(few(components(links, links.count()), n_docs), f"found_{name}")), f"placed_{name}")
        pivots = placed.groupBy("key").agg(pick(F.struct("doc_id", "component")).alias("p")).select(
            "key", F.col("p.doc_id").alias("a"), F.col("p.component").alias("own"))
        stars = placed.join(pivots, "key").filter("component <> own AND doc_id <> a").select(
            "a", F.col("doc_id").alias("b")).distinct()
        links = work.keep(links.unionByName(linked(stars, name)), f"links_{name}")
        work.drop(f"placed_{name}", f"{name}_pairs")
    work.drop("once_pairs")
    found = work.keep(few(components(links, links.count()), n_docs), "found")

    placed = in_components(found).drop("pivot")
    placed = work.keep(placed, "placed")
    sizes = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("key").agg(
        F.count(F.lit(1)).alias("parts"),
        F.max(F.struct("n", "component")).alias("top"),
    ).filter("parts > 1").select("key", F.col("top.component").alias("main"))
    still = work.keep(few(placed.join(mixed, "key"), n_members), "still")
    # A document meets its sketch once, whatever number of buckets it brings along.
    homes = work.keep(few(still.groupBy("doc_id", "component").agg(
        F.collect_list(F.struct("key", "main")).alias("homes")), n_docs, WIDE_ROWS), "homes")

    def placed_with_sketch(side: str, component: str) -> DataFrame:
        rows = homes.select(F.col("doc_id").alias(side), F.col("component").alias(component), "homes").join(
            _sketched(reps, side), side)
        # The documents of a pair lie in different components, so all buckets they share are mixed: the
        # keys of those tell the first one as well as all bands would, in fewer bytes.
        return rows.withColumn(f"k{side}", F.col("homes.key")).withColumn("home", F.explode("homes")).select(
            "*", "home.*").drop("home", "homes")

    minor = placed_with_sketch("a", "ca").filter("ca <> main").drop("main")
    other = placed_with_sketch("b", "component")
    # A pair of two outside members is taken once, by the smaller component, and a pair that
    # meets in several buckets only in the first of them.
    first = F.array_min(F.array_intersect("ka", "kb")) == F.col("key")
    rest = minor.join(other, "key").filter(
        ((F.col("component") == F.col("main")) | (F.col("ca") < F.col("component")))
        & (F.col("ca") != F.col("component")) & _alike(p) & first
    ).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    more = _confirmed(work, "rest", rest, docs, p)
    final = components(
        links.unionByName(more).unionByName(_same_document(known, classes)), links.count() + more.count())

    named = classes.join(final, classes.rep == final.node, "left")
    named = named.select("set_a", "set_b", "n_shingles", "n_class",
                         F.coalesce("component", "rep").alias("component_id"))
    rows = signed.select("doc_id", "n_shingles", "set_a", "set_b").join(
        named, ["set_a", "set_b", "n_shingles"], "left")
    result = rows.select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
        .alias("component_id"),
        F.coalesce("n_class", F.lit(1)).cast("bigint").alias("n_class"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    return result.select("doc_id", "n_shingles", "component_id", "kept", "n_class")


def deduplicated(docs: DataFrame, p: Params | None = None) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one row of each group stays, the one of the
    smallest doc_id, then of the smallest hash of id and text.

    Rows are told apart by doc_id and text, so different texts under one doc_id are different
    documents. Rows with a null doc_id stay; of rows that repeat a doc_id and its text the one
    of the smallest hash of all columns (maps aside) stays.
    """
    work = Work(docs.sparkSession, "deduplicated")
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text"))
    found = near_duplicates(docs.select(key.alias("doc_id"), "text"), p)
    n_docs = docs.count()
    linked = work.keep(
        few(found.filter(~F.col("kept")).select(F.col("doc_id").alias("_key"), "component_id").distinct(), n_docs),
        "linked")
    first = linked.select(F.col("component_id").alias("_key"), "component_id").distinct()
    members = linked.unionByName(first)
    ids = docs.select("doc_id", key.alias("_key")).join(_small(members), "_key")
    stays = ids.groupBy("component_id").agg(
        F.min(F.struct("doc_id", "_key")).alias("_first")).select(F.col("_first._key").alias("_key"))
    stays = work.keep(few(stays, n_docs), "stays")
    gone = work.keep(few(members.select("_key").join(_small(stays), "_key", "left_anti"), n_docs), "gone")
    names = [f"_c{i}" for i in range(len(docs.columns))]  # no name can clash with the key
    rows = docs.select(key.alias("_key"), *[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)])
    rest = rows.join(_small(gone), "_key", "left_anti")
    repeated = work.keep(few(
        rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1 AND _key IS NOT NULL").select("_key"), n_docs), "repeated")
    if not repeated.isEmpty():
        plain = [n for n in names if "map<" not in rows.schema[n].dataType.simpleString()]
        one = rest.join(_small(repeated), "_key", "left_semi").groupBy("_key").agg(
            F.min_by(F.struct(*names), F.xxhash64(*plain)).alias("_row"))
        rest = rest.join(_small(repeated), "_key", "left_anti").select(*names).unionByName(
            one.select("_row.*"))
    return rest.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])


def _small(ids: DataFrame) -> DataFrame:
    """Marked for broadcast when there are few enough ids."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
