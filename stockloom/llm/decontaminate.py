"""Benchmark decontamination by templates.

Words become canonical: numbers, names and units turn into typed placeholders, all else is
lower case. A capitalised word may be a name or not, so windows are read both ways, in items and
documents alike, whatever stands before them. Windows of canonical words are hashed and joined with those of the benchmark, so a
question whose numbers or names were replaced still meets its template. Windows of one item at
neighbouring shifts are one alignment, as values may have more or fewer words. Then the slots
decide: along an alignment, equal values of the item must stand for equal values of the document.
Changed windows that break that rule do not count. Windows without a changed slot always count,
and an item of which every window is met is found whatever its slots hold.

Documents keep only windows that the benchmark also has, so what is shuffled grows with the
findings. The benchmark's hashes go to the tasks when there are few enough; beyond the bound
all windows are joined by shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.llm.common import Work, steps, text_buffer
from stockloom.llm.textwords import MIX, WordHasher, mix, powers, windows

# Words that are units when they follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams"
    " kilogram kilograms lb lbs pound pounds oz ounce ounces ton tons ml l liter liters litre litres"
    " gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks"
    " month months year years mph kph kmh percent dollar dollars euro euros cent cents usd eur"
    " degree degrees c f k w kw v volt volts a amp amps hz khz mhz ghz j joule joules n newton"
    " newtons pa bar mol byte bytes kb mb gb tb"
).split()

# Words that are never names, however they are written.
NEVER_NAMES = (
    "a an the this that these those what which who whom whose when where why how if is are was were"
    " be been do does did has have had can could should would must shall and or but nor so yet for of"
    " in on at by to from with without into onto over under between among through during before after"
    " about as than then there here it its he she they we you his her their our your my me him them us"
    " all any each every both some no not only one two three four five six seven eight nine ten while"
    " because since until although though let suppose assume given"
).split()

NUMBER, UNIT, NAME = 1, 2, 3


# Findings up to this many are broadcast (16 bytes each); beyond it they are joined by shuffle.
BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class Params:
    width: int = 8  # words of a window
    least_words: int = 4  # literal words in a window; fewer say nothing
    least_windows: int = 6  # windows of one alignment, or all that the item has
    most_shift: int = 4  # words put in or left out between neighbouring windows of an alignment
    least_item: int = 4  # items with fewer words cannot be told from chance
    task_windows: int = 2_000_000  # most benchmark hashes sent to the tasks


_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = _LOWER[128:] = True
_STOP = np.zeros(256, bool)
_STOP[[10, 13, 33, 46, 58, 63]] = True  # line ends, ! . : ?
_APART = ~_WORD
_APART[[9, 32, 45]] = False  # what may stand between a number and its unit: blanks, -

# Sentence openings of a window that are read one by one; those behind them are read together.
OPENINGS = 3
# Windows with names that are read at once.
READ_WINDOWS = 1 << 16


class Canonical:
    """Canonical words of many texts: their hashes, values, kinds, which may be names, which of
    them open a sentence or line, and first words.

    No kind is NAME: whether a capital makes a name is left to the readings of a window.
    """

    def __init__(self):
        self.words = WordHasher(separator=~_WORD)
        data, bounds = text_buffer(pa.array(UNITS))
        self.units = np.sort(self.words(data, bounds)[0])
        data, bounds = text_buffer(pa.array(NEVER_NAMES))
        self.never = np.sort(self.words(data, bounds)[0])

    def __call__(self, column: pa.Array):
        data, bounds = text_buffer(column)
        data = data.copy()
        digit = _DIGIT[data]
        if len(data) > 2:  # a point or comma between digits belongs to the number
            inner = ((data[1:-1] == 46) | (data[1:-1] == 44)) & digit[:-2] & digit[2:]
            at = np.flatnonzero(inner) + 1
            edge = np.isin(at, bounds) | np.isin(at + 1, bounds)
            data[at[~edge]] = 48
        value, starts, ends, first = self.words(data, bounds)
        n = len(value)
        kind = np.zeros(n, np.int8)
        if not n:
            return value, value, kind, kind > 0, kind > 0, first
        number = _DIGIT[data[starts]]
        kind[number] = NUMBER
        unit = np.zeros(n, bool)
        apart = np.concatenate([[0], np.cumsum(_APART[data])])
        unit[1:] = number[:-1] & (apart[starts[1:]] == apart[ends[:-1]])
        unit[first[:-1][first[:-1] < n]] = False
        place = np.searchsorted(self.units, value).clip(max=len(self.units) - 1)
        kind[unit & (self.units[place] == value) & ~number] = UNIT
        # Perhaps a name: capital, then small letters. Where a sentence or line begins, that is open.
        stops = np.concatenate([[0], np.cumsum(_STOP[data])])
        opens = np.ones(n, bool)
        opens[1:] = stops[starts[1:]] > stops[ends[:-1]]
        opens[first[:-1][first[:-1] < n]] = True
        longer = ends - starts > 1
        small = _LOWER[data[np.minimum(starts + 1, len(data) - 1)]]
        place = np.searchsorted(self.never, value).clip(max=len(self.never) - 1)
        named = (kind == 0) & _UPPER[data[starts]] & longer & small & (self.never[place] != value)
        canon = np.where(kind == 0, value, _typed(kind))
        return canon, value, kind, named, opens & named, first


def _typed(kind):
    """The word that stands for all of a kind."""
    return mix(np.asarray(kind).astype(np.uint64) + np.uint64(99))


def _window_hash(words: np.ndarray) -> np.ndarray:
    """The hashes of windows given as rows, as ``windows`` makes them."""
    width = words.shape[1]
    factor = powers(int(MIX) | 1, width + 1)
    out = np.zeros(len(words), np.uint64)
    for k in range(width):
        out += words[:, k] * factor[k + 1]
    return mix(mix(out) + np.uint64(width))


def _readings(canon, kind, named, opens, at, width: int):
    """(at, words, kinds, full) of the windows with names, for each way to read them.

    Every name that opens a sentence is a name or a literal word for itself, up to OPENINGS of
    them; the other names are so together. All as literal words is not among them; ``full``
    marks windows in which all are names.
    """
    counts = np.concatenate([[0], np.cumsum(named)])
    at = at[counts[at + width] > counts[at]]
    for start in range(0, len(at), READ_WINDOWS):
        some = at[start : start + READ_WINDOWS]
        span = some[:, None] + np.arange(width)
        words, kinds, first = canon[span], kind[span], opens[span]
        bit = np.where(first, np.minimum(np.cumsum(first, axis=1), OPENINGS), 0)
        flag = np.where(named[span], 1 << bit, 0)
        used = np.bitwise_or.reduce(flag, axis=1)
        for reading in range(1, 2 << OPENINGS):
            own = np.flatnonzero((used & reading) == reading)
            if len(own):
                read = (flag[own] & reading) > 0
                yield (some[own], np.where(read, _typed([NAME]), words[own]),
                       np.where(read, np.int8(NAME), kinds[own]), used[own] == reading)


def _extractor(p: Params, widths: list[int], known) -> Callable:
    """Windows of (id, text) rows; with ``known`` only those whose hash it holds, sorted.

    Every window comes in each reading of its names that has literals enough (``full``: all
    are names), and ``raw``, as its plain words, if typing changes it.
    """

    def rows(batch, value, first, h, at, kinds, full, raw=False):
        if not len(at):
            return
        width = kinds.shape[1]
        owner = np.searchsorted(first, at, "right") - 1
        slots = np.where(kinds == 0, np.uint64(0), value[at[:, None] + np.arange(width)])
        take = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(take), batch.column(1).take(take),
             pa.array(h.view(np.int64)), pa.array((at - first[owner]).astype(np.int32)),
             pa.array(np.full(len(at), width, np.int32)),
             pa.FixedSizeListArray.from_arrays(pa.array(slots.view(np.int64).ravel()), width).cast(
                 pa.list_(pa.int64())),
             pa.array(full), pa.array(np.full(len(at), raw))],
            names=["id", "key", "hash", "at", "width", "slots", "full", "raw"])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical = Canonical()
        hashes = None if known is None else known.value

        def asked(h, good):
            if hashes is not None:
                place = np.searchsorted(hashes, h).clip(max=max(len(hashes) - 1, 0))
                good = good & (hashes[place] == h) if len(hashes) else np.zeros(len(h), bool)
            return np.flatnonzero(good)

        for batch in steps(batches):
            canon, value, kind, named, opens, first = canonical(batch.column(2))
            literal = np.concatenate([[0], np.cumsum(kind == 0)])
            names = np.concatenate([[0], np.cumsum(named)])
            for width in widths:
                least = min(p.least_words, width)
                _, at, _ = whole = windows(canon, first, width)
                literals = literal[at + width] - literal[at]
                h = mix(whole[0] + np.uint64(width))
                pick = asked(h, literals >= least)
                kinds = kind[at[pick][:, None] + np.arange(width)]
                full = names[at + width] == names[at]
                yield from rows(batch, value, first, h[pick], at[pick], kinds, full[pick])
                h = mix(windows(value, first, width)[0] + np.uint64(width))
                pick = asked(h, literals < width)
                kinds = np.zeros((len(pick), width), np.int8)
                yield from rows(batch, value, first, h[pick], at[pick], kinds, full[pick], raw=True)
                for at, words, kinds, full in _readings(canon, kind, named, opens, at, width):
                    h = _window_hash(words)
                    pick = asked(h, (kinds == 0).sum(axis=1) >= least)
                    yield from rows(batch, value, first, h[pick], at[pick], kinds[pick], full[pick])

    return extract


ALIGNED = ("doc_id", "text_key", "item_id", "item_key")
WINDOWS = "id bigint, key bigint, hash bigint, at int, width int, slots array<bigint>, full boolean, raw boolean"


def _windows(rows: DataFrame, p: Params, widths: list[int], known=None) -> DataFrame:
    return rows.mapInArrow(_extractor(p, widths, known), WINDOWS)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    canonical = Canonical()
    for batch in steps(batches):
        *_, first = canonical(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(first).astype(np.int64))], names=["item", "words"])


def contaminated(docs: DataFrame, benchmark: DataFrame, p: Params | None = None) -> DataFrame:
    """(doc_id, text_key, item_id, windows, item_windows, coverage, changed, kind, first_word).

    One row per document and benchmark item found in it, with its longest alignment: the
    windows that agree (none if all slots disagree but the whole item is met), how many the item
    has and their ratio, the slots whose value differs,
    ``verbatim`` or ``reparameterised``, and the document's first word of the alignment.
    ``docs``: doc_id, text; ``benchmark``: item_id, text; other columns are ignored.
    ``text_key`` is a hash of the text, which tells rows with the same or no doc_id apart.

    Null and empty texts and items with fewer than ``least_item`` words are never found. Items
    with fewer words than a window are looked for whole. Items without a window of
    ``least_words`` literal words are looked for by their plain words, as copies only. Repeated rows of a document are found
    once, repeated items once per item_id. Empty tables give no rows.
    """
    p = p or Params()
    work = Work(docs.sparkSession, "decontaminate")
    items = work.keep(
        benchmark.select(F.col("item_id").cast("bigint").alias("id"),
                         F.xxhash64("text").alias("key"), "text"),
        "items")
    lengths = work.keep(
        items.select(F.col("id").alias("item"), F.col("text"))
        .mapInArrow(_word_counts, "item bigint, words bigint"),
        "lengths")
    # Window widths: the common one, and those of shorter items.
    short = [r.words for r in lengths.filter(
        (F.col("words") < p.width) & (F.col("words") >= p.least_item)
    ).select("words").distinct().collect()]
    widths = sorted({p.width, *short})
    asked = _windows(items, p, widths).join(
        F.broadcast(_own_widths(lengths, p)) if lengths.count() <= p.task_windows
        else _own_widths(lengths, p), ["id", "width"], "left_semi")
    asked = work.keep(
        asked.select(F.col("id").alias("item_id"), F.col("key").alias("item_key"), "hash",
                     F.col("at").alias("item_at"), F.col("slots").alias("item_slots"), "full", "raw"),
        "typed_and_raw")
    # Items without a typed window are looked for by their plain words.
    typed = asked.filter(~F.col("raw"))
    asked = work.keep(
        typed.unionByName(asked.filter("raw").join(
            typed.select("item_id", "item_key").distinct(), ["item_id", "item_key"], "left_anti")
        ).drop("raw"),
        "asked")
    known = None
    if asked.count() <= p.task_windows:
        found = [r.hash for r in asked.select("hash").distinct().collect()]
        known = work.spark.sparkContext.broadcast(np.sort(np.array(found, np.int64).view(np.uint64)))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.xxhash64("text").alias("key"), "text")
    held = _windows(rows, p, widths, known).select(
        F.col("id").alias("doc_id"), F.col("key").alias("text_key"), "hash", "at", "slots")

    met = held.join(asked, "hash")
    pairs = F.filter(
        F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d")), lambda s: s["i"] != 0)
    aligned = met.select(
        "doc_id", "text_key", "item_id", "item_key", "item_at", "at",
        (F.col("at") - F.col("item_at")).alias("shift"), pairs.alias("pairs"))
    # One shift has no more windows than its item, so its sets are small.
    runs = aligned.groupBy(*ALIGNED, "shift").agg(
        F.collect_set(F.struct("item_at", "at", "pairs")).alias("met"))
    # Neighbouring shifts are one alignment: words were put in or left out on the way.
    order = Window.partitionBy(*ALIGNED).orderBy("shift")
    step = F.col("shift") - F.lag("shift").over(order)
    runs = runs.withColumn("_new", F.when(step <= p.most_shift, 0).otherwise(1))
    runs = runs.withColumn("part", F.sum("_new").over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # Every shift is judged alone, too, as a stray one may spoil its neighbours.
    whole = runs.groupBy(*ALIGNED, "part").agg(F.collect_list("met").alias("_each"))
    together = F.when(F.size("_each") > 1, F.concat("_each", F.array(F.flatten("_each"))))
    whole = whole.select(*ALIGNED, F.explode(F.coalesce(together, "_each")).alias("met"))
    sizes = asked.groupBy("item_id", "item_key").agg(
        F.count_distinct("item_at").alias("item_windows"),
        F.count_distinct(F.when(F.col("full"), F.col("item_at"))).alias("full"))
    bound = F.least(F.lit(p.least_windows), _findable())
    judged = _judged(whole).join(sizes, ["item_id", "item_key"]).filter(
        (F.col("windows") >= bound) | (F.col("met_windows") >= _findable()))
    best = judged.groupBy("doc_id", "text_key", "item_id").agg(
        F.max(F.struct("windows", (-F.col("changed")).alias("same"), (-F.col("first_word")).alias("early"),
                       "item_windows")).alias("best"))
    return best.select(
        "doc_id", "text_key", "item_id",
        F.col("best.windows").cast("bigint").alias("windows"),
        F.col("best.item_windows").cast("bigint").alias("item_windows"),
        (F.col("best.windows") / F.col("best.item_windows")).alias("coverage"),
        (-F.col("best.same")).cast("bigint").alias("changed"),
        F.when(F.col("best.same") == 0, "verbatim").otherwise("reparameterised").alias("kind"),
        (-F.col("best.early")).cast("bigint").alias("first_word"),
    )


def _same(window: Column) -> Column:
    return ~F.exists(window["pairs"], lambda s: s["i"] != s["d"])


def _judged(whole: DataFrame) -> DataFrame:
    """What the windows ``met`` of every alignment say.

    windows: the item's windows that agree, which are copies and those whose values all stand
    for one value each; met_windows: those that agree or not; changed: the slots whose value
    differs in any of them.
    """
    whole = whole.withColumn("_copied", F.transform(F.filter("met", _same), lambda m: m["item_at"]))
    # Where a window is met as a copy, its other places in the text say nothing.
    whole = whole.withColumn("met", F.filter(
        "met", lambda m: _same(m) | ~F.array_contains("_copied", m["item_at"])))
    whole = whole.withColumn(
        "_pairs", F.array_distinct(F.flatten(F.transform("met", lambda m: m["pairs"]))))
    values = F.transform("_pairs", lambda s: s["i"])
    torn = F.filter(F.array_distinct(values), lambda v: F.size(
        F.filter("_pairs", lambda s: s["i"] == v)) > 1)
    whole = whole.withColumn("_torn", torn)
    agree = F.filter("met", lambda m: _same(m) | ~F.arrays_overlap(
        F.transform(m["pairs"], lambda s: s["i"]), "_torn"))

    def count(windows: Column) -> Column:
        return F.size(F.array_distinct(F.transform(windows, lambda m: m["item_at"])))

    return whole.select(
        *ALIGNED, count(agree).alias("windows"), count(F.col("met")).alias("met_windows"),
        F.size(F.filter("_pairs", lambda s: s["i"] != s["d"])).alias("changed"),
        F.array_min(F.transform("met", lambda m: m["at"])).alias("first_word"))


def _findable() -> Column:
    """The item's windows that are met also when all its names are replaced, if there are any."""
    return F.when(F.col("full") > 0, F.col("full")).otherwise(F.col("item_windows"))


def _own_widths(lengths: DataFrame, p: Params) -> DataFrame:
    """The one window width that each item is looked for with."""
    return lengths.filter(F.col("words") >= p.least_item).select(
        F.col("item").alias("id"), F.least("words", F.lit(p.width)).cast("int").alias("width")
    ).distinct()


def cleaned(docs: DataFrame, benchmark: DataFrame, p: Params | None = None) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found.

    Rows are told apart by doc_id and text, so a clean row stays also when it shares its id,
    or the lack of one, with a contaminated row. Null, empty and very short texts hold no item and
    stay; a text of any length is read whole; rows that repeat an id and a text stay or go
    together; other columns may have any name. An empty table gives no rows, an empty benchmark
    all of them.
    """
    work = Work(docs.sparkSession, "cleaned")
    found = contaminated(docs, benchmark, p).select(
        F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key")).distinct()
    found = work.keep(found, "found")
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    names = [f"_c{i}" for i in range(len(docs.columns))]  # no name can clash with the keys
    rows = docs.select(
        docs["doc_id"].cast("bigint").alias("own_id"), F.xxhash64(docs["text"]).alias("own_key"),
        *[docs[f"`{c}`"].alias(n) for c, n in zip(docs.columns, names, strict=True)])
    same = F.col("own_id").eqNullSafe(F.col("found_id")) & (F.col("own_key") == F.col("found_key"))
    return rows.join(found, same, "left_anti").select(
        *[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
