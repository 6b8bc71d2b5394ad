"""Spelling variants: words one edit apart, by composing acceptors with a one-edit transducer.

A pair of words that differ by one edit agrees outside one of ``parts`` parts of the shorter
one. So each word is read in ``parts`` orders, first what lies outside a part (the same states
for all words that agree there), then the part itself: what is read first leads to an initial
state, and the words behind it are found by composing the minimised acceptor of the parts with the
one-edit transducer and with the acceptor again. The edit's place decides in which part a pair is
found, so each pair is accepted once. Words of one initial state meet in one task and differ in
one part only, which bounds them; pairs never leave the task, only counts and best variants do.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm import edit_automata
from stockloom.llm.common import Work, few, steps, text_buffer
from stockloom.llm.textwords import LOWER, WordHasher, mix
from stockloom.plans.lookup import shuffle_partitions


@dataclass(frozen=True)
class Params:
    shortest: int = 5  # code points of a word
    least: int = 3  # occurrences of a word
    modulus: int = 97  # one run in so many loses a code point
    ratio: int = 2  # a form is at least so many times as frequent
    parts: int = 3
    chunk_rows: int = 150_000  # rows composed at once
    task_rows: int = 1_000_000  # rows expected in a task


ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[65:91] = ASCII_LETTER[97:123] = True
LEAD = 0xC3  # the first byte of U+00C0 to U+00FF in UTF-8
BLANK = np.zeros(256, bool)
BLANK[32] = True
LONG_RUN = 64  # bytes; longer runs are checked one by one


def letters_only(data: np.ndarray) -> np.ndarray:
    """Lower-case bytes of the letters A-Z, a-z and U+00C0 to U+00FF, blanks elsewhere."""
    lead = data == LEAD
    letter = ASCII_LETTER[data] | lead
    letter[1:] |= lead[:-1]
    return np.where(letter, LOWER[data], np.uint8(32))


def crc32_behind(prefix: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of a text with checksum ``prefix`` followed by data[start:end], for all rows."""
    table = _table()
    state = prefix.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    size = ends - starts
    rows = np.flatnonzero(size <= LONG_RUN)
    depth = 0
    while len(rows := rows[size[rows] > depth]):
        now = state[rows]
        state[rows] = table[(now ^ data[starts[rows] + depth]) & np.uint32(255)] ^ (now >> np.uint32(8))
        depth += 1
    state ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > LONG_RUN):
        state[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(prefix[i]))
    return state


def _table() -> np.ndarray:
    """The checksum's table for one byte, from its polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & np.uint32(1), np.uint32(0xEDB88320) ^ (table >> np.uint32(1)), table >> np.uint32(1))
    return table


def _cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)])
    body = data[np.arange(int(offsets[-1])) + np.repeat(starts - offsets[:-1], size)]
    return pa.Array.from_buffers(pa.large_string(), len(starts), [
        None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(body.tobytes())]).cast(pa.string())


def _word_counter(p: Params) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = WordHasher(BLANK, np.arange(256, dtype=np.uint8))
        for batch in steps(batches):
            raw, bounds = text_buffer(batch.column(1))
            data = letters_only(raw)
            hashes, starts, ends, first = find(data, bounds)
            if not len(hashes):
                continue
            # A run's fate is the same wherever it stands in its document.
            owner = np.repeat(np.arange(batch.num_rows, dtype=np.uint64), np.diff(first))
            _, one, n = np.unique(mix(hashes + owner * np.uint64(0x9E3779B97F4A7C15)),
                                  return_index=True, return_counts=True)
            heads = [zlib.crc32(f"{x}:".encode()) for x in batch.column(0).to_pylist()]
            head = np.array(heads, np.uint32)[owner[one].astype(np.int64)]
            crc = crc32_behind(head, data, starts[one], ends[one])
            hit = crc % np.uint32(p.modulus) == 0
            words, counts = [], []
            for i in np.flatnonzero(hit):
                run_ = data[starts[one[i]] : ends[one[i]]].tobytes().decode()
                at = int(crc[i]) % len(run_)
                if len(run_) > p.shortest:
                    words.append(run_[:at] + run_[at + 1 :])
                    counts.append(int(n[i]))
            leads = np.concatenate([[0], np.cumsum(data == LEAD)])
            points = ends - starts - (leads[ends] - leads[starts])
            keep = ~hit & (points[one] >= p.shortest)
            one, n = one[keep], n[keep]
            _, some, back = np.unique(hashes[one], return_index=True, return_inverse=True)
            at = one[some]
            total = np.bincount(back, n, len(at)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([_cut(data, starts[at], ends[at]), pa.array(words, pa.string())]),
                 pa.array(np.concatenate([total, np.array(counts, np.int64)]))], names=["word", "n"])

    return run


def vocabulary(docs: DataFrame, p: Params | None = None) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text) that are long and frequent enough."""
    p = p or Params()
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    return rows.filter("text IS NOT NULL").mapInArrow(_word_counter(p), "word string, n bigint").groupBy(
        "word").agg(F.sum("n").alias("n")).filter(F.col("n") >= p.least)


def read_orders(words: DataFrame, p: Params) -> DataFrame:
    """(outside, last, long, inside, n): each word in the orders in which a pair can be found.

    A word stands as the shorter of a pair, and as the longer one with a code point more than the
    shorter one has. ``outside`` holds the shorter one's length, the part and what lies before and
    behind it.
    """
    size = F.char_length("word")
    rows = words.withColumn("long", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "_m", size - F.col("long")).filter(F.col("_m") >= p.shortest)
    rows = rows.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(p.parts - 1))))
    rows = rows.withColumn("_s", F.expr(f"int(_m * _t div {p.parts})")).withColumn(
        "_e", F.expr(f"int(_m * (_t + 1) div {p.parts})") + F.col("long"))
    word = F.col("word")
    behind = word.substr(F.col("_e") + 1, size)
    return rows.select(
        F.concat_ws("|", "_m", "_t", word.substr(F.lit(1), F.col("_s")), behind).alias("outside"),
        (F.col("_t") == p.parts - 1).alias("last"), F.col("long"),
        word.substr(F.col("_s") + 1, F.col("_e") - F.col("_s")).alias("inside"), "n")


def _points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points (below 256) of all rows, and each row's first (n + 1 entries)."""
    data, bounds = text_buffer(column)
    lead = data == LEAD
    before = np.concatenate([[0], np.cumsum(lead)])
    points = data[~lead].copy()
    points[points >= 128] += 64
    return points, bounds - before[bounds]


def near_pairs(outside: np.ndarray, last: np.ndarray, long: np.ndarray, inside: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows (x, y) of all pairs one edit apart, each once, of rows sorted by outside, long, inside.

    ``outside``: the number of the row's initial state, which does not decrease.
    """
    points, first = _points(inside)
    size = np.diff(first)
    short_size = size - long
    left, right = [], []
    for k in np.unique(short_size):
        rows = np.flatnonzero(short_size == k)
        groups, group = np.unique(outside[rows], return_inverse=True)
        found, begin, automata = [], [], []
        for kind in (0, 1):
            own = np.flatnonzero(long[rows] == kind)
            at = rows[own]
            strings = points[first[at][:, None] + np.arange(k + kind)]
            levels, initial = edit_automata.minimised(strings, group[own], len(groups))
            automata.append(levels)
            found.append(initial)
            begin.append((at, np.searchsorted(group[own], np.arange(len(groups)))))
        has = np.flatnonzero(found[0] >= 0)
        states, which = np.unique(found[0][has], return_inverse=True)
        start, i, j = edit_automata.replaced(automata[0], states)
        x, pair = _per_group(start, which, has, len(states))
        at, head = begin[0]
        left.append(at[head[x] + i[pair]])
        right.append(at[head[x] + j[pair]])
        both = np.flatnonzero((found[0] >= 0) & (found[1] >= 0))
        if not len(both):
            continue
        ends = np.zeros(len(groups), bool)
        ends[group] = last[rows]
        states, which = np.unique(
            np.stack([found[0][both], found[1][both], ends[both]]), axis=1, return_inverse=True)
        start, i, j = edit_automata.inserted(*automata, states[0], states[1], states[2].astype(bool))
        x, pair = _per_group(start, which.reshape(-1), both, states.shape[1])
        left.append(at[head[x] + i[pair]])
        at, head = begin[1]
        right.append(at[head[x] + j[pair]])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _per_group(start: np.ndarray, which: np.ndarray, groups: np.ndarray, states: int) -> tuple[np.ndarray, np.ndarray]:
    """(group, pair) for every pair of an initial state and every group that has that state."""
    order = np.argsort(which, kind="stable")
    size = np.bincount(which, minlength=states)
    begin = np.cumsum(size) - size
    repeat = size[start]
    pair = np.repeat(np.arange(len(start)), repeat)
    place = np.arange(len(pair)) - np.repeat(np.cumsum(repeat) - repeat, repeat)
    return groups[order[begin[start[pair]] + place]], pair


def _composer(p: Params) -> Callable:
    def compose(table: pa.Table) -> pa.RecordBatch | None:
        outside = table["outside"].combine_chunks()
        group = np.asarray(outside.dictionary_encode().indices).astype(np.int64)
        alone = np.bincount(group)[group] == 1
        rows = np.flatnonzero(~alone)
        table = table.take(pa.array(rows))
        inside, n = table["inside"].combine_chunks(), table["n"].to_numpy()
        x, y = near_pairs(group[rows], table["last"].to_numpy(), table["long"].to_numpy().astype(np.int64), inside)
        if not len(x):
            return None
        x, y = np.concatenate([x, y]), np.concatenate([y, x])
        met, x = np.unique(x, return_inverse=True)  # rows with a variant
        y = np.searchsorted(met, y)
        some = table.take(pa.array(met))
        words = []
        for around, part in zip(some["outside"].to_pylist(), some["inside"].to_pylist(), strict=True):
            _, _, before, behind = around.split("|")
            words.append(before + part + behind)
        words, n = pa.array(words, pa.string()), n[met]
        rank = np.empty(len(met), np.int64)
        rank[pc.sort_indices(words).to_numpy()] = np.arange(len(met))
        order = np.lexsort((rank[y], -n[y], x))
        best = y[order[np.searchsorted(x[order], np.arange(len(met)))]]
        return pa.RecordBatch.from_arrays(
            [words, pa.array(np.bincount(x)), pa.array(n[best]), words.take(pa.array(best))],
            names=["word", "n_near", "best_n", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        rows = 0

        def flush(whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal kept, rows
            table = pa.Table.from_batches(kept)
            outside = table["outside"].combine_chunks()
            stop = len(outside)
            if not whole:  # the last initial state may go on in the next batch
                last = outside[stop - 1]
                stop = int(pc.index(outside, last).as_py())
            if stop:
                found = compose(table.slice(0, stop))
                if found is not None:
                    yield found
            kept = table.slice(stop).to_batches()
            rows = sum(x.num_rows for x in kept)

        limit = p.chunk_rows
        for batch in batches:
            kept.append(batch)
            rows += batch.num_rows
            if rows >= limit:
                yield from flush(False)
                # An initial state with more rows than a chunk is gathered whole.
                limit = max(p.chunk_rows, 2 * rows)
        if rows:
            yield from flush(True)

    return run


def variants(words: DataFrame, p: Params | None = None) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) that have a near word."""
    p = p or Params()
    orders = read_orders(words, p)
    tasks = max(shuffle_partitions(words.sparkSession), 2 * p.parts * words.count() // p.task_rows + 1)
    dealt = orders.repartition(tasks, "outside").sortWithinPartitions("outside", "long", "inside")
    found = dealt.mapInArrow(_composer(p), "word string, n_near bigint, best_n bigint, best string")
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("_best")
    ).select("word", "n_near", (-F.col("_best.m")).alias("best_n"), F.col("_best.best").alias("best"))


def roots(work: Work, forms: DataFrame, n: int) -> DataFrame:
    """(word, root) of every word in ``forms`` (word, form), at most ``n``: the end of its chain of forms.

    A form is at least twice as frequent as its word, so there are no cycles; each round doubles
    the steps taken.
    """
    now = work.keep(few(forms.select("word", F.col("form").alias("root")), n), "roots0")
    number = 0
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        number += 1
        after = work.keep(few(now.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), n),
            f"roots{number}")
        work.drop(f"roots{number - 1}")
        moved = after.filter("moved").limit(1).count()
        now = after.select("word", "root")
        if not moved:
            return now


def groups(docs: DataFrame, p: Params | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs`` (doc_id, text).

    Null and empty texts have no word; a null doc_id is read as empty before the colon; rows that
    repeat an id or a text all count, also runs of any length. Of equally frequent near words
    the smallest is the form. Other columns are ignored. An empty table gives no rows.
    """
    p = p or Params()
    work = Work(docs.sparkSession, "spelling")
    words = work.keep(vocabulary(docs, p), "words")
    n = words.count()
    near = work.keep(few(variants(words, p), n), "near")
    formed = F.col("best_n") >= p.ratio * F.col("n")
    seen = work.keep(few(words.join(near, "word", "left").select(
        "word", F.when(formed, F.col("best")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best_n")).alias("form_n")), n), "seen")
    work.drop("near", "words")
    ends = roots(work, seen.filter("form IS NOT NULL"), n)
    return seen.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
