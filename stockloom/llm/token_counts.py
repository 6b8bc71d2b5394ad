"""Token counts that follow edits: a tree of pre-token segments per document.

A document's text is cut into pre-tokens by the tokenizer's pattern; ``leaf`` of them form a
segment with its letters and tokens, and sums over pairs of segments form a tree up to the
document's total. An edit (place, letters removed, text put in) finds its segments by walking
down the tree. Only there is the text cut and encoded again: from a boundary far enough before
the edit that nothing before it can change, to the first boundary behind the edit that the old
text also had. From such a boundary on the pattern, which looks at nothing before it, goes on
exactly as it did, so the other segments stay and only the sums above the changed ones are
made anew.

Edits of one document are applied one after the other, each on the text the one before left.
Documents are independent; a row carries its own edits, so nothing is grouped.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import prepare, steps

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern by which this vocabulary cuts texts.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The pattern looks at most this many letters past the end of a pre-token: one that stops it,
# and one more for a blank that is left to the word behind it.
AHEAD = 2
MEMORY = 200_000  # pre-tokens whose counts a task remembers

EDITS = "array<struct<at:int,removed:int,text:string>>"


@dataclass(frozen=True)
class Params:
    ranks: str = DEFAULT_RANKS
    leaf: int = 32  # pre-tokens of a segment


def load_ranks(path: str = DEFAULT_RANKS) -> dict[bytes, int]:
    """The vocabulary as ranks, read on the driver."""
    import base64

    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class Counter:
    """Tokens of single pre-tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.pattern = regex.compile(PATTERN)
        self.encoding = tiktoken.Encoding(
            "counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, int] = {}
        self.made = 0  # pre-tokens counted

    def __call__(self, piece: str) -> int:
        self.made += 1
        n = self.known.get(piece)
        if n is None:
            n = len(self.encoding.encode_ordinary(piece))
            if len(piece) <= 64:
                if len(self.known) >= MEMORY:
                    self.known.clear()
                self.known[piece] = n
        return n


class Tree:
    """Letters and tokens of a document's segments, with sums over them."""

    def __init__(self, letters: list[int], tokens: list[int]):
        self.levels = [(list(letters), list(tokens))]
        self._finish()

    def _finish(self) -> None:
        """Add or take away levels so that the topmost holds one sum, or none."""
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 1:
            self.levels.pop()
        while len(self.levels[-1][0]) > 1:
            below = self.levels[-1]
            self.levels.append(tuple(
                [sum(x[i : i + 2]) for i in range(0, len(x), 2)] for x in below))

    @property
    def letters(self) -> int:
        return self.levels[-1][0][0] if self.levels[0][0] else 0

    @property
    def tokens(self) -> int:
        return self.levels[-1][1][0] if self.levels[0][0] else 0

    def find(self, at: int) -> tuple[int, int]:
        """The segment that holds letter ``at`` (the last one beyond the end), and its start."""
        node, start = 0, 0
        for letters, _ in reversed(self.levels[:-1]):
            node *= 2
            if node + 1 < len(letters) and at >= start + letters[node]:
                start += letters[node]
                node += 1
        return node, start

    def replace(self, first: int, last: int, letters: list[int], tokens: list[int]) -> None:
        """Put new segments in the place of first .. last - 1, and renew the sums above."""
        old_letters, old_tokens = self.levels[0]
        same = last - first == len(letters)
        old_letters[first:last] = letters
        old_tokens[first:last] = tokens
        if not same:  # the segments behind moved to other parents
            lo = first
        for level in range(1, len(self.levels)):
            below, here = self.levels[level - 1], self.levels[level]
            size = (len(below[0]) + 1) // 2
            if same:
                span = range(first >> level, min(((last - 1) >> level) + 1, size) if last > first else 0)
                for b, h in zip(below, here, strict=True):
                    for i in span:
                        h[i] = sum(b[2 * i : 2 * i + 2])
                continue
            lo >>= 1
            for b, h in zip(below, here, strict=True):
                h[lo:] = [sum(b[2 * i : 2 * i + 2]) for i in range(lo, size)]
        self._finish()


def _leaves(counter: Counter, text: str, ends: list[int], start: int, leaf: int):
    """Segments of pre-tokens that end at ``ends``, the first beginning at ``start``."""
    letters, tokens = [], []
    for i in range(0, len(ends), leaf):
        own = ends[i : i + leaf]
        total, at = 0, start
        for end in own:
            total += counter(text[at:end])
            at = end
        letters.append(at - start)
        tokens.append(total)
        start = at
    return letters, tokens


def build(counter: Counter, text: str, leaf: int) -> Tree:
    ends = [m.end() for m in counter.pattern.finditer(text)]
    return Tree(*_leaves(counter, text, ends, 0, leaf))


def edit(counter: Counter, tree: Tree, text: str, at: int, removed: int, added: str, leaf: int) -> str:
    """Apply one edit to a text and its tree; the place and length are cut to the text."""
    at = min(max(at, 0), len(text))
    removed = min(max(removed, 0), len(text) - at)
    new = text[:at] + added + text[at + removed :]
    if not text:
        fresh = build(counter, new, leaf)
        tree.levels = fresh.levels
        return new
    # Start at a segment that begins early enough: the pre-token before it ends more than
    # AHEAD letters before the edit, so what it looked at is unchanged.
    first, start = tree.find(max(at - AHEAD - 1, 0))
    # Behind the edit, old boundaries are known at segment borders only.
    last, behind = tree.find(at + removed)
    sizes = tree.levels[0][0]
    stop = behind + sizes[last]
    last += 1
    shift = len(added) - removed
    ends: list[int] = []
    place = start
    match = counter.pattern.match
    edge = at + len(added)
    while place < len(new):
        found = match(new, place)
        place = found.end()
        ends.append(place)
        if place < edge:
            continue
        while stop + shift < place and last < len(sizes):
            stop += sizes[last]
            last += 1
        if place == stop + shift:
            break  # the old text has a boundary here too
    else:
        last = len(sizes)
    tree.replace(first, last, *_leaves(counter, new, ends, start, leaf))
    return new


def _counting(shared, p: Params) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in steps(batches):
            names = batch.schema.names
            at = {n: names.index(n) for n in ("text", "edits")}
            rows = []
            for text, edits in zip(batch.column(at["text"]).to_pylist(),
                                   batch.column(at["edits"]).to_pylist(), strict=True):
                now = text or ""
                counter.made = 0
                tree = build(counter, now, p.leaf)
                before, pieces = tree.tokens, counter.made
                counter.made, applied = 0, 0
                for e in edits or ():
                    if e is None:
                        continue
                    now = edit(counter, tree, now, e["at"] or 0, e["removed"] or 0, e["text"] or "", p.leaf)
                    applied += 1
                rows.append((before, tree.tokens, applied, pieces, counter.made,
                             len(tree.levels[0][0]), tree.letters, now))
            cols = [batch.column(i) for i, n in enumerate(names) if n not in at]
            kept = [n for n in names if n not in at]
            kinds = [pa.int64()] * 7 + [pa.string()]
            out = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [*cols, *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))],
                names=[*kept, *COUNTS])

    return count


COUNTS = ["tokens_before", "tokens", "n_edits", "pieces", "pieces_again", "segments", "letters", "edited"]


def counted(docs: DataFrame, keep: list[str], p: Params | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` with token counts before and after their edits.

    ``docs``: text and edits, an array of (at, removed, text) in letters, applied in order.
    Adds tokens_before, tokens, n_edits, pieces (pre-tokens first counted), pieces_again
    (pre-tokens counted again by the edits), segments, letters, and edited, the new text.

    A null text is empty. Null edits are skipped; a place or length outside the text is cut to
    it, a null one is 0, a null text puts in nothing. Names in ``keep`` may not be text, edits
    or an added one. Rows are independent; an empty table gives no rows.
    """
    p = p or Params()
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(load_ranks(p.ranks))  # the size of a vocabulary
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)
    kinds += ", ".join(f"{c} bigint" for c in COUNTS[:-1]) + ", edited string"
    return docs.select(*keep, "text", F.col("edits").cast(EDITS).alias("edits")).mapInArrow(
        _counting(shared, p), kinds)


def derived_edits(doc_id: Column, text: Column) -> Column:
    """Three edits of a text, by a hash of its id: a part repeated elsewhere, a part removed,
    and digits put in the middle of what is there."""
    size = F.greatest(F.coalesce(F.length(text), F.lit(0)), F.lit(1))

    def place(n: int) -> Column:
        return F.pmod(F.xxhash64(doc_id, F.lit(n)), size).cast("int")

    part = F.substring(text, place(1) + 1, F.lit(40))
    return F.array(
        F.struct(place(2).alias("at"), F.lit(0).alias("removed"), part.alias("text")),
        F.struct(place(3).alias("at"), F.lit(25).alias("removed"), F.lit("").alias("text")),
        F.struct(place(4).alias("at"), F.lit(3).alias("removed"),
                 F.concat(F.lit(" "), F.pmod(F.xxhash64(doc_id), F.lit(10_000)).cast("string")).alias("text")),
    )
