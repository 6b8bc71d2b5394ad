"""SentencePiece encoding and decoding with a Viterbi pass over many words at once.

A text is cut at its blanks; every distinct word of a step is encoded once. Words of equal
length form a matrix of code points and advance together, one position at a time. Hashes of
all substrings that end there, from running sums, probe the sorted keys of the pieces; the
best piece is the vectorised maximum over the lengths, and its length is the backpointer.

What is maximised depends on the kind of vocabulary. For a unigram model it is the sum of the
scores. For a byte-pair model it is the score of the last piece among those that the merge
rules allow behind the best path to its start: a sequence is what merging gives exactly when
every two neighbours would not have been merged across their border, and every prefix has one
such sequence. Both give the ids of the SentencePiece library.

Blanks beyond the first before a word, and letters outside the vocabulary (as bytes), are put
in between. Words of more than ``LONG`` letters take the same steps one by one.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import prepare, shared, steps
from stockloom.llm.textwords import powers

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
LONG = 48
NEVER = 1 << 40
_BASE = 0x9E3779B97F4A7C15 | 5
CACHE_BITS = 20
# Words and letters of words that a task keeps.
MEMORY_WORDS, MEMORY_LETTERS = 60_000, 1_000_000


@dataclass
class Vocabulary:
    """The pieces of a model file as plain tables; sent to the tasks once."""

    pieces: list[str]
    scores: np.ndarray
    kind: str  # "bpe" or "unigram"
    unknown: int
    bytes_at: dict[int, int]  # byte -> id
    ids: dict[str, int] = field(default_factory=dict)  # pieces that text may become
    #: Merges as sorted keys (left id, right id) with their order, and for every piece the pieces
    #: down its left and right edge, each with the order of the merge that takes it in.
    merge_key: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    merge_rank: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    left: tuple = ()
    right: tuple = ()
    blanks: dict[tuple[int, int], int] = field(default_factory=dict)  # merges of runs of blanks


def load(path: str = DEFAULT_MODEL, kind: str = "bpe") -> Vocabulary:
    """Read a model file on the driver; its size is that of a vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    scores = np.array([model.get_score(i) for i in range(n)])
    bytes_at = {int(pieces[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
    plain = [i for i in range(n)
             if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    vocabulary = Vocabulary(pieces, scores, kind, model.unk_id(), bytes_at, {pieces[i]: i for i in plain})
    if any(BLANK in p.lstrip(BLANK) or (p.startswith(BLANK * 2) and p.strip(BLANK)) for p in vocabulary.ids):
        raise ValueError("pieces with blanks inside or several in front are not supported")
    if kind == "bpe":
        _merges(vocabulary)
    return vocabulary


def _merges(v: Vocabulary) -> None:
    """Merges in order, and how every piece is put together; pieces that merging never makes go."""
    order = sorted(v.ids.values(), key=lambda i: (-v.scores[i], i))
    rank = {i: r for r, i in enumerate(order)}
    merge: dict[tuple[int, int], int] = {}
    for text, whole in v.ids.items():
        for cut in range(1, len(text)):
            a, b = v.ids.get(text[:cut]), v.ids.get(text[cut:])
            if a is not None and b is not None:
                merge[a, b] = whole
    parts: dict[int, tuple[int, int]] = {}
    letters = dict(v.ids)
    for text, whole in letters.items():
        if len(text) > 1:
            built, last = merged(text, letters, merge, v.scores)
            if built != [whole]:
                del v.ids[text]  # merging never ends here
            else:
                parts[whole] = last
    v.blanks = {pair: whole for pair, whole in merge.items() if not v.pieces[whole].strip(BLANK)}
    found = sorted((a << 24 | b, rank[whole]) for (a, b), whole in merge.items())
    v.merge_key = np.array([k for k, _ in found], np.int64)
    v.merge_rank = np.array([r for _, r in found], np.int64)
    v.left, v.right = (_edges(v, parts, rank, side) for side in (0, 1))


def _edges(v: Vocabulary, parts: dict, rank: dict, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first entry of each id, piece, order of the merge above it) down one side of all pieces."""
    size = np.zeros(len(v.pieces) + 1, np.int64)
    ids, ends = [], []
    for whole in sorted(v.ids.values()):
        at, limit = whole, NEVER
        while True:
            ids.append(at)
            ends.append(limit)
            size[whole + 1] += 1
            if at not in parts:
                break
            limit, at = rank[at], parts[at][side]
    return np.cumsum(size), np.array(ids, np.int64), np.array(ends, np.int64)


def merged(text: str, letters: dict[str, int], merge: dict[tuple[int, int], int], scores: np.ndarray
           ) -> tuple[list[int], tuple[int, int] | None]:
    """Ids of a run of known letters by merging, best score first, then leftmost; and the last merge."""
    ids = [letters[c] for c in text]
    after = list(range(1, len(ids) + 1))
    before = list(range(-1, len(ids) - 1))
    alive = [True] * len(ids)
    queue: list = []

    def offer(a: int) -> None:
        b = after[a]
        if b < len(ids) and (ids[a], ids[b]) in merge:
            heapq.heappush(queue, (-scores[merge[ids[a], ids[b]]], a, b, ids[a], ids[b]))

    for a in range(len(ids) - 1):
        offer(a)
    last = None
    while queue:
        _, a, b, left, right = heapq.heappop(queue)
        if not (alive[a] and b < len(ids) and alive[b] and after[a] == b and ids[a] == left and ids[b] == right):
            continue
        last = (left, right)
        ids[a] = merge[left, right]
        alive[b] = False
        after[a] = after[b]
        if after[a] < len(ids):
            before[after[a]] = a
        offer(a)
        if before[a] >= 0:
            offer(before[a])
    return [i for i, x in zip(ids, alive, strict=True) if x], last


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


class Encoder:
    """Encodes and decodes with one vocabulary; judged pairs are kept in tables of fixed size."""

    def __init__(self, v: Vocabulary):
        self.v = v
        texts = [t for t in v.ids if len(t) == 1 or t.strip(BLANK)]  # runs of blanks: see run()
        self.longest = max(map(len, texts))
        self.up, self.down = powers(_BASE, LONG + 2), powers(pow(_BASE, -1, 1 << 64), LONG + 2)
        keys = np.array([self._key(t) for t in texts], np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array([v.ids[t] for t in texts])[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[keys >> np.uint64(44)] = True
        self.letters = {t for t in texts if len(t) == 1}
        self.known = np.zeros(0x110000, bool)
        self.known[[ord(c) for c in self.letters]] = True
        self.length = np.array([len(p) for p in v.pieces])
        self.runs: dict[int, list[int]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.memory: dict[str, int] = {}
        self.memory_ids, self.memory_first = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.memory_letters = 0
        self.merges = np.zeros(1 << 20, bool)
        self.merges[self._spot(v.merge_key, 20)] = True
        byte_of = {i: b for b, i in v.bytes_at.items()}
        texts = [bytes([byte_of[i]]) if i in byte_of else p.replace(BLANK, " ").encode()
                 for i, p in enumerate(v.pieces)]
        self.out_first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        self.out_data = np.frombuffer(b"".join(texts), np.uint8)
        # A direct-mapped table of judged pairs; a pair may push another out.
        self.seen = np.full(1 << CACHE_BITS, -1, np.int64)
        self.good = np.zeros(1 << CACHE_BITS, bool)

    def _key(self, text: str) -> int:
        total = sum(ord(c) * pow(_BASE, k, 1 << 64) for k, c in enumerate(text))
        return (total * 0xD6E8FEB86659FD93) % (1 << 64)

    def run(self, n: int) -> list[int]:
        """Ids of n blanks in a row."""
        if n not in self.runs:
            if self.v.kind == "bpe":
                self.runs[n] = merged(BLANK * n, {BLANK: self.v.ids[BLANK]}, self.v.blanks, self.v.scores)[0]
            else:
                self.runs[n] = self._one(BLANK * n)
        return self.runs[n]

    def judged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging would leave the border between each two pieces alone.

        It would not if a piece at the right edge of ``a`` and one at the left edge of ``b`` merge
        before both have been taken in by others.
        """
        v = self.v
        (first_a, id_a, end_a), (first_b, id_b, end_b) = v.right, v.left
        high, wide = first_a[a + 1] - first_a[a], first_b[b + 1] - first_b[b]
        size = high * wide
        pair = np.repeat(np.arange(len(a)), size)
        step = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
        i, j = first_a[a][pair] + step // wide[pair], first_b[b][pair] + step % wide[pair]
        key = id_a[i] << 24 | id_b[j]
        row = np.flatnonzero(self.merges[self._spot(key, 20)])
        at = np.searchsorted(v.merge_key, key[row]).clip(max=len(v.merge_key) - 1)
        hit = v.merge_key[at] == key[row]
        row, rank = row[hit], v.merge_rank[at[hit]]
        broken = (rank < end_a[i[row]]) & (rank <= end_b[j[row]])
        out = np.ones(len(a), bool)
        out[pair[row[broken]]] = False
        return out

    @staticmethod
    def _spot(key: np.ndarray, bits: int) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(_BASE)) >> np.uint64(64 - bits)).astype(np.int64)

    def _fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.int64) << 24) | b
        spot = self._spot(key, CACHE_BITS)
        out = self.good[spot]
        new = np.flatnonzero(self.seen[spot] != key)
        if len(new):
            distinct, back = np.unique(key[new], return_inverse=True)
            out[new] = self.judged(distinct >> 24, distinct & 0xFFFFFF)[back]
            self.seen[spot[new]] = key[new]
            self.good[spot[new]] = out[new]
        return out

    def equal_length(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as rows of code points, all letters known.

        Returns the ids one word after the other, and each word's first (n + 1 entries).
        """
        n, size = codes.shape
        sums = np.zeros((n, size + 1), np.uint64)
        np.cumsum(codes.astype(np.uint64) * self.up[:size], axis=1, out=sums[:, 1:])
        last = np.full((n, size + 1), -1, np.int64)
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0
        unigram = self.v.kind != "bpe"
        factor = self.down[:size] * np.uint64(0xD6E8FEB86659FD93)
        for end in range(1, size + 1):
            # All substrings that end here, of all words at once.
            low = max(0, end - self.longest)
            key = (sums[:, end : end + 1] - sums[:, low:end]) * factor[low:end]
            row, start = np.nonzero(self.maybe[key >> np.uint64(44)])
            key = key[row, start]
            at = np.searchsorted(self.keys, key).clip(max=len(self.keys) - 1)
            hit = self.keys[at] == key
            row, start, piece = row[hit], start[hit] + low, self.key_ids[at[hit]]
            if unigram:
                value = best[row, start] + self.v.scores[piece]
            else:
                inner = np.flatnonzero(start > 0)
                allowed = np.ones(len(row), bool)
                allowed[inner] = self._fits(last[row[inner], start[inner]], piece[inner])
                row, piece, start = row[allowed], piece[allowed], start[allowed]
                value = self.v.scores[piece]
            # The maximum per word: ascending by value, the last write stays.
            order = np.lexsort((start, value))
            best[row[order], end] = value[order]
            last[row[order], end] = piece[order]
        ids, count = [], np.zeros(n, np.int64)
        at, rows = np.full(n, size), np.arange(n)
        while len(rows):
            piece = last[rows, at]
            ids.append((rows, piece))
            count[rows] += 1
            at = at - self.length[piece]
            more = at > 0
            rows, at = rows[more], at[more]
        first = np.concatenate([[0], np.cumsum(count)])
        flat = np.zeros(first[-1], np.int64)
        for step, (rows, piece) in enumerate(ids):  # the last piece of a word came first
            flat[first[rows + 1] - 1 - step] = piece
        return flat, first

    def _one(self, text: str) -> list[int]:
        """The same steps for one run of known letters of any length."""
        v, size = self.v, len(text)
        last, best = [-1] * (size + 1), [0.0] * (size + 1)
        for end in range(1, size + 1):
            top = None
            for start in range(max(0, end - self.longest), end):
                piece = v.ids.get(text[start:end])
                if piece is None:
                    continue
                if v.kind != "bpe":
                    value = best[start] + v.scores[piece]
                elif start == 0 or self._pair(last[start], piece):
                    value = v.scores[piece]
                else:
                    continue
                if top is None or value >= top[0]:
                    top = (value, piece)
            best[end], last[end] = top
        out, at = [], size
        while at:
            out.append(last[at])
            at -= int(self.length[last[at]])
        return out[::-1]

    def _pair(self, a: int, b: int) -> bool:
        if len(self.pairs) > 1 << 16:
            self.pairs.clear()
        if (a, b) not in self.pairs:
            self.pairs[a, b] = bool(self.judged(np.array([a]), np.array([b]))[0])
        return self.pairs[a, b]

    def segments(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs of known letters, one after the other, and each run's first (n + 1)."""
        sizes = np.array([len(t) for t in texts], np.int64)
        counts, done = np.zeros(len(texts), np.int64), []
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            group = [texts[i] for i in at]
            if size > LONG:
                parts = [self._one(t) for t in group]
                first = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
                flat = np.array([i for x in parts for i in x], np.int64)
            else:
                flat, first = self.equal_length(_codes(group).reshape(len(at), int(size)))
            counts[at] = np.diff(first)
            done.append((at, flat, first))
        start = np.concatenate([[0], np.cumsum(counts)])
        out = np.zeros(start[-1], np.int64)
        for at, flat, first in done:
            out[np.repeat(start[at] - first[:-1], np.diff(first)) + np.arange(len(flat))] = flat
        return out, start

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, each with one blank in front; and each word's first.

        Letters outside the vocabulary end a run and become their bytes.
        """
        texts = [BLANK + w for w in words]
        if not texts:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]])
        known = np.logical_and.reduceat(self.known[_codes(texts)], starts)
        odd = np.flatnonzero(~known)
        # An odd word stands as None where a run was cut out, and as ids otherwise.
        layout: list[list] = []
        runs: dict[str, int] = {}
        for i in odd:
            parts: list = []
            held: list[str] = []
            for c in texts[i]:
                if c in self.letters:
                    held.append(c)
                    continue
                if held:
                    parts.append(runs.setdefault("".join(held), len(runs)))
                    held = []
                raw = c.encode("utf-8", "surrogatepass")
                parts.append([self.v.bytes_at[b] for b in raw] if self.v.bytes_at else [self.v.unknown])
            if held:
                parts.append(runs.setdefault("".join(held), len(runs)))
            layout.append(parts)
        even = np.flatnonzero(known)
        flat, first = self.segments([*(texts[i] for i in even), *runs])
        n = len(even)
        counts = np.zeros(len(texts), np.int64)
        counts[even] = np.diff(first[: n + 1])
        built = [[i for part in parts for i in (part if isinstance(part, list) else
                                                flat[first[n + part] : first[n + part + 1]].tolist())]
                 for parts in layout]
        counts[odd] = [len(x) for x in built]
        start = np.concatenate([[0], np.cumsum(counts)])
        out = np.zeros(start[-1], np.int64)
        own = counts[even]
        out[np.repeat(start[even] - first[:n], own) + np.arange(first[n])] = flat[: first[n]]
        for i, ids in zip(odd, built, strict=True):
            out[start[i] : start[i + 1]] = ids
        return out, start

    def remembered(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same as ``words``, with those of earlier calls looked up."""
        if len(self.memory) > MEMORY_WORDS or self.memory_letters > MEMORY_LETTERS:
            self.memory_letters = 0
            self.memory, self.memory_ids, self.memory_first = {}, np.zeros(0, np.int32), np.zeros(1, np.int64)
        get = self.memory.get
        new = [w for w in words if w not in self.memory]
        if new:
            ids, first = self.words(new)
            self.memory_letters += sum(map(len, new))
            self.memory.update(zip(new, range(len(self.memory), len(self.memory) + len(new)), strict=True))
            self.memory_first = np.concatenate([self.memory_first, self.memory_first[-1] + first[1:]])
            self.memory_ids = np.concatenate([self.memory_ids, ids.astype(np.int32)])
        at = np.fromiter(map(get, words), np.int64, len(words))
        sizes = self.memory_first[at + 1] - self.memory_first[at]
        start = np.concatenate([[0], np.cumsum(sizes)])
        spots = np.repeat(self.memory_first[at] - start[:-1], sizes) + np.arange(start[-1])
        return self.memory_ids[spots].astype(np.int64), start

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of every text; null and empty texts have none."""
        units = [t.replace(BLANK, " ").split(" ") if t else [] for t in texts]
        counts = [len(u) for u in units]
        number: dict[str, int] = {}
        code = np.fromiter((number.setdefault(w, len(number)) for u in units for w in u),
                           np.int64, sum(counts))
        distinct = list(number)
        ids, first = self.remembered(distinct)
        empty = {i for i, w in enumerate(distinct) if not w}
        blank = self.v.ids[BLANK]
        out, at = [], 0
        size = np.diff(first)
        for n in counts:
            own = code[at : at + n]
            at += n
            if n and not (empty and np.isin(own, list(empty)).any()):
                lengths = size[own]
                stop = np.cumsum(lengths)
                spots = np.repeat(first[own] - (stop - lengths), lengths) + np.arange(stop[-1])
                out.append(ids[spots])
                continue
            tokens: list[int] = []
            blanks = 0
            for c in own:
                if c in empty:
                    blanks += 1
                    continue
                word = ids[first[c] : first[c + 1]].tolist()
                if blanks and word[0] == blank:
                    blanks, word = blanks + 1, word[1:]
                tokens += (self.run(blanks) if blanks else []) + word
                blanks = 0
            out.append(np.array(tokens + (self.run(blanks) if blanks else []), np.int64))
        return out

    def decode_all(self, ids: np.ndarray, first: np.ndarray) -> list[str]:
        """Texts of ids that stand one text after the other, all bytes of a batch at once.

        Bytes that are not UTF-8 become replacement characters.
        """
        size = self.out_first[ids + 1] - self.out_first[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        data = self.out_data[np.arange(int(ends[-1])) + np.repeat(self.out_first[ids] - ends[:-1], size)].tobytes()
        at = ends[first]
        texts = [data[a:b].decode("utf-8", "replace").replace(BLANK, " ")
                 for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        return [t[1:] if t.startswith(" ") else t for t in texts]

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        return self.decode_all(ids, np.array([0, len(ids)]))[0]


def _encoding(sent, check: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(**sent.value))
        for batch in steps(batches):
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            found = encoder.encode(texts)
            sizes = np.array([len(x) for x in found], np.int64)
            flat = np.concatenate([*found, np.zeros(0, np.int64)]).astype(np.int32)
            null = np.array([t is None for t in texts])
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            cols = [batch.column(i) for i in range(batch.num_columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            cols += [pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=pa.array(null))]
            names += ["n_pieces", "pieces"]
            if check:
                back = encoder.decode_all(flat.astype(np.int64), offsets.astype(np.int64))
                same = [t is None or b == t.replace(BLANK, " ") for t, b in zip(texts, back, strict=True)]
                cols.append(pa.array(same))
                names.append("round_trip")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return encode


def _decoding(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(**sent.value))
        for batch in batches:
            at = batch.schema.get_field_index("pieces")
            coded = batch.column(at)
            first = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(coded), 0).to_numpy())])
            texts = encoder.decode_all(pc.list_flatten(coded).to_numpy(zero_copy_only=False).astype(np.int64), first)
            texts = [None if gone else t for gone, t in zip(coded.is_null().to_pylist(), texts, strict=True)]
            cols = [batch.column(i) for i in range(batch.num_columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(texts, pa.string())], names=[*names, "text"])

    return decode


def _kinds(df: DataFrame, keep: list[str]) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.select(*keep).schema)


def encode(docs: DataFrame, keep: list[str], vocabulary: Vocabulary, check: bool = False) -> DataFrame:
    """The columns ``keep`` of ``docs`` with n_pieces and pieces, the ids of ``text``.

    ``check`` adds round_trip: decoding gives the text again (the blank sign reads as a blank).
    A null text has null pieces and 0 of them, an empty one none. Names in ``keep`` may not be
    text, n_pieces, pieces or round_trip. Rows are independent; an empty table gives no rows.
    """
    sent = shared(prepare(docs.sparkSession), vocabulary)
    kinds = f"{_kinds(docs, keep)}n_pieces bigint, pieces array<int>" + ", round_trip boolean" * check
    return docs.select(*keep, "text").mapInArrow(_encoding(sent, check), kinds)


def decode(rows: DataFrame, keep: list[str], vocabulary: Vocabulary) -> DataFrame:
    """The columns ``keep`` of ``rows`` with text, decoded from ``pieces``; null stays null."""
    sent = shared(prepare(rows.sparkSession), vocabulary)
    return rows.select(*keep, "pieces").mapInArrow(_decoding(sent), f"{_kinds(rows, keep)}text string")
