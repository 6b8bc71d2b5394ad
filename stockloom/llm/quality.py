"""Quality from n-gram indicators scaled by Naive Bayes, fitted as support vectors.

A text is the set of its word n-grams (one and two words) and of the n-grams of its word shapes
(one to three: case, length, figures, closing mark, repetition of the words before), hashed to a
fixed number of features. Every indicator is scaled by the log ratio of its smoothed counts in
good and bad texts, the text's vector to length 1, and a linear hinge-loss model is fitted by
dual coordinate descent. A sigmoid fitted on a held part of the sample turns margins to chances.

Labels are learned from a bounded sample: about ``train_rows`` labelled texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import crc_mod, prepare, shared, steps, text_buffer
from stockloom.llm.textwords import WordHasher, mix, windows


@dataclass(frozen=True)
class Params:
    train_rows: int = 8000  # labelled texts expected in the sample
    bits: int = 18  # log2 of the features
    smooth: float = 1.0  # added to every count of the ratios
    cost: float = 4.0  # upper bound of a dual variable of the smaller class
    passes: int = 12
    held: int = 5  # one in so many sample texts fits the sigmoid
    seed: int = 23


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of the scaled indicators, times the scale
    squares: np.ndarray  # squared scale of each indicator
    bias: float
    slope: float
    offset: float


class Indicators:
    """The distinct features of each text of a column."""

    def __init__(self, bits: int):
        self.bits, self.words = bits, WordHasher()

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Features of all texts in order, and each text's first (n + 1 entries)."""
        data, bounds = text_buffer(column)
        hashes, starts, ends, first = self.words(data, bounds)
        n = len(bounds) - 1
        shapes = self._shapes(data, hashes, starts, ends, first)
        parts = []
        for base, widths in ((hashes, (1, 2)), (shapes, (1, 2, 3))):
            for width in widths:
                run, _, at = windows(base, first, width)
                run = mix(run + np.uint64(len(parts) + 1))
                owner = np.repeat(np.arange(n, dtype=np.uint64), np.diff(at))
                parts.append(owner << np.uint64(self.bits) | run >> np.uint64(64 - self.bits))
        both = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
        feature = (both & np.uint64((1 << self.bits) - 1)).astype(np.int32)
        return feature, np.searchsorted(both, np.arange(n + 1, dtype=np.uint64) << np.uint64(self.bits))

    def _shapes(self, data, hashes, starts, ends, first) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.uint64)
        lower = (data >= 97) & (data <= 122)
        upper = (data >= 65) & (data <= 90)
        digit = (data >= 48) & (data <= 57)
        high = data >= 128

        def count(kind):
            sums = np.concatenate([[0], np.cumsum(kind, dtype=np.int64)])
            return sums[ends] - sums[starts]

        low, up, figures, wide = count(lower), count(upper), count(digit), count(high)
        length = ends - starts
        marks = length - low - up - figures - wide
        last = data[ends - 1].astype(np.uint64)
        last[(lower | upper | digit | high)[ends - 1]] = 0
        size = np.minimum(np.log2(length).astype(np.int64), 6)
        code = (np.minimum(low, 1) | np.minimum(up, 2) << 1 | np.minimum(figures, 1) << 3
                | np.minimum(wide, 1) << 4 | np.minimum(marks, 3) << 5 | size << 7)
        code = code.astype(np.uint64) | last << np.uint64(10)
        position = np.arange(len(starts)) - np.repeat(first[:-1], np.diff(first))
        for back in (1, 2):
            same = np.zeros(len(starts), bool)
            same[back:] = hashes[back:] == hashes[:-back]
            code |= (same & (position >= back)).astype(np.uint64) << np.uint64(20 + back)
        return mix(code + np.uint64(1))


def log_ratios(feature: np.ndarray, owner: np.ndarray, good: np.ndarray, n: int, smooth: float) -> np.ndarray:
    """Log of a feature's smoothed share in good texts over that in bad ones, from indicators."""
    up = np.bincount(feature[good[owner]], minlength=n) + smooth
    down = np.bincount(feature[~good[owner]], minlength=n) + smooth
    return np.log(up / up.sum()) - np.log(down / down.sum())


def support_vectors(rows: list[tuple[np.ndarray, np.ndarray]], sign: np.ndarray, bound: np.ndarray, n: int,
                    passes: int, seed: int) -> np.ndarray:
    """Weights (the last is the bias) of the least hinge loss plus half the squared length.

    Dual coordinate descent: one dual variable per row, between 0 and its ``bound``, is set to
    its best value at a time; the weights follow. ``rows``: indices and values.
    """
    weights = np.zeros(n + 1)
    dual = np.zeros(len(rows))
    square = np.array([v @ v + 1.0 for _, v in rows])
    order = np.random.default_rng(seed)
    for _ in range(passes):
        moved = 0.0
        for i in order.permutation(len(rows)):
            at, value = rows[i]
            slope = sign[i] * (weights[at] @ value + weights[n]) - 1
            new = min(max(dual[i] - slope / square[i], 0.0), bound[i])
            step = new - dual[i]
            if step:
                dual[i] = new
                weights[at] += step * sign[i] * value
                weights[n] += step * sign[i]
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights


def sigmoid(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the chance of a good text, by Newton steps on smoothed targets."""
    up, down = int(good.sum()), int((~good).sum())
    target = np.where(good, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack([margin, np.ones(len(margin))], 1)
    at = np.array([1.0, np.log((up + 1) / (down + 1))])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-(x @ at).clip(-30, 30)))
        curve = (x * (chance * (1 - chance))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (target - chance))
        at = at + step.clip(-2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(at[0], 0.0)), float(at[1])


def _featurer(p: Params) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Indicators(p.bits)
        for batch in steps(batches):
            feature, first = find(batch.column(1))
            packed = [feature[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary())], names=["good", "features"])

    return run


def fit(docs: DataFrame, labels: DataFrame, p: Params | None = None) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality).

    A document is good if its label is 1, bad if it is another number; ids with labels of both
    kinds, and labels without an id or a value, are left out. Ids and, where an id stands for
    many texts, texts are drawn by hash; equal rows count once. Without labels of both kinds
    the model knows the share of good ones alone.
    """
    p = p or Params()
    prepare(docs.sparkSession)
    known = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
        .agg(F.min((F.col("quality") == 1).cast("int")).alias("good"),
             F.max((F.col("quality") == 1).cast("int")).alias("_most"))
        .filter("good = _most").select("doc_id", "good")
    )
    total = known.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(p.seed)), F.lit(1 << 30)) / (1 << 30)
    picked = F.broadcast(known.filter(draw * total < p.train_rows))  # bounded by train_rows
    rows = docs.select("doc_id", "text").join(picked, "doc_id")
    size = docs.select("doc_id").join(picked, "doc_id", "left_semi").count()
    if size > 2 * p.train_rows:
        again = F.pmod(F.xxhash64("doc_id", "text", F.lit(p.seed)), F.lit(1 << 30)) / (1 << 30)
        rows = rows.filter(again * size < 2 * p.train_rows)
    found = rows.select("good", "text").mapInArrow(_featurer(p), "good int, features binary").distinct().collect()
    # The order of collected rows differs from run to run; the fit must not.
    found = sorted((r.good, bytes(r.features)) for r in found)
    return _fitted([np.frombuffer(f, np.int32) for _, f in found], np.array([g == 1 for g, _ in found], bool), p)


def _fitted(sets: list[np.ndarray], good: np.ndarray, p: Params) -> Model:
    n = 1 << p.bits
    up, down = int(good.sum()), int((~good).sum())
    if not up or not down:
        return Model(np.zeros(n), np.zeros(n), 0.0, 0.0, float(np.log((up + 1) / (down + 1))))

    def linear(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        feature = np.concatenate([sets[i] for i in chosen])
        owner = np.repeat(np.arange(len(chosen)), [len(sets[i]) for i in chosen])
        scale = log_ratios(feature, owner, good[chosen], n, p.smooth)
        rows = []
        for i in chosen:
            value = scale[sets[i]]
            rows.append((sets[i], value / max(np.sqrt(value @ value), 1e-12)))
        sign = np.where(good[chosen], 1.0, -1.0)
        # Both classes weigh the same, whatever their shares.
        fewer = min((sign > 0).sum(), (sign < 0).sum())
        bound = p.cost * np.where(sign > 0, fewer / max((sign > 0).sum(), 1), fewer / max((sign < 0).sum(), 1))
        return scale, support_vectors(rows, sign, bound, n, p.passes, p.seed)

    def margins(scale: np.ndarray, weights: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        out = []
        for i in chosen:
            value = scale[sets[i]]
            out.append(weights[sets[i]] @ value / max(np.sqrt(value @ value), 1e-12) + weights[n])
        return np.array(out)

    everyone = np.random.default_rng(p.seed).permutation(len(sets))
    held, rest = everyone[:: p.held], np.setdiff1d(everyone, everyone[:: p.held])
    if len(set(good[held])) == 2 == len(set(good[rest])):
        slope, offset = sigmoid(margins(*linear(rest), held), good[held])
    else:
        slope, offset = 2.0, 0.0
    scale, weights = linear(everyone)
    return Model((weights[:n] * scale).astype(np.float32), (scale**2).astype(np.float32),
                 float(weights[n]), slope, offset)


def _scorer(sent, p: Params) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**sent.value)
        find = Indicators(p.bits)
        for batch in steps(batches, "_text"):
            at = batch.schema.get_field_index("_text")
            feature, first = find(batch.column(at))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(first))
            raw = np.bincount(owner, model.weights[feature], batch.num_rows)
            length = np.sqrt(np.bincount(owner, model.squares[feature], batch.num_rows))
            margin = raw / np.maximum(length, 1e-12) + model.bias
            odds = model.slope * margin + model.offset
            chance = 1 / (1 + np.exp(-odds.clip(-30, 30)))
            keep = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(chance)],
                names=[*(f"_k{i}" for i in range(len(keep))), "_score"])

    return run


def score(docs: DataFrame, model: Model, keep: list[str], name: str = "score", p: Params | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` and the chance of a good text, under ``name``.

    Only ``text`` is read for it. Null, empty and blank texts have no indicator and get the
    chance of the bias alone; a text of any length is read whole; equal texts get equal scores.
    Columns of any name may be kept, also one called ``name``, which then appears twice. An
    empty table gives no rows.
    """
    p = p or Params()
    sent = shared(prepare(docs.sparkSession), model)  # two numbers per feature
    chosen = [docs[c].alias(f"_k{i}") for i, c in enumerate(keep)]
    kinds = "".join(f"_k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    rows = docs.select(*chosen, docs["text"].alias("_text"))
    return rows.mapInArrow(_scorer(sent, p), f"{kinds}_score double").toDF(*keep, name)


def train_labels(labels: DataFrame) -> DataFrame:
    """The labels that may be learned: crc32 of the id modulo 5 is not 0."""
    return labels.filter(F.col("doc_id").isNotNull() & (crc_mod("doc_id", 5) != 0))


def predict(docs: DataFrame, labels: DataFrame, p: Params | None = None, least: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    ``predicted`` is 1 from a score of ``least``. Rows with a null doc_id count as held out;
    rows that repeat an id or a text are scored one by one.
    """
    model = fit(docs, train_labels(labels), p)
    rows = docs.select("doc_id", "text", (crc_mod("doc_id", 5) == 0).alias("held_out"))
    return score(rows, model, ["doc_id", "held_out"], p=p).withColumn(
        "predicted", (F.col("score") >= least).cast("int"))
