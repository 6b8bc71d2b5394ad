"""Toxicity by weak supervision.

Many voters look at a text: fixed lexicons of insults, and words and word beginnings that
labelled rows show to be toxic. Each says toxic or nothing. A generative model of the votes, with
the label hidden, estimates from the votes on all documents how often each voter fires on toxic
and on clean texts; correlations between voters that one hidden label does not explain lower the
weight of those that repeat each other. Its posterior labels train a linear classifier, which
scores every text.

Votes are counted per pattern (one bit per voter), so the label model reads a table of at most
2 ** voters rows. The word lists and the classifier come from bounded samples of labelled rows,
``word_rows`` and ``train_rows`` texts expected, drawn by a hash of the id. A feature is a word
or a word's beginning, or a mark of it occurring several times or densely: insults that are
inflected differ in their endings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import crc_mod, prepare, shared, steps, text_buffer
from stockloom.llm.textwords import WordHasher, mix

# Common insults, by what they deny a person.
LEXICONS = {
    "wit": "idiot idiots idiotic moron morons moronic stupid dumb imbecile cretin dimwit fool"
           " dunce halfwit brainless",
    "worth": "worthless pathetic loser losers useless failure pitiful nobody hopeless",
    "dirt": "scum trash garbage filth filthy vermin disgusting vile parasite maggot pig rat",
    "mock": "clown clowns joke laughable ridiculous freak creep jerk bastard liar coward",
    "german": "idiot idioten dumm dummkopf trottel versager abschaum dreck widerlich blöd depp",
    "french": "idiot idiote stupide imbécile crétin débile ordure dégoûtant minable nul",
    "spanish": "idiota estúpido imbécil basura asqueroso inútil patético payaso escoria tonto",
}
MOST_ODDS = 4.0  # log odds of all voters together beside a label
GRADES = 5  # of a feature, see graded()
LEARNED = 8  # voters of learned words and word beginnings


@dataclass(frozen=True)
class Params:
    word_rows: int = 3_000  # toxic texts expected for the word lists, and twice as many clean
    train_rows: int = 6_000  # labelled texts expected for the classifier
    least_texts: int = 5  # toxic texts in which a learned word must occur
    least_ratio: float = 20.0  # times as frequent in toxic texts as in clean ones
    most_words: int = 6_000  # learned words and beginnings kept, the strongest first
    most_tried: int = 200_000  # features of toxic texts looked up in clean ones
    beginnings: tuple = (4, 5, 6, 7, 8)  # bytes of word beginnings
    least_strength: float = 12.0  # toxic texts with the word times the log of the ratio
    label_rate: float = 0.995  # how often a label is taken to be right
    rounds: int = 200
    seed: int = 29


@dataclass
class Model:
    fixed: list[np.ndarray]  # word hashes per lexicon
    keys: np.ndarray  # sorted features: learned words and beginnings, graded
    bases: np.ndarray  # the same before grading
    voter: np.ndarray  # the voter of each
    weights: np.ndarray  # per feature, then per voter
    bias: float
    fires_toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))
    fires_clean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    trust: np.ndarray = field(default_factory=lambda: np.zeros(0))  # 1, less for repeated votes
    share: float = 0.0  # of toxic texts, as the label model sees it

    @property
    def voters(self) -> int:
        return len(self.fixed) + LEARNED


#: Bytes of words: ASCII letters and all bytes of longer characters.
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_PREFIX_MARK = 0x5851F42D4C957F2D


class Features:
    """Hashes of words and of word beginnings of several lengths, of many lower-case texts."""

    def __init__(self, p: Params):
        self.words, self.lengths = WordHasher(separator=~_LETTER), p.beginnings

    def __call__(self, column: pa.Array):
        """Hashes, their texts, and the words of each text."""
        data, bounds = text_buffer(column)
        word, start, end, first = self.words(data, bounds)
        owner = np.repeat(np.arange(len(column)), np.diff(first))
        hashes, owners, stems = [word], [owner], []
        begin = np.zeros(len(word), np.uint64)
        at, stem = 0, word
        for length in self.lengths:
            long = np.flatnonzero(end - start > length)
            for k in range(at, length):
                begin[long] = begin[long] << np.uint64(8) | data[start[long] + k].astype(np.uint64)
            if not at:
                stem = word.copy()
                stem[long] = mix(begin[long])
            stems.append(stem[long])
            at = length
            hashes.append(mix(begin[long] ^ np.uint64(_PREFIX_MARK * length % (1 << 64))))
            owners.append(owner[long])
        self.stems = np.concatenate([stem, *stems])
        return np.concatenate(hashes), np.concatenate(owners), np.diff(first)


def graded(hashes: np.ndarray, owner: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of texts: what occurs, and marks of it occurring often or densely."""
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(fresh)
    n = np.diff(np.append(first, len(hashes)))
    hashes, owner = hashes[first], owner[first]
    share = n / np.maximum(words[owner], 1)
    marks = [np.ones(len(n), bool), n >= 2, n >= 3, (n >= 2) & (share >= 0.004), (n >= 2) & (share >= 0.01)]
    found = [(mix(hashes[m] + np.uint64(i)), owner[m]) for i, m in enumerate(marks)]
    return np.concatenate([h for h, _ in found]), np.concatenate([o for _, o in found])


def _hashes(words: str) -> np.ndarray:
    data, bounds = text_buffer(pa.array(words.split()))
    return np.unique(WordHasher(separator=~_LETTER)(data, bounds)[0])


def _lowered(rows: DataFrame, keep: list[str]) -> DataFrame:
    return rows.select(*keep, F.lower(F.coalesce("text", F.lit(""))).alias("lowered"))


def _word_counter(p: Params, only=None) -> Callable:
    """Texts -> features with the texts that hold them; with ``only`` just those, sorted."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(p)
        for batch in steps(batches, "lowered"):
            hashes, _ = graded(*features(batch.column(0)))
            if only is not None:
                hashes = hashes[np.isin(hashes, only.value)]
            keys, n = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["feature", "n"])

    return count


class Matcher:
    """Which features and voters a text has."""

    def __init__(self, model: Model, p: Params):
        self.model, self.features = model, Features(p)
        self.maybe = np.zeros(1 << 20, bool)  # a first look before sorting
        for keys in (model.bases, *model.fixed):
            self.maybe[keys >> np.uint64(44)] = True

    def __call__(self, column: pa.Array):
        """(text, feature) pairs and a matrix of votes."""
        m, n = self.model, len(column)
        hashes, owner, words = self.features(column)
        look = self.maybe[hashes >> np.uint64(44)]
        hashes, owner = hashes[look], owner[look]
        votes = np.zeros((n, m.voters), bool)
        for v, keys in enumerate(m.fixed):
            votes[owner[np.isin(hashes, keys)], v] = True
        hashes, owner = graded(hashes, owner, words)
        if not len(m.keys):
            return owner[:0], owner[:0], votes
        at = np.searchsorted(m.keys, hashes).clip(max=len(m.keys) - 1)
        hit = m.keys[at] == hashes
        text, feature = owner[hit], at[hit]
        votes[text, m.voter[feature]] = True
        return text, feature, votes


def _origins(rows: DataFrame, keys: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """The words and beginnings from which the features ``keys`` come, and each feature's stem.

    A stem is the shortest beginning of a word; what only differs further on shares it.
    """
    sent = rows.sparkSession.sparkContext.broadcast(keys)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(p)
        for batch in steps(batches, "lowered"):
            base, at = np.unique(features(batch.column(0))[0], return_index=True)
            stem = features.stems[at]
            for grade in range(GRADES):
                key = mix(base + np.uint64(grade))
                hit = np.isin(key, sent.value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[hit].view(np.int64)) for x in (key, base, stem)], names=["key", "base", "stem"])

    found = _lowered(rows, []).mapInArrow(find, "key bigint, base bigint, stem bigint").groupBy("key").agg(
        F.min("base").alias("base"), F.min("stem").alias("stem")).collect()  # one row per key
    base, stem = (np.array([r[c] for r in found], np.int64).view(np.uint64) for c in ("base", "stem"))
    order = np.argsort(np.array([r.key for r in found], np.int64).view(np.uint64))
    return np.unique(base), stem[order]


def _voter(sent, p: Params) -> Callable:
    """Texts -> vote patterns with how many texts show each."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(Model(**sent.value), p)
        for batch in steps(batches, "lowered"):
            *_, votes = match(batch.column(0))
            pattern = (votes << np.arange(votes.shape[1])).sum(1)
            kinds, n = np.unique(pattern, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(n)], names=["pattern", "n"])

    return vote


def unexplained(patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Correlations between voters that one hidden label does not explain.

    With votes independent given the label, the covariance of two voters is a product of one
    factor each, and the factor of a voter follows from any two others. The lower median over
    all pairs of others is not moved by the pairs that depend on each other.
    """
    n, total = patterns.shape[1], max(counts.sum(), 1)
    mean = counts @ patterns / total
    cov = (patterns * counts[:, None]).T @ patterns / total - np.outer(mean, mean)
    factor = np.zeros(n)
    for i in range(n):
        others = [k for k in range(n) if k != i]
        found = sorted(cov[i, j] * cov[i, k] / cov[j, k] for a, j in enumerate(others)
                       for k in others[:a] if cov[j, k] > 1e-9 and cov[i, j] > 0 and cov[i, k] > 0)
        if found:
            factor[i] = np.sqrt(found[(len(found) - 1) // 2])
    spread = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    extra = (cov - np.outer(factor, factor)) / np.outer(spread, spread)
    np.fill_diagonal(extra, 0)
    return extra.clip(0, 1)


def label_model(patterns: np.ndarray, counts: np.ndarray, share: float, rounds: int):
    """Rates at which voters fire on toxic and clean texts, their trust, and the toxic share.

    ``patterns``: rows of 0/1 votes; ``counts``: texts with each. A voter's trust falls with the
    correlations to others that the label does not explain; with it, expectation maximisation
    over the hidden label gives the rates.
    """
    n, total = patterns.shape[1], max(counts.sum(), 1)
    trust = 1 / (1 + unexplained(patterns, counts).sum(1))
    toxic, clean = np.full(n, 0.3), np.full(n, 0.005)
    share = min(max(share, 1e-4), 0.5)
    for _ in range(rounds):
        post = posterior(patterns, toxic, clean, trust, share)
        bad, good = counts * post, counts * (1 - post)
        new_toxic = (bad @ patterns + 0.3) / (bad.sum() + 1)
        new_clean = (good @ patterns + 0.005) / (good.sum() + 1)
        # A voter for toxic may not fire more often on clean texts.
        new_toxic = np.maximum(new_toxic, new_clean)
        new_share = min(max(bad.sum() / total, 1e-4), 0.5)
        moved = np.abs(new_toxic - toxic).max(initial=0) + abs(new_share - share)
        toxic, clean, share = new_toxic, new_clean, new_share
        if moved < 1e-9:
            break
    return toxic, clean, trust, share


def posterior(votes: np.ndarray, toxic: np.ndarray, clean: np.ndarray, trust: np.ndarray, share: float,
              label=0.0):
    """The chance of toxic given votes, and ``label``, the log odds of one more voter."""
    toxic, clean = toxic.clip(1e-6, 1 - 1e-6), clean.clip(1e-6, 1 - 1e-6)
    fired, silent = np.log(toxic / clean), np.log((1 - toxic) / (1 - clean))
    odds = np.log(share / (1 - share)) + (votes * (fired * trust) + (1 - votes) * (silent * trust)).sum(1)
    if np.ndim(label):  # what voters say together weighs less than a label, which may be wrong too
        odds = odds.clip(-MOST_ODDS, MOST_ODDS) + label
    return 1 / (1 + np.exp(-odds.clip(-30, 30)))


def _pairs(sent, p: Params) -> Callable:
    """Texts -> their features and vote pattern, for the bounded training sample."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(Model(**sent.value), p)
        for batch in steps(batches, "lowered"):
            text, feature, votes = match(batch.column(1))
            order = np.argsort(text, kind="stable")
            first = np.searchsorted(text[order], np.arange(batch.num_rows + 1))
            pattern = (votes << np.arange(votes.shape[1])).sum(1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pattern), pa.ListArray.from_arrays(
                    pa.array(first.astype(np.int32)), pa.array(feature[order].astype(np.int32))),
                 batch.column(0).cast(pa.int32())],
                names=["pattern", "features", "toxic"])

    return read


def _bits(patterns: np.ndarray, n: int) -> np.ndarray:
    return ((patterns[:, None] >> np.arange(n)) & 1).astype(float)


def fit_linear(text, feature, votes, target, n_features: int, rounds: int = 300):
    """Logistic regression on posterior labels: features and votes, with ridge, by descent."""
    n, v = votes.shape
    weights, bias = np.zeros(n_features + v), float(np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3)))
    square, bias_square = np.full(len(weights), 1e-2), 1e-2
    for _ in range(rounds):
        odds = bias + votes @ weights[n_features:] + np.bincount(text, weights[feature], n)
        wrong = 1 / (1 + np.exp(-odds.clip(-30, 30))) - target
        step = np.concatenate([np.bincount(feature, wrong[text], n_features), votes.T @ wrong]) / n
        step += 1e-5 * weights
        square += step * step
        bias_square += wrong.mean() ** 2
        weights -= 0.5 * step / np.sqrt(square)
        bias -= 0.5 * wrong.mean() / np.sqrt(bias_square)
    return weights, bias


def fit(docs: DataFrame, labels: DataFrame, p: Params | None = None) -> Model:
    """A model from all texts of ``docs`` and the labels (doc_id, toxic) that may be learned.

    Rows of ``labels`` with a null are ignored; a doc_id labelled several times counts as toxic
    when one of its labels says so. Without toxic labels the fixed lexicons alone vote.
    """
    p = p or Params()
    spark = prepare(docs.sparkSession)
    known = labels.select("doc_id", "toxic").dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = (sum(n for t, n in sizes.items() if (t == 1) == want) for want in (True, False))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(p.seed)), F.lit(1 << 30)) / (1 << 30)

    def sample(toxic: int, clean: int) -> DataFrame:
        """Texts with labels, about so many of each kind: bounded, so the ids are broadcast."""
        kept = draw * F.when(F.col("toxic") == 1, bad / max(toxic, 1)).otherwise(good / max(clean, 1)) < 1
        picked = known.filter(kept & (F.col("toxic") == 1 if not clean else F.lit(True)))
        return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")

    def counted(rows: DataFrame, only=None) -> DataFrame:
        return _lowered(rows, []).mapInArrow(_word_counter(p, only), "feature bigint, n bigint").groupBy(
            "feature").agg(F.sum("n").alias("n"))

    chosen = sample(p.word_rows, 2 * p.word_rows)
    seen = {r.toxic: r.n for r in chosen.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_bad, n_good = (sum(n for t, n in seen.items() if (t == 1) == want) for want in (True, False))
    tried = {r.feature: r.n for r in counted(chosen.filter("toxic = 1")).filter(
        F.col("n") >= p.least_texts).orderBy(F.desc("n"), "feature").limit(p.most_tried).collect()}
    only = spark.sparkContext.broadcast(np.sort(np.array(list(tried), np.int64).view(np.uint64)))
    clean = {r.feature: r.n for r in counted(chosen.filter("toxic <> 1"), only).collect()}

    def strength(feature: int) -> float:
        ratio = (tried[feature] + 0.5) / (n_bad + 1) / ((clean.get(feature, 0) + 0.5) / (n_good + 1))
        return tried[feature] * np.log(ratio) if ratio >= p.least_ratio else 0.0

    learned = sorted(((strength(f), f) for f in tried), reverse=True)[: p.most_words]
    keys = np.sort(np.array([f for s, f in learned if s >= p.least_strength], np.int64).view(np.uint64))
    fixed = [_hashes(words) for words in LEXICONS.values()]
    # Features are dealt to voters by stem: those of one word would only repeat each other.
    bases, stems = _origins(chosen.filter("toxic = 1"), keys, p)
    voter = len(fixed) + (mix(stems) % np.uint64(LEARNED)).astype(np.int64)
    model = Model(fixed, keys, bases, voter, np.zeros(len(keys) + len(fixed) + LEARNED), 0.0)

    sent = shared(spark, model)  # bounded by most_words
    votes = _lowered(docs, []).mapInArrow(_voter(sent, p), "pattern bigint, n bigint").groupBy(
        "pattern").agg(F.sum("n").alias("n")).collect()  # at most 2 ** voters rows
    patterns = _bits(np.array([r.pattern for r in votes], np.int64), model.voters)
    share = (bad + 0.5) / (bad + good + 1)
    model.fires_toxic, model.fires_clean, model.trust, model.share = label_model(
        patterns, np.array([r.n for r in votes], float), share, p.rounds)

    # A label that may be learned is one more voter on the texts of the training sample.
    rows = sample(p.train_rows // 3, p.train_rows - p.train_rows // 3)
    train = _lowered(rows, ["toxic"]).mapInArrow(
        _pairs(sent, p), "pattern bigint, features array<int>, toxic int").collect()
    seen = _bits(np.array([r.pattern for r in train], np.int64), model.voters)
    sure = np.log(p.label_rate / (1 - p.label_rate))
    label = np.array([sure if r.toxic == 1 else -sure for r in train])
    target = posterior(seen, model.fires_toxic, model.fires_clean, model.trust, model.share, label)
    if len(train):
        lengths = [len(r.features) for r in train]
        text = np.repeat(np.arange(len(train)), lengths)
        feature = np.array([f for r in train for f in r.features], np.int64)
        model.weights, model.bias = fit_linear(text, feature, seen, target, len(keys))
    else:
        model.weights[:] = 3.0
        model.bias = -1.5
    return model


def _scorer(sent, p: Params) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**sent.value)
        match = Matcher(model, p)
        n = len(model.keys)
        for batch in steps(batches, "lowered"):
            at = batch.schema.get_field_index("lowered")
            text, feature, votes = match(batch.column(at))
            odds = model.bias + votes @ model.weights[n:] + np.bincount(
                text, model.weights[feature], batch.num_rows)
            chance = 1 / (1 + np.exp(-odds.clip(-30, 30)))
            keep = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(chance)],
                names=[*(batch.schema.names[i] for i in keep), "score"])

    return score


def score(docs: DataFrame, model: Model, keep: list[str], p: Params | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` with score (0 to 1) from ``text`` alone.

    A null or empty text is scored as a text without any feature. Rows are independent; an
    empty table gives no rows. Names in ``keep`` may not be score or lowered.
    """
    p = p or Params()
    sent = shared(prepare(docs.sparkSession), model)
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)
    return _lowered(docs, keep).mapInArrow(_scorer(sent, p), f"{kinds}score double")


def train_labels(labels: DataFrame) -> DataFrame:
    """The labels that may be learned: crc32 of the id modulo 5 is not 0."""
    return labels.filter(F.col("doc_id").isNotNull() & (crc_mod("doc_id", 5) != 0))


def predict(docs: DataFrame, labels: DataFrame, p: Params | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    Rows with a null doc_id count as held out.
    """
    model = fit(docs, train_labels(labels), p)
    rows = docs.select("doc_id", "text", (crc_mod("doc_id", 5) == 0).alias("held_out"))
    return score(rows, model, ["doc_id", "held_out"], p).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
