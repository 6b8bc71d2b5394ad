"""Quality by Naive Bayes support vectors."""

import zlib

import numpy as np
import pyarrow as pa

from stockloom.llm import quality, queries

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = queries.op11_nb_support_vectors(spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [p for p, t in held if t == 1], [p for p, t in held if t == 0]
    assert sum(good) >= 0.99 * len(good) > 500
    assert sum(bad) <= 0.05 * len(bad) and len(bad) > 50


def test_support_vectors_reach_the_least_loss():
    """Dual coordinate descent against plain gradient steps on the same problem."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 4))
    sign = np.sign(x[:, 0] + 0.5 * x[:, 1] + 0.4 * rng.normal(size=60))
    bound = np.where(sign > 0, 1.0, 0.5)
    rows = [(np.arange(4), v) for v in x]
    found = quality.support_vectors(rows, sign, bound, 4, 2000, 7)
    full = np.hstack([x, np.ones((60, 1))])

    def loss(w):
        return w @ w / 2 + (bound * np.maximum(0, 1 - sign * (full @ w))).sum()

    plain, best = np.zeros(5), np.inf
    for step in range(1, 40_000):
        missed = (sign * (full @ plain) < 1) * bound * sign
        plain = plain - (plain - full.T @ missed) / (step + 10)
        best = min(best, loss(plain))
    assert loss(found) <= best + 1e-3


def test_log_ratios_by_hand():
    feature, owner = np.array([0, 1, 1, 2]), np.array([0, 0, 1, 1])
    got = quality.log_ratios(feature, owner, np.array([True, False]), 3, 1.0)
    assert np.allclose(got, np.log([2 / 5, 2 / 5, 1 / 5]) - np.log([1 / 5, 2 / 5, 2 / 5]))


def test_indicators_of_each_text_are_its_own():
    find = quality.Indicators(18)
    texts = ["a b a b", "A b", None, "", "a b a b", "x" * 300_000]
    feature, first = find(pa.array(texts))
    sets = [feature[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    assert sets[0] == sets[4] and sets[2] == sets[3] == []
    for text, found in zip(texts, sets, strict=True):
        alone, _ = find(pa.array([text], pa.string()))
        assert alone.tolist() == found == sorted(set(found))


def test_edges(spark):
    schema = "doc_id bigint, text string, score int, predicted int, held_out int, _text int"
    rows = [(i, f"a calm walk number {i} by the river. We rest there.", 1, 1, 1, 1) for i in range(80)]
    rows += [(100 + i, f"WIN!! CASH!! NOW!! {i} !!", 1, 1, 1, 1) for i in range(40)]
    rows += [(200, None, 1, 1, 1, 1), (201, "", 1, 1, 1, 1), (None, "a calm walk", 1, 1, 1, 1),
             (202, "WIN!! CASH!! NOW!! 7 !! " * 30_000, 1, 1, 1, 1), (203, "a calm river", 1, 1, 1, 1)]
    rows += [(204, "same", 1, 1, 1, 1)] * 3
    labels = [(i, 1, 0) for i in range(80)] + [(100 + i, 0, 0) for i in range(40)]
    labels += [(None, 1, 1), (5, None, 1), (3, 1, 0), (999, 0, 1), (204, 0, 0), (204, 1, 0)]
    kinds = "doc_id bigint, quality int, toxic int"
    docs = spark.createDataFrame(rows, schema)
    got = quality.predict(docs, spark.createDataFrame(labels, kinds)).collect()
    assert len(got) == len(rows)
    assert all(r.predicted == (r.doc_id < 100) for r in got if r.doc_id is not None and r.doc_id < 200)
    assert next(r.held_out for r in got if r.doc_id is None)
    assert next(r.predicted for r in got if r.doc_id == 202) == 0
    assert len({r.score for r in got if r.doc_id in (200, 201)}) == 1
    assert len({r.score for r in got if r.doc_id == 204}) == 1
    # Labels of one kind, none at all, and no documents.
    one = quality.predict(docs, spark.createDataFrame([(i, 1, 0) for i in range(80)], kinds)).collect()
    assert {r.predicted for r in one} == {1} and len({r.score for r in one}) == 1
    none = spark.createDataFrame([], kinds)
    assert {r.score for r in quality.predict(docs, none).collect()} == {0.5}
    assert quality.predict(spark.createDataFrame([], schema), none).collect() == []
    model = quality.fit(docs, spark.createDataFrame(labels, kinds))
    kept = quality.score(docs, model, ["doc_id", "score", "_text"], "chance")
    assert kept.columns == ["doc_id", "score", "_text", "chance"]
    assert {r.score for r in kept.collect()} == {1}
