"""Weakly supervised toxicity."""

import zlib

import numpy as np

from stockloom.llm import queries, toxicity

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = queries.op9_weak_toxicity(spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    hits = sum(p and t for p, t in held)
    assert hits >= 0.9 * sum(t for _, t in held) > 20
    assert hits >= 0.95 * sum(p for p, _ in held)


def test_label_model_finds_planted_voters():
    rng = np.random.default_rng(3)
    truth = rng.random(40_000) < 0.1
    rates = [(0.8, 0.01), (0.6, 0.02), (0.5, 0.01), (0.7, 0.05)]
    votes = np.stack([np.where(truth, rng.random(len(truth)) < a, rng.random(len(truth)) < b) for a, b in rates])

    def estimate(votes):
        patterns, counts = np.unique(votes.T.astype(float), axis=0, return_counts=True)
        return toxicity.label_model(patterns, counts.astype(float), 0.2, 500)

    toxic, clean, trust, share = estimate(votes)
    assert abs(share - 0.1) < 0.01 and trust.min() > 0.9
    assert np.allclose(toxic, [a for a, _ in rates], atol=0.04)
    assert np.allclose(clean, [b for _, b in rates], atol=0.01)
    # A voter that repeats another is told by the correlation, and both count for less.
    toxic, clean, trust, share = estimate(np.concatenate([votes, votes[:1]]))
    assert abs(share - 0.1) < 0.02
    assert max(trust[0], trust[4]) < 0.8 and trust[1:4].min() > 0.9


def test_edges(spark):
    schema = "doc_id bigint, text string, score int, lowered string"
    rows = [(i, "a calm walk by the river " * 3, 1, "") for i in range(60)]
    rows += [(100 + i, "you are a stupid worthless idiot, pathetic", 1, "") for i in range(20)]
    rows += [(200, None, 1, ""), (201, "", 1, ""), (None, "an idiot", 1, ""), (202, "IDIOT " * 100_000, 1, ""),
             (203, "calm river", 1, ""), (203, "calm river", 1, "")]
    labels = [(i, 1, 0) for i in range(60)] + [(100 + i, 1, 1) for i in range(20)]
    labels += [(None, 1, 1), (5, 1, None), (3, 1, 0), (999, 0, 1)]
    docs = spark.createDataFrame(rows, schema)
    found = toxicity.predict(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    got = found.collect()
    assert len(got) == len(rows)
    assert all(r.predicted == (100 <= r.doc_id < 120) for r in got if r.doc_id is not None and r.doc_id != 202)
    assert next(r.held_out for r in got if r.doc_id is None)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert toxicity.predict(docs, none).filter("doc_id < 60 AND predicted = 1").count() == 0
    assert toxicity.predict(spark.createDataFrame([], schema), none).collect() == []
