"""SentencePiece coding against the library, and exact round trips."""

import random

import numpy as np
import pytest
import sentencepiece

from stockloom.llm import pieces

HARD = [
    "", " ", "  ", "   a  b   ", "Hello  wörld\n x ▁y 你好𓀀 ", "a" * 300, "ﬁ Ａ ½", "\x00 a\x00b",
    "    " * 9 + "x", " the the", "1234567890 3.14", "x" * 100 + "𓀀" + "y" * 60, "\t\r\n\n   z",
    "of of  of", "é" * 70, " " * 1000 + "end", "▁", "▁▁ ▁",
]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)


def test_hard_texts(vocabulary, library):
    encoder = pieces.Encoder(vocabulary)
    for text in HARD:
        ids = encoder.encode([text])[0].tolist()
        assert ids == library.encode(text), text
        assert encoder.decode(ids) == library.decode(ids)
        assert encoder.decode(ids) == text.replace(pieces.BLANK, " ")
    together = encoder.encode(HARD)
    assert [x.tolist() for x in together] == [library.encode(t) for t in HARD]


def test_random_texts(vocabulary, library):
    rnd = random.Random(8)
    letters = list("aetoinshr dlu\n.,'éñ▁你  ")
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(400))) for _ in range(300)]
    got = pieces.Encoder(vocabulary).encode(texts)
    assert [x.tolist() for x in got] == [library.encode(t) for t in texts]


def test_documents(spark, vocabulary, library):
    from stockloom.llm import queries

    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op8_sentencepiece(spark, sf_dir).collect()
    assert all(r.round_trip and r.n_pieces == len(r.pieces) for r in rows)
    assert {r.doc_id: r.pieces for r in rows} == {i: library.encode(t) for i, t in texts.items()}


def best_sum(vocabulary, text):
    """The greatest sum of scores over all ways to cut a text, by plain recursion over ends."""
    best = [0.0] + [-np.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            if text[start:end] in vocabulary.ids:
                best[end] = max(best[end], best[start] + vocabulary.scores[vocabulary.ids[text[start:end]]])
    return best[-1]


def test_unigram_scores(vocabulary):
    rng = np.random.default_rng(1)
    unigram = pieces.load(kind="unigram")
    unigram.scores = -rng.uniform(1, 15, len(unigram.scores))
    encoder = pieces.Encoder(unigram)
    words = ["the", "station", "wörter", "x" * 60, "unbelievable", "an"]
    flat, first = encoder.words(words)
    for word, lo, hi in zip(words, first[:-1], first[1:], strict=True):
        ids = flat[lo:hi].tolist()
        assert "".join(unigram.pieces[i] for i in ids) == pieces.BLANK + word
        assert np.isclose(unigram.scores[ids].sum(), best_sum(unigram, pieces.BLANK + word))


def test_rows(spark, vocabulary, library):
    rows = [(1, None, 1), (2, "", 1), (2, "ab c", 1), (None, "ab c", 1), (3, "long " * 100_000, 1)]
    schema = "doc_id bigint, text string, `Ids` int"
    df = spark.createDataFrame(rows, schema)
    coded = pieces.encode(df, ["doc_id", "Ids"], vocabulary, check=True)
    got = sorted(coded.collect(), key=str)
    assert sorted(((r.doc_id, r.pieces, r.n_pieces, r.round_trip) for r in got), key=str) == sorted(
        ((i, None if t is None else library.encode(t), len(library.encode(t or "")), True)
         for i, t, _ in rows), key=str)
    texts = pieces.decode(coded, ["doc_id"], vocabulary)
    assert sorted((tuple(r) for r in texts.collect()), key=str) == sorted((r[:2] for r in rows), key=str)
    assert pieces.encode(spark.createDataFrame([], schema), ["doc_id"], vocabulary).collect() == []
