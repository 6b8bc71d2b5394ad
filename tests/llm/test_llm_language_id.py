"""Language identification on rows that were not learned."""

import zlib

import numpy as np

from stockloom.llm import language_id, queries

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_rows(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op6_language_bitmasks(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.99 * len(held) > 100
    assert all(0 <= r.score <= 1 for r in rows)


SCHEMA = "doc_id bigint, text string, lang string, score int, padded string"


def test_edges(spark):
    rows = [(i, "the cat and the dog " * 5, "en", 1, "") for i in range(40)]
    rows += [(100 + i, "der hund und die katze " * 5, "de", 1, "") for i in range(30)]
    rows += [(200, None, "en", 1, ""), (201, "", None, 1, ""), (202, "12 34 !?", None, 1, ""),
             (203, "a", None, 1, ""), (None, "und die katze", None, 1, ""), (204, "THE DOG", None, 1, ""),
             (205, "the cat " * 100_000, None, 1, ""), (205, "the cat", None, 1, "")]
    got = language_id.predict(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    pred = {(r.doc_id, r.lang_pred) for r in got if r.doc_id is None or r.doc_id >= 200}
    assert pred == {(200, "und"), (201, "und"), (202, "und"), (203, "en"), (None, "de"), (204, "en"), (205, "en")}
    assert all(r.score == 0 for r in got if r.lang_pred == "und" or r.doc_id == 203)
    assert language_id.predict(spark.createDataFrame([], SCHEMA)).collect() == []
    nothing = language_id.predict(spark.createDataFrame([(1, "words", None, 1, "")], SCHEMA)).first()
    assert (nothing.lang_pred, nothing.score) == ("und", 0.0)


def test_more_languages_than_bits_of_a_word(spark):
    rng = np.random.default_rng(2)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    words = {f"l{n:02}": ["".join(rng.choice(letters, 6)) for _ in range(30)] for n in range(70)}
    rows = [(i, " ".join(rng.choice(w, 20)), lang, 1, "")
            for i, (lang, w) in enumerate((x, y) for x, y in words.items() for _ in range(6))]
    got = language_id.predict(spark.createDataFrame(rows, SCHEMA)).collect()
    truth = {r[0]: r[2] for r in rows}
    learned = {truth[r.doc_id] for r in got if not r.held_out}
    assert all(r.lang_pred == truth[r.doc_id] for r in got if truth[r.doc_id] in learned)


def test_rows_without_ids_are_drawn_one_by_one(spark):
    """A language whose rows lack ids, repeat one id, or are copies is learned in part."""
    words = {"xa": "sollen wohnen garten fenster", "xb": "piatto cucina finestra giardino"}
    rows = [(None if lang == "xa" else 1001, f"{text} {chr(97 + i % 26)}{chr(97 + i // 26)}qz", lang)
            for lang, text in words.items() for i in range(400)]
    rows += [(None, "copias siempre iguales aqui", "xc")] * 400
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    asked = spark.createDataFrame(
        [(1, "sollen wohnen"), (2, "piatto cucina"), (3, "copias siempre")], "doc_id bigint, text string")
    for seed in range(4):
        p = language_id.Params(sample_rows=20, seed=seed)
        model = language_id.fit(df, p)
        got = {r.doc_id: r.lang_pred for r in language_id.predict(
            df.unionByName(asked, allowMissingColumns=True), p).filter("doc_id < 4").collect()}
        assert got == {1: "xa", 2: "xb", 3: "xc"}, seed
        bits = [int((model.filters[0] >> np.uint64(c) & np.uint64(1)).sum()) for c in range(3)]
        assert min(bits) > 0
