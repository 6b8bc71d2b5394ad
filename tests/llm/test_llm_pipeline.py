"""The pipeline, stage by stage against plain rules, and on odd tables."""

import pytest

import corpus_pipeline
from stockloom.llm.common import Work, table
from test_llm_near_dup import linked, shingles

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    work, docs = Work(spark, "stages"), table(spark, SF_DIR, "documents")
    frames = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        frames.append(work.keep(stage(spark, frames[-1], SF_DIR), f"s{i}"))
    return frames


def test_stages_keep_the_columns_of_documents(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(f.columns == stages[0].columns for f in stages[:5])
    counts = [f.count() for f in stages]
    assert counts == sorted(counts, reverse=True) and counts[5] == counts[4]


def test_language_keeps_texts_with_a_language(stages):
    assert stages[1].count() == stages[0].filter(r"text RLIKE '\\p{L}'").count()


def test_toxicity_keeps_clean_texts(stages, spark):
    labels = table(spark, SF_DIR, "labels")
    clean = stages[1].join(labels.filter("toxic = 0"), "doc_id", "left_semi")
    assert clean.join(stages[2], "doc_id", "left_anti").count() <= 0.01 * clean.count()
    assert stages[2].count() < stages[1].count()


def test_near_duplicates_by_all_pairs(stages):
    sets = {r.doc_id: shingles(r.text) for r in stages[2].select("doc_id", "text").collect()}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    seen = {}
    for ids in holders.values():
        for k, a in enumerate(ids):
            for b in ids[:k]:
                seen[a, b] = seen.get((a, b), 0) + 1
    pairs = [(a, b) for (a, b), n in seen.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    component = linked(pairs, sets)
    assert {r.doc_id for r in stages[3].select("doc_id").collect()} == {i for i, c in component.items() if i == c}


def test_run_gives_the_last_stage(stages, spark):
    key = lambda df: sorted((r.doc_id, tuple(r.pieces)) for r in df.select("doc_id", "pieces").collect())
    assert key(corpus_pipeline.run(spark, SF_DIR)) == key(stages[5])


def test_odd_rows_and_empty_tables(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score int, hash string"
    rows = [(None, None, None, None, None, None, None), (1, "", "en", "s", 0, 1, ""),
            (2, "the cat sat on the mat with a dog", "en", "s", 1, 1, "x"),
            (2, "the cat sat on the mat with a dog", "en", "s", 1, 1, "x"),
            (3, "long text here " * 50_000, None, None, None, 2, "y")]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = Work(spark, "odd").keep(stage(spark, docs, "/root/testdata/sf0.001"), f"s{i}")
            if i < 4:
                assert docs.columns == schema.replace("bigint", "").replace("string", "").replace(
                    "int", "").replace(" ", "").split(",")
        # The long text is in no language that these rows teach, and is dropped.
        assert [r.doc_id for r in docs.collect()] == ([2] if data else [])
