"""Edit-aware counts against counting the edited text anew."""

import random

import pytest

from stockloom.llm import token_counts

ALPHABET = list("ab c'st  \n\t12.,é𓀀!re")


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(token_counts.load_ranks())


def applied(text, edits):
    for e in edits or ():
        if e is None:
            continue
        at, removed, added = (e[0] or 0), (e[1] or 0), (e[2] or "")
        at = min(max(at, 0), len(text))
        text = text[:at] + added + text[at + min(max(removed, 0), len(text) - at) :]
    return text


def test_random_edits(counter):
    rnd = random.Random(1)
    for _ in range(600):
        text = "".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 120)))
        leaf = rnd.choice([1, 2, 3, 8])
        tree = token_counts.build(counter, text, leaf)
        for _ in range(rnd.randint(1, 6)):
            e = (rnd.randint(0, len(text) + 3), rnd.choice([0, 0, 1, 3, 30, 200]),
                 "".join(rnd.choice(ALPHABET) for _ in range(rnd.choice([0, 1, 2, 10, 40]))))
            want = applied(text, [e])
            text = token_counts.edit(counter, tree, text, *e, leaf)
            assert text == want
            assert tree.tokens == len(counter.encoding.encode_ordinary(text))
            assert tree.letters == len(text)
            fresh = token_counts.Tree(*tree.levels[0])
            assert [tuple(map(list, x)) for x in fresh.levels] == [tuple(map(list, x)) for x in tree.levels]


def test_a_small_edit_of_a_long_text_counts_little_again(counter):
    text = "some words of a long text, " * 20_000
    tree = token_counts.build(counter, text, 32)
    counter.made = 0
    new = token_counts.edit(counter, tree, text, 300_000, 4, "other", 32)
    assert counter.made < 150
    assert tree.tokens == len(counter.encoding.encode_ordinary(new))


def test_rows(spark, counter):
    rows = [
        (1, None, None, 5), (2, "", [(0, 0, "new text")], 5), (3, "a b c", [None, (1, None, None), (None, 1, "x")], 5),
        (3, "a b c", [(-5, 2, "q"), (99, 99, "r"), (0, 10**6, "")], 5), (None, "x " * 50_000, [(7, 9, "mid")], 5),
        (4, "it's we're  \n\n don't", [(3, 1, "'"), (0, 0, "  ")], 5),
    ]
    schema = f"doc_id bigint, text string, edits {token_counts.EDITS}, tokens int"
    df = spark.createDataFrame(rows, schema)
    got = token_counts.counted(df, ["doc_id"]).collect()
    size = lambda t: len(counter.encoding.encode_ordinary(t))
    want = []
    for i, text, edits, _ in rows:
        after = applied(text or "", edits)
        want.append((i, size(text or ""), size(after), sum(e is not None for e in edits or ()), after))
    assert sorted(((r.doc_id, r.tokens_before, r.tokens, r.n_edits, r.edited) for r in got), key=str) == sorted(
        want, key=str)
    assert token_counts.counted(spark.createDataFrame([], schema), ["doc_id"]).collect() == []


def test_query_counts_whole_documents(spark, counter):
    from stockloom.llm import queries

    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = queries.op5_edit_token_counts(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: r.tokens_before for r in rows} == {
        i: len(counter.encoding.encode_ordinary(t or "")) for i, t in texts.items()}
