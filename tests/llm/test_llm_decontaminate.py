"""Benchmark decontamination."""

import random

from stockloom.llm import decontaminate, queries

ITEM = ("A train leaves the old station with 120 passengers and Maria counts 45 km before"
        " the next town where 120 people meet Maria again.")
BENCH = [(1, ITEM), (2, "too short"), (3, None), (4, "Name five rivers quickly"), (5, "")]
OTHER = "words that have nothing to do with any question at all and go on for a while"


def found(spark, docs, bench=BENCH, schema="doc_id bigint, text string"):
    df = spark.createDataFrame(docs, schema)
    got = decontaminate.contaminated(df, spark.createDataFrame(bench, "item_id bigint, text string"))
    return got


def kinds(df):
    return {(r.doc_id, r.item_id): r.kind for r in df.collect()}


def test_templates_and_slots(spark):
    docs = [
        (1, f"{OTHER}. {ITEM} {OTHER}"),
        (2, f"{OTHER}. " + ITEM.replace("120", "77").replace("Maria", "Peter").replace("45 km", "3.5 miles")),
        (3, ITEM.replace("120 people", "99 people").replace("120 pass", "77 pass")),  # 120 became two values
        (4, OTHER), (5, None), (6, ""), (7, "we name five rivers, quickly."), (8, "five rivers quickly"),
        (9, ITEM.upper()), (10, " ".join(ITEM.split()[:9])), (11, "too short"),
        (12, "9 " * 100_000 + ITEM), (None, ITEM),
    ]
    got = kinds(found(spark, docs))
    assert got[1, 1] == got[12, 1] == got[None, 1] == "verbatim"
    assert got[2, 1] == "reparameterised"
    assert got[7, 4] in ("verbatim", "reparameterised")
    assert not {d for d, _ in got} & {4, 5, 6, 8, 10, 11}
    assert (3, 1) not in got or found(spark, docs).filter("doc_id = 3").first().coverage < 0.6


def test_edges_and_clashing_columns(spark):
    schema = "doc_id bigint, text string, item_id int, hash string, kind string, key int"
    docs = [(1, ITEM, 1, "", "", 2), (1, ITEM, 1, "", "", 2), (1, OTHER, 1, "", "", 2)]
    got = found(spark, docs, schema=schema)
    assert got.count() == 1
    df = spark.createDataFrame([*docs, (None, OTHER, 3, "", "", 4), (None, ITEM, 3, "", "", 4)], schema)
    clean = decontaminate.cleaned(df, spark.createDataFrame(BENCH, "item_id bigint, text string"))
    assert clean.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in clean.collect() if r.doc_id) == [(1, OTHER)]
    assert clean.filter("doc_id IS NULL").count() == 1
    assert found(spark, [], schema=schema).collect() == []
    assert found(spark, docs, bench=[], schema=schema).collect() == []


def test_cleaned_keeps_columns_of_any_name(spark):
    names = "doc_id bigint, text string, _found_id int, found_id int, found_key int, own_id int, own_key int, _c0 int"
    docs = spark.createDataFrame([(1, ITEM, 1, 2, 3, 4, 5, 6), (2, OTHER, 1, 2, 3, 4, 5, 6), (3, None, *[None] * 6)], names)
    clean = decontaminate.cleaned(docs, spark.createDataFrame(BENCH, "item_id bigint, text string"))
    assert clean.columns == docs.columns
    assert sorted(tuple(r) for r in clean.collect()) == [(2, OTHER, 1, 2, 3, 4, 5, 6), (3, None, *[None] * 6)]


def test_without_the_hashes_in_the_tasks(spark):
    docs = spark.createDataFrame([(1, f"{OTHER} {ITEM}"), (2, OTHER)], "doc_id bigint, text string")
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    for p in (decontaminate.Params(), decontaminate.Params(task_windows=0)):
        assert kinds(decontaminate.contaminated(docs, bench, p)) == {(1, 1): "verbatim"}


def test_planted_passages_are_found_and_no_others(spark):
    sf_dir = "/root/testdata/sf0.01"
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()

    def words(text):
        return [w.strip(".,!?%$&*#").lower() for w in (text or "").split()]

    def runs(text, n):
        w = words(text)
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    items = {b.item_id: runs(b.text, 13) for b in bench}
    loose = {b.item_id: runs(b.text, 8) for b in bench}
    got = kinds(queries.op7_template_decontamination(spark, sf_dir))
    for d in docs:
        long, short = runs(d.text, 13), runs(d.text, 8)
        for i, item in items.items():
            if len(long & item) >= 4:
                assert (d.doc_id, i) in got
            if not short & loose[i]:
                assert (d.doc_id, i) not in got


def test_random_numbers_are_not_templates(spark):
    rnd = random.Random(1)
    docs = [(i, " ".join(str(rnd.randrange(10**6)) for _ in range(200))) for i in range(20)]
    bench = [(1, " ".join(str(rnd.randrange(10**6)) for _ in range(30)))]
    assert found(spark, docs, bench).collect() == []


def test_copies_of_items_of_few_literals(spark):
    items = ["What is 37 * 45 + 12?", "Calculate 12 * 7 + 45 / 9 - 3 * 8",
             "3 1 4 1 5 9 2 6 5 3 5 8 9 7 9 3 2 3 8 4", "add 17 cm 23 cm 29 cm 31 cm 37 cm 41 cm"]
    docs = [(i, f"{OTHER}, {x} {OTHER}") for i, x in enumerate(items)]
    docs += [(10 + i, f"{OTHER}, {x.replace('3', '6')} {OTHER}") for i, x in enumerate(items)]
    for p in (decontaminate.Params(), decontaminate.Params(task_windows=0)):
        got = decontaminate.contaminated(
            spark.createDataFrame(docs, "doc_id bigint, text string"),
            spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string"), p)
        assert kinds(got) == {(i, i): "verbatim" for i in range(len(items))}


def test_typing_does_not_depend_on_the_context(spark):
    items = ["Name five rivers quickly", "Where does Maria live now?",
             "Describe how plants turn sunlight into sugar",
             "Which planet is the largest in our solar system?",
             "Tom has 5 apples and Jane has 3 pears in total",
             "Calculate the mean weight of all parcels that Maria sent on Monday morning"]
    docs = []
    for i, x in enumerate(items):
        w = x.split()
        wrapped = "\n".join(" ".join(w[k : k + 3]) for k in range(0, len(w), 3))
        docs += [(i, f"{OTHER} {y} {OTHER}") for y in (
            f"({x})", x, f", {x.lower()}", f". {wrapped}", f'"{x.upper()}"', f"7. {x}", f"12 {x}")]
    df = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(docs)], "doc_id bigint, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    for p in (decontaminate.Params(), decontaminate.Params(task_windows=0)):
        assert kinds(decontaminate.contaminated(df, bench, p)) == {
            (k, i): "verbatim" for k, (i, _) in enumerate(docs)}


def test_names_that_open_sentences_are_replaced(spark):
    bench = [(1, "Tom has 5 apples. Jane has 3 pears. How many pieces of fruit do they have?"),
             (2, "What is the capital city")]
    docs = [(1, f"{OTHER}. Bob has 7 apples. Mary has 4 pears. How many pieces of fruit do they have?"),
            (2, f"{OTHER}, so Bob has 7 apples, Mary has 4 pears, how many pieces of fruit do they have?"),
            (3, f"{OTHER}. Paris is the capital city, and Bob has 7 apples.")]
    assert kinds(found(spark, docs, bench)) == {(1, 1): "reparameterised", (2, 1): "reparameterised"}


def test_slots_that_disagree_cost_only_their_windows(spark):
    two = ("A farmer takes 2 apples and 2 pears to the market on the far side of the old river and"
           " sells them all there before noon")
    short = "The farmer sells 2 apples and 2 pears there"
    many = [f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(44)]
    long = " ".join([*many[:20], "40 tiles", *many[20:], "40 stones lie here"])
    docs = [(1, two.replace("2 app", "3 app").replace("2 pears", "5 pears")),
            (2, short.replace("2 app", "3 app").replace("2 pears", "5 pears")),
            (3, long.replace("40 stones", "41 stones")),
            (4, "the farmer sells 3 apples and 5 pears somewhere"), (5, two)]
    got = found(spark, docs, [(1, two), (2, short), (3, long)])
    assert kinds(got) == {(1, 1): "reparameterised", (2, 2): "reparameterised",
                          (3, 3): "reparameterised", (5, 1): "verbatim"}
    windows = {r.doc_id: (r.windows, r.item_windows) for r in got.collect()}
    assert windows[5] == (19, 19) and windows[2][0] == 0
    assert windows[1] == (12, 19)  # those with a pair of 2 do not count
    assert windows[3] == (43 - 4, 43)  # those with the edited 40 do not count


def test_values_of_more_or_fewer_words(spark):
    maria = ("on a cold winter evening the old teacher told Maria about every one of the small"
             " islands beyond the blue bay")
    york = ("after the long war the young painter moved to New York because his only sister had"
            " opened a small gallery there")
    docs = [(1, f"{OTHER} {maria.replace('Maria', 'Ana Maria')}"),
            (2, f"{OTHER} {maria.replace('Maria', 'Jean Paul Sartre')}"),
            (3, f"{OTHER} {york.replace('New York', 'Paris')}"), (4, " ".join(york.split()[11:])),
            (5, f"{' '.join(york.split()[:9])} {OTHER} {' '.join(york.split()[11:])}")]
    got = kinds(found(spark, docs, [(1, maria), (2, york)]))
    assert {(1, 1), (2, 1), (3, 2)} == set(got)
