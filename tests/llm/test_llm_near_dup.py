"""MinHash near-dedup against all pairs of full sets."""

import random

import numpy as np
import pyarrow as pa

from stockloom.llm import near_dup
from stockloom.llm.components import components
from stockloom.llm.textwords import WordHasher


def shingles(text):
    words = bytes(text or "", "utf-8").lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def linked(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    ids = {i for i, _ in docs if i is not None}
    pairs = [
        (a, b)
        for k, (a, x) in enumerate(sets) for b, y in sets[:k]
        if a is not None and b is not None and a != b and x and y
        and 100 * len(x & y) >= 75 * len(x | y)
    ]
    component = linked(pairs, ids)
    return sorted(
        ((i, len(s), component.get(i), i is None or component[i] == i) for i, s in sets),
        key=str)


def check(spark, docs, schema="doc_id bigint, text string"):
    df = spark.createDataFrame(docs, schema)
    got = near_dup.near_duplicates(df).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([(d[0], d[1]) for d in docs])


def varied(rnd, words, n):
    out = list(words)
    for _ in range(n):
        out[rnd.randrange(len(out))] = f"x{rnd.randrange(10**6)}"
    return " ".join(out)


def test_against_all_pairs(spark):
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for base in range(6):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([30, 80, 200]))]
        for _ in range(12):  # from exact copies to texts below the threshold
            docs.append((rnd.randrange(10**9), varied(rnd, words, rnd.choice([0, 0, 1, 2, 3, 5]))))
    passage = " ".join(rnd.choice(vocabulary) for _ in range(60))
    docs += [(2 * 10**9 + k, passage + " " + " ".join(rnd.choice(vocabulary) for _ in range(60)))
             for k in range(30)]
    check(spark, docs)


def test_edges(spark):
    check(spark, [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two three four"),
        (7, "one two\x0bthree\x0cfour"), (8, "Éa b c d e f"), (9, "éa b c d e f"), (None, "one"),
        (None, None), (10, "a b c d e f g h"), (10, "a b c d e f g h"), (11, "a b c d e f g h"),
        (12, "z " * 200_000), (13, "z z z z z"),
    ])


def test_rows_that_repeat_an_id_with_other_texts_join_both_groups(spark):
    check(spark, [(1, "a b c d e f g"), (3, "a b c d e f g"), (3, "p q r s t u v"), (2, "p q r s t u v")])


def test_clashing_columns_and_empty_table(spark):
    schema = "doc_id bigint, text string, kept string, component_id int, bands int, `a b` int"
    check(spark, [(5, "a b c d e", "x", 1, 2, 3), (4, "a b c d e", "y", 1, 2, 3)], schema)
    check(spark, [], schema)


def test_large_group_of_copies_and_near_copies(spark):
    rnd = random.Random(5)
    words = [f"w{rnd.randrange(500)}" for _ in range(120)]
    docs = [(i, " ".join(words)) for i in range(300)]
    docs += [(1000 + i, varied(rnd, words, rnd.randrange(1, 9))) for i in range(150)]
    check(spark, docs)


def test_sketch_bound_keeps_pairs_at_the_threshold(spark):
    p = near_dup.Params()
    rng = np.random.default_rng(1)
    rows = []
    for size in (8, 20, 60, 200, 900, 4000, 20_000):
        for _ in range(60):
            union = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            shared = -(-size * 3 // 4)
            half = (size - shared) // 2
            a, b = union[: shared + half], np.concatenate([union[:shared], union[shared + half :]])
            owner = np.repeat([0, 1], [len(a), len(b)])
            bits, used = near_dup.odd_sketches(np.concatenate([a, b]), owner, 2, p)
            bits = bits.view(np.uint64).reshape(2, -1)
            rows.append((int(np.bitwise_count(bits[0] ^ bits[1]).sum()), len(a) + len(b), int(used.sum())))
    df = spark.createDataFrame(rows, "differ int, size int, used int")
    from pyspark.sql import functions as F

    assert df.filter(F.col("differ") > near_dup.most_bits(F.col("size"), F.col("used"), p)).count() == 0


def test_words_over_block_borders():
    texts = ["Hello World", "", None, "x" * 2_500_000 + " y " + "w" * 1_100_000, "HELLO\tworld"]
    words = WordHasher()
    column = pa.array(texts)
    data, bounds = near_dup.text_buffer(column)
    hashes, starts, ends, first = words(data, bounds)
    assert [bytes(data[s:e]) for s, e in zip(starts, ends, strict=True)] == [
        w for t in texts for w in (t or "").encode().split()]
    assert np.diff(first).tolist() == [2, 0, 0, 3, 2]
    assert hashes[0] == hashes[-2] and hashes[1] == hashes[-1]


def test_components(spark, frame):
    rnd = random.Random(2)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)]
    edges += [(100 + i, 101 + i) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 300)]
    edges += [(5, 5), (7, None)]
    got = {tuple(r) for r in components(frame("a bigint, b bigint", *edges)).collect()}
    real = [(a, b) for a, b in edges if b is not None and a != b]
    nodes = {n for e in real for n in e}
    assert got == set(linked(real, nodes).items())
    assert components(frame("a bigint, b bigint")).collect() == []


def test_one_of_each_group_stays(spark):
    rows = [(1, "a b c d e f", "x"), (2, "a b c d e f", "y"), (3, "q r s t u", None),
            (3, "q r s t u", None), (None, "a b c d e f", "z"), (4, None, "n")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kept string")
    got = near_dup.deduplicated(df)
    assert got.columns == df.columns
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [rows[0], rows[2], rows[4], rows[5]], key=str)


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    rows = [(3, "q r s t u v", "a"), (3, "other words of another clean text", "b"), (5, "q r s t u v", "c"),
            (3, "q r s t u v", "d"), (7, None, "e"), (7, "yet another text of some six words", "f"),
            (2, "Yet another text of some six words", "g")]
    for part in (1, 3):
        df = spark.createDataFrame(rows, "doc_id bigint, text string, _key string").repartition(part)
        got = sorted((tuple(r) for r in near_dup.deduplicated(df).collect()), key=str)
        assert [r for r in got if r[0] != 3] == [rows[6], rows[4]]
        assert rows[1] in got and len([r for r in got if r[0] == 3]) == 2
        if part == 1:
            first = got
    assert got == first


def test_pairs_short_of_the_threshold_are_sifted_and_links_are_not(spark):
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(104)]
    docs = [(0, " ".join(base))]
    for i in range(1, 60):  # similarities on both sides of the threshold
        docs.append((i, varied(rnd, base, rnd.randrange(1, 6))))
    p = near_dup.Params()
    signed = near_dup.signatures(spark.createDataFrame(docs, "doc_id bigint, text string"), p)
    signed = spark.createDataFrame(signed.collect(), signed.schema)
    both = near_dup._sketched(signed, "a").join(near_dup._sketched(signed, "b")).filter("a < b")
    kept = {(r.a, r.b) for r in both.filter(near_dup._alike(p)).select("a", "b").collect()}
    sets = [shingles(t) for _, t in docs]
    near = {(a, b) for b in range(60) for a in range(b) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    below = {(a, b) for b in range(60) for a in range(b)
             if 70 * len(sets[a] | sets[b]) <= 100 * len(sets[a] & sets[b]) < 74 * len(sets[a] | sets[b])}
    assert near and near <= kept
    assert len(below) > 20 and len(below & kept) * 4 < len(below)


def test_sets_of_sizes_too_far_apart_are_no_candidates(spark):
    """Their sketches need not be looked at: 74 of 100 shingles cannot reach 75 %."""
    same = [1] * 64
    rows = spark.createDataFrame(
        [(1, same, 100, 100, same, 74, 74), (2, same, 100, 100, same, 75, 75), (3, same, 100, 100, [-2] * 64, 100, 100)],
        "i int, sa array<bigint>, na bigint, ua bigint, sb array<bigint>, nb bigint, ub bigint")
    kept = rows.filter(near_dup._alike(near_dup.Params()))
    assert [r.i for r in kept.collect()] == [2]


def test_few_rows_are_kept_in_few_files(spark, files_kept):
    rnd = random.Random(11)
    rows = []
    for i in range(0, 120, 4):
        words = [f"w{rnd.randrange(5000)}" for _ in range(60)]
        rows += [(i + k, varied(rnd, words, k)) for k in range(4)]
    kept = files_kept(lambda: check(spark, rows))
    assert len(kept) > 15 and max(kept) <= 2 * spark.sparkContext.defaultParallelism
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = files_kept(lambda: near_dup.deduplicated(docs).collect())
    assert len(kept) > 15 and max(kept) <= 2 * spark.sparkContext.defaultParallelism


def test_components_of_few_edges_are_kept_in_few_files(spark, frame, files_kept):
    edges = frame("a bigint, b bigint", *[(i, i + 1) for i in range(40)], (99, 98), (98, 99), (7, 7), (None, 3))
    found = []
    kept = files_kept(lambda: found.extend(components(edges, 44).collect()))
    assert max(kept) <= 2 * spark.sparkContext.defaultParallelism
    assert {r.node: r.component for r in found} == {**dict.fromkeys(range(41), 0), 98: 98, 99: 98}
    assert len(found) == 43 and components(edges.filter("a = b"), 1).collect() == []
