"""The subspace join of vectors against all pairs."""

import numpy as np

from stockloom.llm import embed_dup
from test_llm_near_dup import linked

NAN, INF = float("nan"), float("inf")


def brute(rows, cosine):
    usable = [(i, np.array(e, float)) for i, e in rows
              if i is not None and e is not None and all(x is not None for x in e)
              and np.isfinite(np.array(e, float)).all() and np.any(np.array(e, float))]
    usable = [(i, e / np.linalg.norm(e)) for i, e in usable]
    pairs, links = [], {}
    for k, (a, x) in enumerate(usable):
        for m, (b, y) in enumerate(usable):
            if k != m and len(x) == len(y) and x @ y >= cosine:
                pairs.append((a, b))
                links[k] = links.get(k, 0) + 1
    component = linked([p for p in pairs if p[0] != p[1]], {i for i, _ in rows if i is not None})
    at = iter(range(len(usable)))
    out = []
    ids = [i for i, _ in usable]
    for i, e in rows:
        ok = i is not None and e is not None and all(x is not None for x in e) and np.isfinite(
            np.array(e, float)).all() and bool(np.any(np.array(e, float)))
        n = links.get(next(at), 0) if ok else 0
        out.append((i, n, component.get(i), i is None or component[i] == i))
    assert len(ids) == len(usable)
    return sorted(out, key=str)


def check(spark, rows, p=embed_dup.Params(), schema="vec_id bigint, embedding array<float>"):
    df = spark.createDataFrame(rows, schema)
    got = embed_dup.near_duplicate_vectors(df, p).select("vec_id", "n_links", "component_id", "kept")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([r[:2] for r in rows], p.cosine)


def clusters(rng, dim, centres, near, alone, noise):
    rows = []
    for _ in range(centres):
        centre = rng.standard_normal(dim)
        for _ in range(near):
            rows.append(centre + noise * rng.standard_normal(dim))
    rows += list(rng.standard_normal((alone, dim)))
    return [[float(np.float32(x)) for x in v] for v in rows]


def test_against_all_pairs_with_small_chunks(spark):
    rng = np.random.default_rng(4)
    vecs = clusters(rng, 64, 4, 25, 60, 0.16) + clusters(rng, 20, 2, 10, 10, 0.2)
    vecs += vecs[:7] + [[2 * x for x in v] for v in vecs[:5]]
    rows = [(int(i), v) for i, v in zip(rng.permutation(len(vecs)), vecs, strict=True)]
    check(spark, rows, embed_dup.Params(cell_rows=16, chunk_rows=16, ask_rows=7))


def test_edges(spark):
    rows = [(1, None), (2, [0.0, 0.0]), (3, [NAN, 1.0]), (4, [INF, 1.0]), (5, [1.0, None]), (6, []),
            (7, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [5.0, 0.0]), (10, [-1.0, 0.0]), (11, [1.0]), (12, [3.0]),
            (None, [1.0, 0.0]), (13, [1.0, 0.0, 0.0]), (7, [1.0, 0.0])]
    check(spark, rows)


def test_clashing_columns_and_empty_table(spark):
    schema = "vec_id bigint, embedding array<float>, weight int, cell string, links int, id int"
    check(spark, [(1, [1.0, 2.0], 1, "a", 2, 3), (2, [1.0, 2.1], 1, "b", 2, 3)], schema=schema)
    check(spark, [], schema=schema)


def test_local_forest_joins_all():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 80, 60), rng.integers(0, 80, 60)
    node, root = embed_dup.local_forest(a, b)
    got = dict(zip(node.tolist(), root.tolist(), strict=True))
    want = linked([p for p in zip(a.tolist(), b.tolist(), strict=True) if p[0] != p[1]], {*a.tolist(), *b.tolist()})
    assert {n: got.get(n, n) for n in want} == want


def test_doubles_beyond_single_precision(spark):
    rows = [(1, [1e39, 1e39]), (2, [1e39, 1e39]), (3, [1e-50, 0.0]), (4, [3e-50, 0.0]), (5, [1e300, 1e-300]),
            (6, [1e300, 0.0]), (7, [0.0, 1e-320]), (8, [0.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = embed_dup.near_duplicate_vectors(df).select("vec_id", "component_id", "n_links").collect()
    assert sorted(tuple(r) for r in got) == [
        (1, 1, 1), (2, 1, 1), (3, 3, 3), (4, 3, 3), (5, 3, 3), (6, 3, 3), (7, 7, 1), (8, 7, 1)]
