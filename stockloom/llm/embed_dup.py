"""Near-duplicate vectors: a subspace pigeonhole join.

For unit vectors cosine >= c means squared distance <= 2 - 2c. A rotation keeps distances, and
the squared distance is the sum of those inside blocks of coordinates, so at least one block
holds no more than its proportional share. Each block is therefore range-joined under its
share, and every pair found is confirmed by its cosine in double precision. Nothing is lost.

The range join of one block: cuts at 0 along some coordinates make cells. A vector is stored
in its own cell and asks in every cell that its ball reaches; crossing several cuts costs the
sum of the squared distances to them. Cells are cut into chunks of bounded size, each read
once as an array while the questions stream past it, so a cell that holds a third of all
vectors costs more tasks, not a larger one. A pair is counted in the first block that finds
it, and links leave a task as counts and a spanning forest, never as pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import combinations
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.llm.common import Work
from stockloom.llm.components import components
from stockloom.plans.lookup import shuffle_partitions


@dataclass(frozen=True)
class Params:
    cosine: float = 0.95
    wide: bool = False  # components need double precision; set from the column's type
    block: int = 8  # coordinates of a block
    cell_rows: int = 4096  # aim for the vectors of a cell, which sets the number of cuts
    chunk_rows: int = 8192  # most vectors of a cell that are read as one array
    ask_rows: int = 256  # questions answered at once

    @property
    def radius2(self) -> float:
        return 2 - 2 * self.cosine


def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation."""
    rng = np.random.Generator(np.random.PCG64(dim))
    q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def block_starts(dim: int, block: int) -> np.ndarray:
    return np.arange(0, dim, block)


SLACK = 1e-6


def _kind(p: Params) -> type:
    return np.float64 if p.wide else np.float32


def _matrix(column: pa.Array, dim: int, p: Params) -> np.ndarray:
    """A binary column of vectors of one length as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), _kind(p)).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    # By a power of two, which is exact: squares of very large or small numbers stay in range.
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


PLACED = "dim int, block int, cell int, asks boolean, own boolean, id bigint, weight bigint, vec binary"


def _placer(p: Params, cuts: int, ask: bool) -> Callable:
    """Rows of (id, weight, embedding) placed in cells; with ``ask`` also their questions."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(np.asarray(lists.offsets))
            flat = np.asarray(lists.flatten()).astype(_kind(p))
            at = np.concatenate([[0], np.cumsum(sizes)])
            for dim in np.unique(sizes):
                dim = int(dim)
                if dim not in turns:
                    turns[dim] = rotation(dim)
                rows = np.flatnonzero(sizes == dim)
                vecs = flat[at[:-1][rows][:, None] + np.arange(dim)]
                turned = _unit(vecs) @ turns[dim]
                raw = [v.tobytes() for v in vecs]
                out: dict[str, list] = {k: [] for k in ("block", "cell", "asks", "own", "row")}

                def add(block, cells, picked, asks, own, out=out):
                    n = len(picked)
                    out["block"].append(np.full(n, block, np.int32))
                    out["cell"].append(cells.astype(np.int32))
                    out["asks"].append(np.full(n, asks))
                    out["own"].append(np.full(n, own))
                    out["row"].append(picked)

                starts = block_starts(dim, p.block)
                for b, s in enumerate(starts):
                    part = turned[:, s : s + p.block][:, :cuts]
                    width = turned[:, s : s + p.block].shape[1]
                    share = p.radius2 * width / dim + SLACK
                    cell = ((part > 0) << np.arange(part.shape[1])).sum(1)
                    every = np.arange(len(rows))
                    add(b, cell, every, False, True)
                    if not ask:
                        continue
                    add(b, cell, every, True, True)
                    cost = part * part
                    # Each set of cuts whose crossing stays within the share; only towards
                    # cells of a higher number, as the pair is asked from the lower one.
                    for k in range(1, part.shape[1] + 1):
                        for cross in combinations(range(part.shape[1]), k):
                            flip = sum(1 << c for c in cross)
                            other = cell ^ flip
                            near = np.flatnonzero(
                                (cost[:, cross].sum(1) <= share) & (other > cell))
                            if len(near):
                                add(b, other[near], near, True, False)
                row = np.concatenate(out["row"])
                n = len(row)
                ids = batch.column(0).take(pa.array(rows[row]))
                weights = batch.column(1).take(pa.array(rows[row]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, dim, np.int32)), pa.array(np.concatenate(out["block"])),
                     pa.array(np.concatenate(out["cell"])), pa.array(np.concatenate(out["asks"])),
                     pa.array(np.concatenate(out["own"])), ids, weights,
                     pa.array(raw, pa.binary()).take(pa.array(row))],
                    names=["dim", "block", "cell", "asks", "own", "id", "weight", "vec"])

    return place


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links as (node, smallest node of its component), without the smallest themselves."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    low = np.arange(len(nodes))
    while True:
        least = np.minimum(low[x], low[y])
        new = low.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        np.minimum.at(new, low[x], least)
        np.minimum.at(new, low[y], least)
        new = new[new]
        if np.array_equal(new, low):
            break
        low = new
    rest = low != np.arange(len(nodes))
    return nodes[rest], nodes[low[rest]]


FOUND = "id bigint, root bigint, links bigint"


def _finder(p: Params) -> Callable:
    """Rows sorted by (dim, block, cell, chunk, asks) -> links per vector and a forest."""

    def answer(store: dict, ids, weights, vecs, own) -> list[tuple]:
        dim, block, start, stop = store["dim"], store["block"], store["start"], store["stop"]
        unit = _unit(vecs)
        turned = unit @ store["turn"]
        q = turned[:, start:stop]
        near = (q * q).sum(1)[:, None] + store["norm2"][None, :] - 2 * (q @ store["part"].T)
        hit = near <= store["share"] + SLACK
        hit &= ~own[:, None] | (ids[:, None] < store["ids"][None, :])
        i, j = np.nonzero(hit)
        if not len(i):
            return []
        out = []
        for at in range(0, len(i), 1 << 16):  # bounded steps for dense cells
            x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            apart = turned[x] - store["turned"][y]
            sums = np.add.reduceat(apart * apart, block_starts(dim, p.block), axis=1)
            within = sums <= store["shares"]
            good = within[:, block] & ~within[:, :block].any(1)
            x, y = x[good], y[good]
            good = (unit[x] * store["unit"][y]).sum(1) >= p.cosine
            x, y = x[good], y[good]
            if len(x):
                out.append((ids[x], store["ids"][y], weights[x], store["weights"][y]))
        return out

    def build(dim: int, block: int, rows: list, turn: np.ndarray) -> dict:
        ids, weights, vecs = (np.concatenate(c) for c in zip(*rows, strict=True))
        unit = _unit(vecs)
        turned = unit @ turn
        starts = block_starts(dim, p.block)
        start, stop = int(starts[block]), min(int(starts[block]) + p.block, dim)
        part = turned[:, start:stop]
        widths = np.diff(np.append(starts, dim))
        shares = p.radius2 * widths / dim + SLACK / 2
        return {"dim": dim, "block": block, "start": start, "stop": stop, "turn": turn,
                "ids": ids, "weights": weights, "unit": unit, "turned": turned, "part": part,
                "norm2": (part * part).sum(1), "share": shares[block], "shares": shares}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        key, rows, store = None, [], None
        ends: list[tuple] = []

        def flush():
            a, b, wa, wb = (np.concatenate(c) for c in zip(*ends, strict=True))
            ends.clear()
            nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
            links = np.zeros(len(nodes), np.int64)
            np.add.at(links, flat, np.concatenate([wb, wa]))
            node, root = local_forest(a, b)
            roots = nodes.copy()
            roots[np.searchsorted(nodes, node)] = root
            return pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(roots), pa.array(links)], names=["id", "root", "links"])

        for batch in batches:
            cols = {n: np.asarray(batch.column(i)) if n != "vec" else None
                    for i, n in enumerate(batch.schema.names)}
            keys = np.stack([cols[n].astype(np.int64) for n in
                             ("dim", "block", "cell", "chunk", "asks")], 1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(keys)], strict=True):
                dim, block, *_, asks = (int(v) for v in keys[lo])
                if dim not in turns:
                    turns[dim] = rotation(dim)
                if tuple(keys[lo, :4]) != key:
                    key, rows, store = tuple(keys[lo, :4]), [], None
                for s in range(lo, hi, p.ask_rows):
                    e = min(s + p.ask_rows, hi)
                    vecs = _matrix(batch.column(batch.schema.get_field_index("vec")).slice(s, e - s), dim, p)
                    if not asks:
                        rows.append((cols["id"][s:e], cols["weight"][s:e], vecs))
                        continue
                    if store is None:
                        if not rows:
                            break  # nobody lives in this cell
                        store = build(dim, block, rows, turns[dim])
                    ends += answer(store, cols["id"][s:e], cols["weight"][s:e], vecs, cols["own"][s:e])
                    if sum(len(x[0]) for x in ends) > 1 << 18:
                        yield flush()
        if ends:
            yield flush()

    return find


def near_duplicate_vectors(vectors: DataFrame, p: Params | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept, n_same) for every row of ``vectors``.

    ``vectors``: vec_id, embedding (an array of numbers); other columns are ignored. Two
    vectors are linked when their cosine in double precision is at least ``cosine``.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest vec_id
    reachable, ``kept`` tells the row of that id, ``n_same`` counts the rows with equal numbers.

    Null and zero vectors, and those with null or non-finite components, link with nothing and
    are kept. Only vectors of one length are compared. Rows with a null vec_id link with
    nothing, have a null component and are kept. Rows that repeat a vec_id with equal numbers
    are linked rows of one component. An empty table gives no rows.
    """
    number = vectors.schema["embedding"].dataType.elementType
    p = replace(p or Params(), wide=not isinstance(number, (T.FloatType, T.ByteType, T.ShortType)))
    work = Work(vectors.sparkSession, "embed_dup")
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>" if p.wide else "array<float>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
              & F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0))
    keys = [F.xxhash64("embedding").alias("key_a"), F.xxhash64("embedding", F.lit(1)).alias("key_b")]
    good = rows.filter(usable)
    classes = work.keep(
        good.groupBy(*keys).agg(
            F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"),
            F.any_value("embedding").alias("embedding")),
        "classes")

    n = classes.count()
    cuts = max(3, min(p.block, ceil(log2(max(n / p.cell_rows, 1)))))
    plain = classes.select("id", "weight", "embedding")
    cells = plain.mapInArrow(_placer(p, cuts, False), PLACED).groupBy("dim", "block", "cell").agg(
        F.count(F.lit(1)).alias("stored"))
    # At most 2 ** block cells per block of coordinates, so this table is small.
    chunks = F.broadcast(cells.select(
        "dim", "block", "cell", F.ceil(F.col("stored") / p.chunk_rows).cast("int").alias("chunks")))
    placed = plain.mapInArrow(_placer(p, cuts, True), PLACED).join(chunks, ["dim", "block", "cell"])
    dealt = placed.withColumn(
        "chunk",
        F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")))),
    ).drop("chunks")
    cell = ["dim", "block", "cell", "chunk"]
    found = work.keep(
        dealt.repartition(shuffle_partitions(work.spark), *cell)
        .sortWithinPartitions(*cell, "asks").mapInArrow(_finder(p), FOUND),
        "found")

    linked = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = (
        classes.select("key_a", "key_b", "id", "weight")
        .join(counts, "id", "left")
        .join(linked.withColumnRenamed("node", "id"), "id", "left")
        .select("key_a", "key_b", F.col("weight").alias("n_same"),
                (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "id").alias("component_id"))
    )
    marked = rows.select(
        "vec_id", *[F.when(usable, k).alias(a) for k, a in zip(keys, ("key_a", "key_b"), strict=True)])
    return marked.join(named, ["key_a", "key_b"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce("n_same", F.lit(1)).cast("bigint").alias("n_same"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
