"""Spelling variants against comparing all words with each other."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from stockloom.llm import edit_automata, spelling

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def brute(rows, p):
    seen = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % p.modulus == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= p.shortest:
                seen[run] += 1
    n = {w: c for w, c in seen.items() if c >= p.least}
    forms, degree = {}, {}
    for w in n:
        others = [v for v in n if near(w, v)]
        degree[w] = len(others)
        best = min(others, key=lambda v: (-n[v], v), default=None)
        forms[w] = best if best is not None and n[best] >= p.ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n[w], degree[w], n[forms[w]] if forms[w] else None))
    return sorted(out)


def noisy(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcßéÿ") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randint(0, 30)):
            w = rng.choice(words[: rng.randint(1, 60)])
            at, c = rng.randrange(len(w)), rng.choice("abcé")
            text.append({0: w[:at] + w[at + 1 :], 1: w[:at] + c + w[at:], 2: w[:at] + c + w[at + 1 :]}.get(
                rng.randrange(9), w.capitalize() if rng.random() < 0.1 else w))
        rows.append((i, rng.choice([" ", ", ", "1", "×", "ā", "-"]).join(text)))
    return rows


def test_equals_comparing_all(spark):
    rows = noisy(2, 250) + [(900, None), (901, ""), (None, "abcab abcab abcac"), (902, "z" * 50_000 + " Zzzzzz " * 9)]
    rows += [(903, "aaaaa aaaaaa aaaaaaa " * 5)] * 4 + [(904, "z" * 50_000 + "\n" + "z" * 49_999)] * 3
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, word string, n int")
    for p in (spelling.Params(), spelling.Params(modulus=3, least=2, chunk_rows=50), spelling.Params(least=1, ratio=1 + 2)):
        got = sorted(tuple(r) for r in spelling.groups(docs, p).collect())
        assert got == brute(rows, p)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert spelling.groups(none).collect() == []
    assert spelling.groups(spark.createDataFrame([(1, "one two thirty")], none.schema)).collect() == []


def test_chains_are_followed_to_the_end(spark):
    words = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb", "bbbbbb", "bbbbcb", "bbbccb"]
    rows = [(i, f"{w} " * 3 * 2**i) for i, w in enumerate(words)]
    p = spelling.Params(modulus=2**32 - 1)
    got = {r.word: r.root for r in spelling.groups(spark.createDataFrame(rows, "doc_id bigint, text string"), p).collect()}
    assert got == {w: words[-1] for w in words}


def test_states_with_the_same_strings_are_one():
    group = np.repeat(np.arange(50), 4)
    strings = np.tile(np.array([[1, 2, 3], [1, 2, 4], [1, 5, 3], [1, 5, 4]], np.uint8), (50, 1))
    levels, initial = edit_automata.minimised(strings, group, 50)
    assert set(initial.tolist()) == {0}
    assert [len(x.label) for x in levels] == [1, 2, 2]
    start, i, j = edit_automata.replaced(levels, np.array([0]))
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == [(0, 1), (0, 2), (1, 3), (2, 3)]


def test_checksums():
    rng = random.Random(1)
    words = [bytes(rng.randrange(256) for _ in range(rng.randint(1, 90))) for _ in range(300)]
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    heads = [f"{rng.randrange(10**6)}:".encode() for _ in words]
    got = spelling.crc32_behind(np.array([zlib.crc32(h) for h in heads], np.uint32),
                                np.frombuffer(b"".join(words), np.uint8), starts, ends)
    assert got.tolist() == [zlib.crc32(h + w) for h, w in zip(heads, words, strict=True)]


def test_letters_are_the_latin_ones():
    text = "".join(map(chr, range(1, 0x250)))
    data = np.frombuffer(text.encode(), np.uint8)
    found = spelling.letters_only(data).tobytes().decode().split()
    assert found == re.findall("[A-Za-zÀ-ÿ]+", text.translate(ASCII))
    assert pa.array(found).to_pylist() == found


def test_few_words_are_kept_in_few_files(spark, files_kept, setting, monkeypatch):
    monkeypatch.setattr(spelling.Work, "drop", lambda *_: None)
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    rows = noisy(3, 60)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    p = spelling.Params(least=1, modulus=3)
    got = []
    kept = files_kept(lambda: got.extend(tuple(r) for r in spelling.groups(docs, p).collect()))
    assert sorted(got) == brute(rows, p)
    # Only the words themselves, of which nothing is known before, stand in a file for each partition.
    assert len(kept) > 3 and sorted(kept)[-2] <= 2 * spark.sparkContext.defaultParallelism
