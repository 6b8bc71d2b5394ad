"""Collocations against plain counting, and the double-array trie against sets of strings."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from stockloom.llm import double_array, phrases

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, p):
    counts = defaultdict(Counter)
    total = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(ASCII)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for width in range(1, p.words + 1):
                for i in range(len(words) - width + 1):
                    counts[lang][tuple(words[i : i + width])] += 1
    out = []
    for lang, f in counts.items():
        some = {k: a for k, a in f.items() if len(k) > 1 and a >= p.least}
        best = []
        for k, a in some.items():
            inside = any(len(x) > len(k) and any(x[i : i + len(k)] == k for i in range(len(x) - len(k) + 1))
                         and 100 * n >= p.share * a for x, n in some.items())
            if not inside:
                score, _, l, r = min((10**6 * a * a // (f[k[:c]] * f[k[c:]]), c, f[k[:c]], f[k[c:]])
                                     for c in range(1, len(k)))
                best.append((-score, -a, " ".join(k).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[: p.top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def texts(seed, n):
    rng = random.Random(seed)
    words = ["a", "ab", "b", "the", "The", "of", "köln", "x" * 40, "\x00", "q's", "új"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "!", " \x0b"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words[: rng.randint(2, 11)]) + rng.choice(marks) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "en", "de", None, "und", ""]), text))
    return rows


def test_equals_counting(spark):
    rows = texts(1, 300) + [("en", None), ("en", ""), (None, " \n"), ("en", "of the " * 40_000)]
    rows += [("de", "ein haus am see. " * 4)] * 40
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n int, phrase string")
    for p in (phrases.Params(words=4, least=3, share=80, top=40, trie_keys=4000, buckets=3, phrase_bits=16),
              # Bitmaps that are full tell nothing; the counts stay the same.
              phrases.Params(least=5, word_bits=7, phrase_bits=7)):
        got = sorted(tuple(r) for r in phrases.collocations(docs, p).collect())
        assert got == brute(rows, p)


def test_empty(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(none).collect() == []
    assert phrases.collocations(spark.createDataFrame([("en", "one two three")], none.schema)).collect() == []


def test_double_array_holds_its_keys():
    rng = random.Random(4)
    keys = sorted({bytes(rng.choice(b"abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(5000)}
                  | {bytes([i, j]) for i in range(0, 256, 3) for j in range(256) if j not in (10, 32)} | {b"z" * 3000})
    keys = [k for k in keys if 10 not in k and 32 not in k]
    flat = np.concatenate([np.array([b + 2 for b in k] + [0], np.int16) for k in keys])
    first = np.concatenate([[0], np.cumsum([len(k) + 1 for k in keys])])
    base, check = double_array.build(flat, first)
    words = keys[::2] + [k + b"!" for k in keys[::5]] + [k[:-1] for k in keys[::7] if len(k) > 1]
    text = np.frombuffer(b"\n".join(words) + b"\n", np.uint8)
    at = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])])[:-1]
    stops = np.zeros(256, bool)
    stops[[10, 32]] = True
    met = double_array.walk(base, check, text, at, np.zeros(len(at), np.int64), stops, 2)
    want = Counter(w for w in words if w in set(keys))
    assert Counter(keys[i] for i in met.tolist()) == want
    # A key for every state: no entry is shared.
    assert len(base) < 3 * len(flat) + 2000


def test_a_trie_of_nothing():
    trie = phrases.trie_of(pa.table({"lang": pa.array([], pa.string()), "phrase": pa.array([], pa.string())}))
    assert double_array.start(trie["base"], trie["check"], [1]) == -1


def test_one_pass_over_the_texts_whatever_the_number_of_tries(spark, monkeypatch):
    rows = texts(2, 120)
    kept, plain = [], phrases.Work.keep
    monkeypatch.setattr(phrases.Work, "keep", lambda self, df, name: kept.append(name) or plain(self, df, name))
    p = phrases.Params(least=2, trie_keys=15)
    got = phrases.collocations(spark.createDataFrame(rows, "lang string, text string"), p).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, p)
    assert sum(name.startswith("counts") for name in kept) == 1


class Sent:
    value = [np.full(4, np.uint64(2**64 - 1))] * 3  # all bits set: every phrase can be a candidate


def test_phrases_with_one_hash_are_told_apart_and_rows_follow_the_bytes(monkeypatch):
    plain = phrases.Tokens.keys
    monkeypatch.setattr(phrases.Tokens, "keys", lambda self, width: plain(self, width) % np.uint64(7))
    rows = [("und" if a is None else a, b) for a, b in texts(3, 400)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["lang", "text"])

    def dealt(parts, batches):
        return list(phrases._dealer(Sent, parts, phrases.Params())(iter(batches)))

    counts = Counter()
    for out in dealt(5, [batch, batch]):
        for _, _, lang, text, numbers in zip(*(c.to_pylist() for c in out.columns), strict=True):
            lines = text.decode().split("\n")[:-1]
            for phrase, n in zip(lines, np.frombuffer(numbers, np.int32), strict=True):
                counts[lang, phrase] += int(n)
    want = Counter()
    for lang, text in rows * 2:
        for piece in re.split("[.,;:!?\x0a-\x0d]", text.translate(ASCII)):
            words = re.findall("[^\x20\x09]+", piece)
            for width in (1, 2, 3):
                want.update((lang, " ".join(words[i : i + width])) for i in range(len(words) - width + 1))
    assert counts == want
    few, many = (sum(out.num_rows for out in dealt(parts, [batch] * 40)) for parts in (2, 7))
    assert many <= 4 * few
