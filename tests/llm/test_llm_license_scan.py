"""License scans: edges, and the filters against plain counting."""

import re

from stockloom.llm import license_scan

COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(doc_id, text):
    words = WORD.findall(fold(text))
    places, base = [], set()
    for phrase, label in license_scan.PHRASES.items():
        parts = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                base.add(label)
    labels, best = set(base), 0.0
    for line in fold(text).split("\n"):
        own = set(WORD.findall(line))
        for label, template in license_scan.TEMPLATES:
            want = set(license_scan.template_words(template))
            if len(own & want) >= license_scan.needed(len(want), 0.9):
                labels.add(label)
                best = max(best, len(own & want) / len(want))
    return (doc_id, len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if places else best)


TEXTS = [
    None, "", "...", "MIT License", "mit license mit license, MIT LICENSE", "the mit", "license mit",
    "Released under the MIT\nLicense.", "x Released, under the MIT License! y",
    "gnu general public license cc by apache license", "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0",
    "This work is licensed under the GNU Public License, version 3.",  # one word of twelve missing
    "This work licensed under the GNU Public License, version 3.",  # two missing
    "MİT LICENSE", "MIT LICENSEK", "Kmit license", "é mit license é", "mit\x00license",
    "word " * 60_000 + "\nReleased under the MIT License.",
    license_scan.TEMPLATES[8][1].upper(), license_scan.TEMPLATES[6][1].replace(" ", "  "),
]


def test_against_plain_counting(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "MIT license"), (3, "MIT license")]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).select(COLUMNS)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted((brute(*r) for r in rows), key=str)


def test_blocks_and_containment_are_told(spark):
    text = "a\nLicensed under CC BY-NC 4.0.\nb"
    row = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert (1, "cc-by-nc-4.0", 1.0) in [tuple(m) for m in row.matches]


def test_clashing_columns_and_empty_table(spark):
    schema = "doc_id bigint, text string, matches int, _spaced string, score int, line string"
    df = spark.createDataFrame([(1, "MIT License", 1, "x", 2, "y")], schema)
    assert tuple(license_scan.scan(df).select(COLUMNS).first()) == brute(1, "MIT License")
    assert license_scan.scan(spark.createDataFrame([], schema)).collect() == []
