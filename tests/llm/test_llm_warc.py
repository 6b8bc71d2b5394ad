"""The WARC writer and the splittable reader."""

import base64
import hashlib
import io

import pytest

from stockloom.llm import warc
from stockloom.llm.common import Work


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


ROWS = [
    (1, "http://a/1", "<p>one</p>", 9), (2, "http://a/2", "<p>one</p>", 9), (3, "http://a/3", "<p>one</p>", 9),
    (4, None, None, 9), (5, "http://a b/\r\nX: y", "", 9), (6, "u", "é" * 300_000, 9), (7, "u", "\x1f\x08 WARC/1.1", 9),
    (None, "n", "<p>one</p>", 9), (None, "n", "alone", 9), (8, "u", "same", 9), (8, "u", "same", 9),
]
SCHEMA = "page_id bigint, url string, html string, payload string"


def expected(rows):
    out = []
    for i, _, html, _ in rows:
        same = [j for j, _, h, _ in rows if (h or "") == (html or "") and j is not None]
        copy = bool(same) and i != max(same)
        out.append((i, len((html or "").encode()), digest(html), "revisit" if copy else "response",
                    max(same) if copy else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [97, 4096, 8 << 20])
def test_round_trip_at_any_split(spark, split):
    got = warc.archive(spark.createDataFrame(ROWS, SCHEMA), warc.Params(split_bytes=split, read_bytes=64))
    rows = got.collect()
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in columns) for r in rows), key=str) == expected(ROWS)
    for r in rows:
        if r.record_type == "response":
            assert digest(bytes(r.payload).decode()) == r.payload_digest
    assert {r.url for r in rows if r.page_id == 5} == {"http://a%20b/%0D%0AX:%20y"}


def test_many_files_and_small_payloads_in_full(spark):
    df = spark.createDataFrame([(i, "u", f"page {i % 3}", 1) for i in range(200)], SCHEMA).repartition(4)
    work = Work(spark, "warc-test")
    p = warc.Params(file_bytes=2000, least_bytes=7)
    files = warc.write_archives(df, work, p)
    assert files.count() > 8
    rows = warc.read_archives(files, p).collect()
    assert len(rows) == 200 and {r.record_type for r in rows} == {"response"}
    assert len({(r.path, r.offset) for r in rows}) == 200


def test_empty_table(spark):
    assert warc.archive(spark.createDataFrame([], SCHEMA)).collect() == []


def test_false_magic_and_damage_are_passed_over():
    p = warc.Params(read_bytes=50)
    one, two = (warc.member(warc.record(i, "u", b"text %d" % i, None, False, p.date)) for i in (1, 2))
    junk = warc.MAGIC + b"\x00" * 40 + warc.member(b"no archive") + one[: len(one) // 2]
    data = junk + one + warc.MAGIC + two + b"trailing" + warc.MAGIC
    for cut in range(0, len(data) + 1, 7):
        found = [offset for lo, hi in ((0, cut), (cut, len(data)))
                 for offset, _ in warc.records_in(io.BytesIO(data), lo, hi, p)]
        assert found == [len(junk), len(junk) + len(one) + len(warc.MAGIC)]


def test_damaged_payload_stops_the_read():
    data = warc.record(1, "u", b"text", None, False, "d").replace(b"\r\n\r\ntext", b"\r\n\r\ntexx")
    with pytest.raises(ValueError):
        warc._row("f", 0, data, True)
