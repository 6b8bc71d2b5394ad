"""Web archives: a distributed writer and a splittable reader of gzipped WARC files.

Every record is a gzip member of its own. The writer's tasks each write whole files below the
shared folder and report them in a manifest; files of attempts that were lost are in no
manifest and are never read. The reader cuts files into byte ranges. A task looks for gzip
magic in its range, decodes the candidate member and takes it only if a WARC header comes out
and the member's checksum holds; it owns the records that start inside its range and reads the
last one to its end, wherever that lies. No index is needed and no record is read twice.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm.common import Work
from stockloom.plans.lookup import shuffle_partitions

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


@dataclass(frozen=True)
class Params:
    least_bytes: int = 0  # smaller payloads are always written in full
    file_bytes: int = 256 << 20  # a task begins a new file beyond this
    split_bytes: int = 8 << 20
    read_bytes: int = 256 << 10
    date: str = "2024-01-01T00:00:00Z"


def opened(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """A file system and the path in it for a path or URI of a shared folder."""
    if "://" in uri:
        return arrow_fs.FileSystem.from_uri(uri)
    return arrow_fs.LocalFileSystem(), uri


def qualified(spark: SparkSession, path: str) -> str:
    """A path as a full URI, by the cluster's default file system."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = system.makeQualified(place).toString()
    return re.sub(r"^file:/+", "file:///", uri)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, holder, is_copy: bool, date: str) -> bytes:
    """One WARC record, not yet compressed."""
    head = HTTP_HEAD.format(len(payload)).encode()
    block = head if is_copy else head + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_copy else 'response'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
    ]
    if is_copy:
        lines += [f"WARC-Refers-To: <urn:page:{holder}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


MANIFEST = "path string, bytes bigint, records bigint"


def _writer(folder: str, p: Params) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(folder)
        out, done = None, []

        def close():
            nonlocal out
            if out is not None:
                out[0].close()
                done.append((out[1], out[2], out[3]))
                out = None

        for batch in batches:
            for i in range(batch.num_rows):  # one row at a time: rows may be large
                page_id, url, html, holder, is_copy = (batch.column(c)[i].as_py() for c in range(5))
                data = member(record(page_id, url, (html or "").encode(), holder, is_copy, p.date))
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    system.create_dir(base, recursive=True)
                    info = member(
                        f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>"
                        f"\r\nWARC-Date: {p.date}\r\nWARC-Filename: {name}\r\n"
                        "Content-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n".encode())
                    stream = system.open_output_stream(f"{base}/{name}", compression=None)
                    stream.write(info)
                    out = [stream, f"{folder}/{name}", len(info), 0]
                out[0].write(data)
                out[2] += len(data)
                out[3] += 1
                if out[2] >= p.file_bytes:
                    close()
        close()
        if done:
            path, size, count = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(path), pa.array(size, pa.int64()), pa.array(count, pa.int64())],
                names=["path", "bytes", "records"])

    return write


def write_archives(pages: DataFrame, work: Work, p: Params) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); returns the manifest.

    Among rows with equal payloads of at least ``least_bytes`` those with the largest page_id
    are responses; the others become revisits of that id.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("_sha1"),
        F.coalesce(F.octet_length("html"), F.lit(0)).alias("_bytes"),
    )
    # One row per payload that occurs more than once, so most rows find none.
    copies = rows.filter(F.col("_bytes") >= p.least_bytes).groupBy("_sha1", "_bytes").agg(
        F.max("page_id").alias("_holder"), F.count(F.lit(1)).alias("_n")
    ).filter("_n > 1 AND _holder IS NOT NULL").drop("_n")
    marked = rows.join(copies, ["_sha1", "_bytes"], "left").select(
        "page_id", "url", "html", "_holder",
        (F.col("_holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_holder"))).alias("_copy"),
    )
    folder = qualified(work.spark, work.path("archives"))
    return work.keep(marked.mapInArrow(_writer(folder, p), MANIFEST), "manifest")


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """The headers of a WARC record (names in lower case) and its block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return headers, rest[: int(headers.get("content-length", 0))]


def _decoded(stream, at: int, p: Params) -> tuple[bytes, int] | None:
    """The record in the gzip member at an offset, and the next offset; None if there is none."""
    unpack, out, pos = zlib.decompressobj(31), [], at
    stream.seek(at)
    seen = 0
    try:
        while not unpack.eof:
            raw = stream.read(p.read_bytes)
            if not raw:
                return None  # the file ends inside
            pos += len(raw)
            text = unpack.decompress(raw)
            if text:
                out.append(text)
                seen += len(text)
                if seen >= 7 and not b"".join(out[:8])[:7] == b"WARC/1.":
                    return None
    except zlib.error:
        return None
    data = b"".join(out)
    return (data, pos - len(unpack.unused_data)) if data[:7] == b"WARC/1." else None


def _candidates(stream, at: int, end: int, p: Params) -> Iterator[int]:
    """Offsets of gzip magic from ``at`` on that lie before ``end``."""
    while at < end:
        stream.seek(at)
        raw = stream.read(min(p.read_bytes, end - at) + len(MAGIC) - 1)
        found = raw.find(MAGIC)
        while found >= 0:
            if at + found < end:
                yield at + found
            found = raw.find(MAGIC, found + 1)
        if len(raw) < len(MAGIC):
            return
        at += max(1, len(raw) - len(MAGIC) + 1)


def records_in(stream, start: int, end: int, p: Params) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of the members that start in [start, end)."""
    at = start
    while at < end:
        got = None
        for place in _candidates(stream, at, end, p):
            got = _decoded(stream, place, p)
            if got:
                break
        if not got:
            return
        yield place, got[0]
        at = got[1]


RECORDS = ("path string, offset bigint, record_type string, page_id bigint, url string,"
           " refers_to bigint, payload_bytes bigint, payload_digest string, payload binary")
PAGE = re.compile(r"<urn:page:(-?\d+)>")


def _row(path: str, offset: int, data: bytes, payloads: bool) -> tuple | None:
    headers, block = parsed(data)
    kind = headers.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    named = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or digest(payload) != named):
        raise ValueError(f"damaged payload in {path} at {offset}")

    def page(header):
        found = PAGE.fullmatch(headers.get(header, ""))
        return int(found[1]) if found else None

    return (path, offset, kind, page("warc-record-id"), headers.get("warc-target-uri"),
            page("warc-refers-to"), size, named, payload if payloads and kind == "response" else None)


def _reader(p: Params, payloads: bool) -> Callable:
    names = [x.split()[0] for x in RECORDS.split(",")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(),
             pa.string(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for splits in batches:
            for s in splits.to_pylist():
                system, path = opened(s["path"])
                with system.open_input_file(path) as stream:
                    for offset, data in records_in(stream, s["start"], s["end"], p):
                        row = _row(s["path"], offset, data, payloads)
                        if row is None:
                            continue
                        rows.append(row)
                        held += len(data) if payloads else 200
                        if held >= 4 << 20:
                            yield batch(rows)
                            rows, held = [], 0
        if rows:
            yield batch(rows)

    return read


def read_archives(files: DataFrame, p: Params | None = None, payloads: bool = True) -> DataFrame:
    """The response and revisit records of gzipped WARC files (path, bytes), by byte ranges.

    Members that do not decode or hold no WARC record are passed over; a response whose payload
    does not meet its own digest stops the read. Empty files have no records.
    """
    p = p or Params()
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(p.split_bytes).cast("bigint")))
    splits = files.filter("bytes > 0").select("path", "bytes", starts.alias("start")).select(
        "path", "start", F.least("bytes", F.col("start") + p.split_bytes).alias("end"))
    dealt = splits.repartition(shuffle_partitions(files.sparkSession), "path", "start")
    return dealt.mapInArrow(_reader(p, payloads), RECORDS)


def archive(pages: DataFrame, p: Params | None = None, payloads: bool = True) -> DataFrame:
    """Write ``pages`` (page_id, url, html; other columns are ignored) and read them back.

    One row per page: the columns of ``read_archives``. A null html is an empty payload, a null
    url an empty target, control characters and blanks in a url are percent-encoded. A null
    page_id is written as such, comes back null and is never the one that others refer to.
    Rows that repeat the largest page_id of a payload are all responses. An empty table gives
    no file and no rows.
    """
    p = p or Params()
    work = Work(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, work, p), p, payloads)
