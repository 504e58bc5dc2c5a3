"""WARC archives with a two-level capture index.

``write_archives`` turns pages into gzip-member WARC files (one or more a task)
and returns where each record lies. Of pages with equal payloads the smallest
page_id becomes a response record, the others are revisits that refer to it.
``build_index`` range-sorts captures by their reversed-host URL key, compresses
them into blocks in one index file a task, and returns the sparse directory: one
row for each block. ``lookup`` sends keys to the index files whose key range
holds them, binary-searches the directory there, reads those blocks by range and
binary-searches their lines. ``read_records`` range-reads and parses records.

Files go to the shared folder through ``pyarrow.fs`` under a name of their own
for each attempt; a table written after them names the files that count, so a
task that runs again leaves at most an unused file.

Payloads are shuffled once, by (page_id, digest); the join that finds the first
page of a payload moves ids and digests only, since one payload may belong to a
third of all pages. A URL with any number of captures spreads over index files.

Defined cases: null html is an empty payload; a null url has the empty key; a
null page_id is kept, but is no payload's first page unless all its pages lack
one; repeated rows give a record each (of the smallest id: all responses); an
empty table gives no archives and empty results.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ragtide.session import scratch_path, ship_package

from .common import written

MIN_DEDUP_BYTES, FILE_BYTES, BLOCK_LINES = 0, 256 << 20, 256
#: Compressed record bytes that one task reads back.
READ_BYTES = 8 << 20
CAPTURE = "key string, page_id bigint, file string, offset bigint, length bigint"
DIRECTORY = "file string, first string, last string, offset bigint, length bigint"
RECORD = ("page_id bigint, url string, status string, payload_bytes bigint, payload_digest string,"
          " record_type string, refers_to bigint, payload binary")


def opened(uri: str):
    """(file system, path) of a Hadoop-style or plain path."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def url_key(url: str | None) -> str:
    """Reversed host, then path and query: com,example,www)/a?b."""
    url = " ".join((url or "").split())
    try:
        parts = urlsplit(url)
        host = parts.netloc.rpartition("@")[2].lower()
    except ValueError:
        return url
    if not host:
        return url
    name, colon, port = host.partition(":")
    path = (parts.path or "/") + ("?" + parts.query if parts.query else "")
    return ",".join(reversed(name.split("."))) + colon + port + ")" + path


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str, payload: bytes, first) -> bytes:
    """One gzip member: a response, or a revisit of page ``first``."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    body = http + payload if first is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Target-URI: {url}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    if first is not None:
        head[2:2] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                     f"WARC-Refers-To: <urn:page:{first}>"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", mtime=0)


def parse_record(member: bytes) -> dict:
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    lines = http.decode().split("\r\n")
    size = int(dict(x.split(": ", 1) for x in lines[1:])["Content-Length"])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"broken record {fields['WARC-Record-ID']}")

    def number(name):
        found = fields.get(name, "").removeprefix("<urn:page:").rstrip(">")
        return int(found) if found else None

    return {"page_id": number("WARC-Record-ID"), "url": fields["WARC-Target-URI"], "status": lines[0],
            "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": number("WARC-Refers-To"), "payload": payload if kind == "response" else None}


class Files:
    """Output files of one task attempt, rolled at a size."""

    def __init__(self, root: str, name: str, limit: int):
        self.fs, self.root = opened(root)
        self.name, self.limit, self.out, self.n = name, limit, None, 0
        self.attempt = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:8]}"

    def write(self, data: bytes, head: bytes = b"") -> tuple[str, int]:
        """(file, offset) of the written bytes."""
        if self.out is None:
            self.fs.create_dir(self.root, recursive=True)
            self.file, self.at = self.name.format(f"{self.attempt}-{self.n}"), len(head)
            self.out, self.n = self.fs.open_output_stream(f"{self.root}/{self.file}", compression=None), self.n + 1
            self.out.write(head)
        place = self.file, self.at
        self.out.write(data)
        self.at += len(data)
        if self.at >= self.limit:
            self.close()
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def _write(root: str, limit: int, schema: pa.Schema):
    info = b"software: ragtide\r\nformat: WARC File Format 1.1\r\n"
    head = gzip.compress(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:archive>\r\n"
                         b"WARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\n"
                         b"Content-Length: %d\r\n\r\n" % len(info) + info + b"\r\n\r\n", mtime=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files(root, "pages-{}.warc.gz", limit)
        for b in batches:
            rows = []
            for r in b.to_pylist():
                url = " ".join((r["url"] or "").split())
                member = record(r["page_id"], url, (r["html"] or "").encode(), r["first"])
                file, at = files.write(member, head)
                rows.append({"key": url_key(url), "page_id": r["page_id"], "file": f"{root}/{file}",
                             "offset": at, "length": len(member)})
            yield pa.RecordBatch.from_pylist(rows, schema)
        files.close()
    return run


def write_archives(pages: DataFrame, root: str | None = None, min_bytes: int = MIN_DEDUP_BYTES,
                   file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) under ``root``; a table of captures."""
    spark = pages.sparkSession
    ship_package(spark)
    root = root or scratch_path(spark, "archives")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                         html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    large = pages.where(F.octet_length("html") >= min_bytes).select("page_id", "digest")
    firsts = written(large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                     .where("n > 1 AND first IS NOT NULL").select("digest", "first"), "firsts")
    revisits = (large.join(firsts, "digest").where("page_id IS NULL OR page_id > first")
                .groupBy("page_id", "digest").agg(F.first("first").alias("first"))
                .withColumnsRenamed({"page_id": "_p", "digest": "_d"}))
    known = pages.join(revisits, F.col("page_id").eqNullSafe(F.col("_p")) & (F.col("digest") == F.col("_d")), "left")
    schema = to_arrow_schema(spark.createDataFrame([], CAPTURE).schema)
    return written(known.select("page_id", "url", "html", "first").mapInArrow(
        _write(root, file_bytes, schema), CAPTURE), "captures")


def _index(root: str, lines: int, schema: pa.Schema):
    def run(batches):
        files, held = Files(root, "index-{}.cdxz", 1 << 62), []

        def block():
            packed = zlib.compress("\n".join("\t".join(map(str, x)) for x in held).encode())
            file, at = files.write(packed)
            return pa.RecordBatch.from_pylist([{"file": f"{root}/{file}", "first": held[0][0], "last": held[-1][0],
                                                "offset": at, "length": len(packed)}], schema)

        for b in batches:
            for r in b.to_pylist():
                held.append((r["key"], "" if r["page_id"] is None else r["page_id"], r["file"], r["offset"], r["length"]))
                if len(held) == lines:
                    yield block()
                    held = []
        if held:
            yield block()
        files.close()
    return run


def build_index(captures: DataFrame, root: str | None = None, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sorted, compressed blocks under ``root``; the block directory as a table."""
    spark = captures.sparkSession
    root = root or scratch_path(spark, "index")
    ordered = (captures.repartitionByRange("key", "page_id", "file", "offset")
               .sortWithinPartitions("key", "page_id", "file", "offset"))
    schema = to_arrow_schema(spark.createDataFrame([], DIRECTORY).schema)
    return written(ordered.mapInArrow(_index(root, block_lines, schema), DIRECTORY), "directory")


def _search(schema: pa.Schema):
    def run(key: tuple, queries: pa.Table, directory: pa.Table) -> pa.Table:
        blocks = directory.sort_by("offset").to_pylist()
        if not blocks or not queries.num_rows:
            return schema.empty_table()
        store, path = opened(blocks[0]["file"])
        firsts, lasts = [b["first"] for b in blocks], [b["last"] for b in blocks]
        out, at, rows, keys = [], -1, [], []
        with store.open_input_file(path) as f:
            for q in sorted(queries.column("key").to_pylist()):
                # a key may run over several blocks
                for n in range(bisect_left(lasts, q), bisect_right(firsts, q)):
                    if n != at:
                        b = blocks[n]
                        f.seek(b["offset"])
                        lines = zlib.decompress(f.read(b["length"])).decode().split("\n")
                        rows = [x.split("\t") for x in lines]
                        at, keys = n, [r[0] for r in rows]
                    out += rows[bisect_left(keys, q):bisect_right(keys, q)]
        cols = list(zip(*out)) or [()] * 5
        return pa.table([pa.array(cols[0], pa.string()), pa.array([int(x) if x else None for x in cols[1]], pa.int64()),
                         pa.array(cols[2], pa.string()), pa.array([int(x) for x in cols[3]], pa.int64()),
                         pa.array([int(x) for x in cols[4]], pa.int64())], schema=schema)
    return run


def _send(ranges: list[tuple[str, str, str]]):
    firsts, lasts = [r[0] for r in ranges], [r[1] for r in ranges]

    def run(batches):
        for b in batches:
            keys, files = [], []
            for k in b.column("key").to_pylist():
                for n in range(bisect_left(lasts, k), bisect_right(firsts, k)):
                    keys.append(k)
                    files.append(ranges[n][2])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(files, pa.string())], ["key", "file"])
    return run


def lookup(directory: DataFrame, queries: DataFrame) -> DataFrame:
    """Captures of the distinct keys in ``queries`` (key)."""
    spark = directory.sparkSession
    # one row for each index file: as many as the tasks that wrote them
    ranges = sorted((r["first"], r["last"], r["file"]) for r in
                    directory.groupBy("file").agg(F.min("first").alias("first"), F.max("last").alias("last")).collect())
    sent = queries.select("key").distinct().mapInArrow(_send(ranges), "key string, file string")
    schema = to_arrow_schema(spark.createDataFrame([], CAPTURE).schema)
    return sent.groupBy("file").cogroup(directory.groupBy("file")).applyInArrow(_search(schema), CAPTURE)


def _read(schema: pa.Schema):
    def run(batches):
        name, f = None, None
        for b in batches:
            rows = []
            for file, at, n in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if file != name:
                    if f:
                        f.close()
                    store, path = opened(file)
                    name, f = file, store.open_input_file(path)
                f.seek(at)
                rows.append(parse_record(f.read(n)))
            yield pa.RecordBatch.from_pylist(rows, schema)
        if f:
            f.close()
    return run


def read_records(captures: DataFrame) -> DataFrame:
    """Range-read and parse the records of ``captures``, in file order. The number of
    tasks follows the bytes to read, not the size of the capture rows."""
    schema = to_arrow_schema(captures.sparkSession.createDataFrame([], RECORD).schema)
    captures = written(captures.select("file", "offset", "length"), "captures")
    tasks = -(-(captures.agg(F.sum("length")).first()[0] or 1) // READ_BYTES)
    ordered = captures.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.select("file", "offset", "length").mapInArrow(_read(schema), RECORD)
