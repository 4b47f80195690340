"""WARC archives with a two-level capture index.

Records are written as gzip members of archives in a folder, one or more archives a task. The index holds a line a record, sorted by
reversed-host URL key and page: sorted shards of compressed blocks, each shard ending in a sparse directory with the first key
of each block. A lookup bisects the shards' first keys, then the directory, reads and inflates one block, and range-reads the
record. Shards' first keys are one entry per task of the index build; nothing else reaches the driver.

Files go through Arrow's file systems to the folder that all machines share, under names of their attempt, so that a task that is run again
never writes over what the index of its first run refers to. Of records with equal payloads (SHA-1 and length) of least_bytes or more,
the one with the smallest id is a response and the others revisit it.

Cases: a null payload is empty; a null URL has an empty key; rows with a null id are archived, too: they revisit a page of equal payload that
has an id, else each is a response, as nothing can refer to it; rows that repeat an id and payload are records of their own and of one
type; very long payloads are written and read whole; columns beyond id, URL and payload are ignored; an empty table makes no archive
and finds nothing.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import new_path, publish, table

#: Payloads from so many bytes on are written once; index lines of a block; bytes at which an archive ends; bytes of records that a task reads; date of the records.
LEAST_BYTES, BLOCK_LINES, ARCHIVE_BYTES, READ_BYTES, DATE = 0, 256, 1 << 28, 1 << 26, "2024-01-01T00:00:00Z"
#: In place of an id where there is none.
NO_ID = -(2**63)
_SCHEMA = "surt string, id long, archive string, offset long, length long"


def surt(url: Column) -> Column:
    """Reversed-host key of a URL: `com,example,blog)/path?query`; scheme, user, port and fragment do not count."""
    plain = F.regexp_replace(F.coalesce(url, F.lit("")), "#.*$", "")
    host = F.lower(F.regexp_extract(plain, "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?]*@)?([^/?:]*)", 1))
    path = F.regexp_replace(plain, "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit("/"), path)))


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """A record: the HTTP response, or, of a revisit, its head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{'' if page == NO_ID else page}>"), ("WARC-Date", DATE), ("WARC-Target-URI", "".join(url.splitlines())), ("WARC-Payload-Digest", f"sha1:{digest32(payload)}")]
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(record's fields, HTTP fields, payload) of an inflated record."""
    at = raw.index(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in raw[:at].decode().split("\r\n")[1:])
    block = raw[at + 4 : at + 4 + int(fields["Content-Length"])]
    cut = block.index(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in block[:cut].decode().split("\r\n")[1:])
    return fields, http, block[cut + 4 :]


class _Out:
    """A file that appears under its name only when complete."""

    def __init__(self, folder: str, name: str):
        from pyarrow.fs import FileSystem

        self.fs, root = FileSystem.from_uri(folder)
        self.fs.create_dir(root, recursive=True)
        self.path, self.partial = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}"
        self.stream, self.at = self.fs.open_output_stream(self.partial, compression=None), 0

    def write(self, data: bytes) -> tuple[int, int]:
        self.stream.write(data)
        at, self.at = self.at, self.at + len(data)
        return at, len(data)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.partial, self.path)


class _In:
    """Range reads, with few files open."""

    def __init__(self, folder: str, most_open: int = 32):
        from pyarrow.fs import FileSystem

        (self.fs, self.root), self.open, self.most_open = FileSystem.from_uri(folder), OrderedDict(), most_open

    def read(self, name: str, offset: int, length: int) -> bytes:
        f = self.open.pop(name, None) or self.fs.open_input_file(f"{self.root}/{name}")
        self.open[name] = f
        if len(self.open) > self.most_open:
            self.open.popitem(last=False)[1].close()
        return f.read_at(length, offset)


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _task() -> str:
    """Name of this attempt of a task, so that a second one never writes over files that index lines of the first refer to."""
    from pyspark import TaskContext

    context = TaskContext.get()
    return f"{context.partitionId():06d}-{context.taskAttemptId():08d}" if context else "0"


def _write(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, part = None, 0
        for batch in batches:
            rows = []
            for page, url, key, html, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name = f"pages-{_task()}-{part:04d}.warc.gz"
                    out, part = _Out(folder, name), part + 1
                rows.append((key, page, name, *out.write(_gzip(record(page, url or "", (html or "").encode(), refers)))))
                if out.at >= archive_bytes:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)] if rows else [pa.array([], t) for t in (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())], names=["surt", "id", "archive", "offset", "length"])
        if out is not None:
            out.close()

    return run


def _write_index(folder: str, block_lines: int):
    """Sorted index rows to a shard: blocks, then the directory; returns (first key, name, offset and length of the directory)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, lines, directory = None, [], []

        def flush() -> None:
            if lines:
                directory.append((*lines[0][:2], *out.write(zlib.compress("\n".join(json.dumps(x) for x in lines).encode()))))
                lines.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name = f"index-{_task()}.cdx"
                    out = _Out(folder, name)
                lines.append(row)
                if len(lines) >= block_lines:
                    flush()
        if out is not None:
            flush()
            at, length = out.write(zlib.compress(json.dumps(directory).encode()))
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([directory[0][1]], pa.int64()), pa.array([name]), pa.array([at], pa.int64()), pa.array([length], pa.int64())], names=["surt", "id", "name", "offset", "length"])

    return run


@dataclass
class Captures:
    """Archives and their index: a folder, (first URL key, first page, name, offset, length) of each shard, in order, and the bytes of all records."""

    folder: str
    shards: list[tuple[str, int, str, int, int]]
    record_bytes: int = 0


class Reader:
    """Binary search over shards, directory and block, then range reads."""

    def __init__(self, captures: Captures):
        self.files, self.shards = _In(captures.folder), captures.shards
        self.first = [s[:2] for s in self.shards]
        self.directory: tuple[str, list] = ("", [])
        self.block: tuple[tuple[str, int], list] = (("", -1), [])

    def _blocks(self, shard: int) -> list:
        _, _, name, offset, length = self.shards[shard]
        if self.directory[0] != name:
            self.directory = name, [tuple(x) for x in json.loads(zlib.decompress(self.files.read(name, offset, length)))]
        return self.directory[1]

    def _lines(self, shard: int, at: int) -> list:
        name = self.shards[shard][2]
        if self.block[0] != (name, at):
            _, _, offset, length = self._blocks(shard)[at]
            self.block = (name, at), [tuple(json.loads(x)) for x in zlib.decompress(self.files.read(name, offset, length)).decode().split("\n")]
        return self.block[1]

    def find(self, key: str, page: int | None = None) -> Iterator[tuple]:
        """Index lines (URL key, page, archive, offset, length) of a URL key, or of one page of it."""
        low = (key, page if page is not None else -(2**63))
        shard = max(bisect.bisect_left(self.first, low) - 1, 0)
        at = None
        while shard < len(self.shards):
            blocks = self._blocks(shard)
            at = max(bisect.bisect_left([b[:2] for b in blocks], low) - 1, 0) if at is None else 0
            for b in range(at, len(blocks)):
                if tuple(blocks[b][:2]) > (key, page if page is not None else 2**63):
                    return
                lines = self._lines(shard, b)
                for i in range(bisect.bisect_left([x[:2] for x in lines], low), len(lines)):
                    if lines[i][0] != key or page is not None and lines[i][1] != page:
                        return
                    yield lines[i]
            shard += 1

    def record(self, line: tuple) -> tuple[dict[str, str], dict[str, str], bytes]:
        return parse(zlib.decompress(self.files.read(*line[2:5]), 31))


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = LEAST_BYTES, folder: str | None = None) -> Captures:
    """Writes the pages' records and their index."""
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    rows = pages.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("html"))
    prints = publish(rows.select("id", F.unhex(F.sha1("html")).alias("digest"), F.octet_length("html").alias("size")), "warc-digests")
    first = prints.where(F.col("size") >= least_bytes).groupBy("digest", "size").agg(F.min(F.when(F.col("id") != NO_ID, F.col("id"))).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = publish(prints.join(first, ["digest", "size"]).where("id <> first").select(F.col("id").alias("own"), "digest", "first").distinct(), "warc-revisits")
    told = rows.withColumn("digest", F.unhex(F.sha1("html"))).alias("r").join(again.alias("a"), (F.col("r.id") == F.col("a.own")) & (F.col("r.digest") == F.col("a.digest")), "left")
    lines = publish(told.select("id", "url", surt(F.col("url")).alias("surt"), "html", "first").mapInArrow(_write(folder, ARCHIVE_BYTES), _SCHEMA), "warc-lines")
    ordered = lines.repartitionByRange("surt", "id").sortWithinPartitions("surt", "id", "archive", "offset")
    shards = publish(ordered.mapInArrow(_write_index(folder, BLOCK_LINES), "surt string, id long, name string, offset long, length long"), "warc-shards")
    return Captures(folder, sorted(tuple(r) for r in shards.collect()), lines.agg(F.sum("length")).first()[0] or 0)  # shards: one row a task


def lookup(captures: Captures, wanted: DataFrame) -> DataFrame:
    """Records of the wanted (surt, id) rows; a null id asks for all pages of a URL key, NO_ID for those without one.

    Returns (id, url, record_type, refers_to, payload_bytes, payload_digest, payload); payload is null for revisits.
    """
    schema = pa.schema([("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(captures)
        for batch in batches:
            rows, held = [], 0
            for key, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for line in reader.find(key, page):
                    fields, http, payload = reader.record(line)
                    number = lambda name: int(page) if (page := fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")) else None
                    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                    if kind == "response" and digest32(payload) != digest:
                        raise ValueError(f"{line[2]} at {line[3]}: the payload does not have its digest")
                    rows.append((number("WARC-Record-ID"), fields["WARC-Target-URI"], kind, number("WARC-Refers-To"), int(http["Content-Length"]), digest, payload if kind == "response" else None))
                    held += len(payload)
                    if held > 8_000_000:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
                        rows, held = [], 0
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)

    # by what the tasks will read, not by the size of the keys
    tasks = max(2 * wanted.sparkSession.sparkContext.defaultParallelism, captures.record_bytes // READ_BYTES)
    ordered = wanted.select("surt", F.col("id").cast("long").alias("id")).distinct().repartitionByRange(tasks, "surt", "id").sortWithinPartitions("surt", "id")
    return ordered.mapInArrow(run, "id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary")


def op6_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages and reads each back through the index."""
    pages = table(spark, sf_dir, "pages")
    captures = archive(pages)
    found = lookup(captures, pages.select(surt(F.col("url")).alias("surt"), F.coalesce("page_id", F.lit(NO_ID)).alias("id")))
    return found.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


#: DuckDB has no base32: five bits at a time of the digest's binary digits.
OP6_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), f AS (
  SELECT h, payload_bytes, min(page_id) AS first FROM p GROUP BY ALL
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    (CAST('0x' || substr(h || '00', 1 + CAST(floor(i * 5 / 4) AS BIGINT), 2) AS BIGINT) >> (3 - CAST((i * 5) % 4 AS INTEGER))) & 31 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN f USING (h, payload_bytes)
"""
