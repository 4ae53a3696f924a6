"""WARC archives through Spark's own sink, and their capture index by external merge.

Records are values of a text table, so Spark's output commit covers lost executors, on any file system. Each is a gzip member of its
own: a member with headers and block, then a constant one with the line breaks that end a record, which is the table's line separator. So a file is an
ordinary compressed archive that begins with a warcinfo record and that a reader can enter at any record, and Spark can split it.
Where a record stands in its file is kept in its member's header. The index of captures is sorted run by run; a range partition then
merges its parts of all runs with a loser tree, and each entry names file, offset and length.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.llm.common import batch, shared_path, table, text_bytes

#: Captures have no time of their own; record n is dated n seconds after this.
EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)
#: Rows of the index that one range holds, on average.
RANGE_ROWS = 100_000


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """The URL with its host's labels reversed, lower-cased, without scheme, www., default port and fragment; a null or broken one sorts first."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.strip().lower()
    labels = re.sub(r"^www\d*\.", "", host.lower()).split(".")
    shown = f":{port}" if port and port not in (80, 443) else ""
    return f"{','.join(reversed(labels))}{shown}){parts.path or '/'}{'?' + parts.query if parts.query else ''}".lower()


#: A gzip member's first bytes with an extra field of 20 bytes (RFC 1952), and the name of our entry in it.
_HEAD, _EXTRA = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff", b"RO\x10\0"


def member(data: bytes, at: int) -> bytes:
    """A gzip member of data that keeps in its header where it starts in its file and how long it is."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush() + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    return _HEAD + struct.pack("<H", 20) + _EXTRA + struct.pack("<QQ", at, len(body) + 32) + body


def opened(data: bytes) -> tuple[bytes, int, int]:
    """What a member holds, its place and its length; a member that is cut short or broken raises."""
    if data[:10] != _HEAD or data[12:16] != _EXTRA:
        raise ValueError("no member of these archives")
    at, size = struct.unpack("<QQ", data[16:32])
    return zlib.decompress(data, 31), at, size


def _ending() -> bytes:
    deflate = zlib.compressobj(9, zlib.DEFLATED, -15)
    data = b"\r\n\r\n"
    return b"\x1f\x8b\x08\0\0\0\0\0\x02\xff" + deflate.compress(data) + deflate.flush() + struct.pack("<II", zlib.crc32(data), len(data))


#: The member that ends each record. Compressed data holds its 24 bytes by a chance that can be left out; a reader would notice, since the member before it would be cut short.
ENDING = _ending()


def _date(at: int) -> str:
    """The time of record `at`, that many seconds after EPOCH; beyond what four digits of a year allow the last second there is."""
    most = int((datetime(9999, 12, 31, 23, 59, 59, tzinfo=timezone.utc) - EPOCH).total_seconds())
    least = -int((EPOCH - datetime(1, 1, 1, tzinfo=timezone.utc)).total_seconds())
    moment = EPOCH + timedelta(seconds=max(least, min(at, most)))
    return f"{moment.year:04d}-{moment:%m-%dT%H:%M:%SZ}"


def _info(task: int) -> bytes:
    block = b"software: itemforge\r\nformat: WARC File Format 1.1\r\n"
    return f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:archive:{task}>\r\nWARC-Date: {_date(0)}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block


def _record(page: int, url: str | None, payload: bytes, refers: int | None) -> bytes:
    """A record's headers and its block; a revisit has no payload and names its response's record and date."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Date: {_date(page)}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
    ]
    if refers is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers}>", f"WARC-Refers-To-Date: {_date(refers)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Payload-Length: {len(payload)}"]
    block = payload if refers is None else b""
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block


def write_archives(pages: DataFrame, path: str, least_revisit: int = 0, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write a record for each page under path.

    Of pages with equal payloads of at least least_revisit bytes, the smallest key is the response and the others revisit
    it. Null html is an empty payload, a null URL an empty target; rows with a null key have no record. A key that occurs several times has as many records; those
    whose payload its smallest holder shares are responses all, since none can revisit itself. Digests, not payloads, meet to find revisits; then records are dealt by
    key and digest, so a payload that a third of all pages share is spread over all files. Other columns, whatever their names, are not read.
    """
    held = pages.filter(F.col(key).isNotNull())
    bare = held.select(F.col(key).cast("long").alias("page"), F.col(url).alias("url"), text_bytes(html).alias("payload")).withColumn("digest", F.sha2("payload", 256))
    keys = bare.select("page", "digest", F.length("payload").alias("size"))
    first = keys.groupBy("digest").agg(F.min("page").alias("first"))
    again = keys.filter(F.col("size") >= least_revisit).join(first, "digest").filter("page <> first").select("page", "digest", "first").distinct()
    dealt = bare.join(again, ["page", "digest"], "left")
    schema = pa.schema([("value", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = 0
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            for k in range(0, b.num_rows, 500):
                out = []
                if not at:
                    out.append(member(_info(TaskContext.get().partitionId()), 0))
                    at = len(out[0]) + len(ENDING)
                for row in zip(*(c[k : k + 500] for c in cols), strict=True):
                    out.append(member(_record(*row), at))
                    at += len(out[-1]) + len(ENDING)
                yield batch({"value": out}, schema)

    # One task writes one file, so lengths so far are places in it.
    records = dealt.select("page", "url", "payload", F.col("first").alias("refers")).mapInArrow(run, "value binary")
    records.select(F.col("value").cast("string")).write.option("encoding", "ISO-8859-1").option("lineSep", ENDING.decode("latin-1")).option("maxRecordsPerFile", 0).text(path)


_HEADER = re.compile(rb"([\w-]+): ([^\r\n]*)\r\n")


def parsed(record: bytes) -> tuple | None:
    """(page_id, url, date, record_type, payload_digest, payload_bytes, refers_to, payload) of a record; None for a warcinfo.

    A response's digest and length are those of the block that was read; a difference from its header raises.
    """
    head, _, rest = record.partition(b"\r\n\r\n")
    h = {k.decode(): v.decode() for k, v in _HEADER.findall(head + b"\r\n")}
    if h["WARC-Type"] == "warcinfo":
        return None
    block = rest[: int(h["Content-Length"])]
    if len(block) != int(h["Content-Length"]):
        raise ValueError(f"{h['WARC-Record-ID']} is cut short")
    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
    page = int(h["WARC-Record-ID"][len("<urn:page:") : -1])
    if h["WARC-Type"] == "revisit":
        return page, h["WARC-Target-URI"], h["WARC-Date"], "revisit", digest, int(h["X-Payload-Length"]), int(h["WARC-Refers-To"][len("<urn:page:") : -1]), None
    if sha1_base32(block) != digest:
        raise ValueError(f"{h['WARC-Record-ID']} differs from its digest")
    return page, h["WARC-Target-URI"], h["WARC-Date"], "response", digest, len(block), None, block


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """(page_id, url, date, record_type, payload_digest, payload_bytes, refers_to, payload binary, file, offset, length) of every record under path; see parsed."""
    lines = spark.read.option("encoding", "ISO-8859-1").option("lineSep", ENDING.decode("latin-1")).text(path)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 500):
                rows = []
                for x, file in zip(b.column(0)[k : k + 500].to_pylist(), b.column(1)[k : k + 500].to_pylist(), strict=True):
                    data, at, size = opened(x)
                    if size != len(x):
                        raise ValueError(f"a member of {file} at {at} is cut short")
                    if row := parsed(data):
                        rows.append((*row[:7], row[7] if payloads else None, file, at, size + len(ENDING)))
                if rows:
                    yield batch(dict(zip(schema.names, map(list, zip(*rows, strict=True)), strict=True)), schema)

    kinds = "page_id long, url string, date string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary, file string, offset long, length long"
    return lines.select(F.col("value").cast("binary"), F.col("_metadata.file_path")).mapInArrow(run, kinds)


class LoserTree:
    """Merges sorted iterators: each inner node holds the loser of its match, so the next row costs one path to the root."""

    def __init__(self, runs: list[Iterator[tuple]]) -> None:
        self.runs = runs
        self.n = max(1, len(runs))
        self.heads: list[tuple | None] = [next(r, None) for r in runs] or [None]
        self.losers = [-1] * self.n
        for k in range(self.n):
            self._play(k)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x, a) <= (y, b))

    def _play(self, winner: int) -> None:
        """Carry run `winner` towards the root; a free node keeps it until another run arrives."""
        node = (winner + self.n) // 2
        while node:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = winner
                return
            if self._less(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while (row := self.heads[k := self.losers[0]]) is not None:
            yield row
            self.heads[k] = next(self.runs[k], None)
            self._play(k)


def sorted_runs(captures: DataFrame, path: str) -> DataFrame:
    """Write the captures' index entries as runs, each sorted by URL key, time and page, and read them: (urlkey, date, page_id, record_type, payload_digest, run, seq)."""
    spark = captures.sparkSession
    schema = pa.schema([("urlkey", pa.string()), ("date", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("run", pa.int64()), ("seq", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, k = TaskContext.get().partitionId(), 0
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            rows = sorted(((url_key(u), d, p, *rest) for u, d, p, *rest in zip(*cols, strict=True)), key=lambda r: r[:3])
            yield batch(dict(zip(schema.names, [*map(list, zip(*rows, strict=True)), [task << 32 | k] * len(rows), range(len(rows))], strict=True)), schema)
            k += 1

    kinds = "urlkey string, date string, page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long, file string, offset long, length long, run long, seq long"
    captures.select("url", "date", "page_id", "record_type", "payload_digest", "payload_bytes", "refers_to", "file", "offset", "length").mapInArrow(run, kinds).write.parquet(path)
    return spark.read.schema(kinds).parquet(path)


def merged_index(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The runs as one history in the order of URL key, time and page: partitions are ranges, history_range and history_at say where a capture stands.

    A range holds about range_rows entries whatever one host or URL has, since the page is part of the order, so a task holds that many and no more. Spark's
    external sort brings the parts of each run together, in order; within a range they meet in a loser tree, and no entry is sorted again.
    """
    n = max(1, -(-runs.count() // range_rows))
    n = max(n, runs.sparkSession.sparkContext.defaultParallelism)
    dealt = runs.repartitionByRange(n, "urlkey", "date", "page_id").sortWithinPartitions("run", "seq")
    names = [f.name for f in runs.schema.fields if f.name not in ("run", "seq")]
    source = runs.columns
    kinds = "urlkey string, date string, page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long, file string, offset long, length long, history_range int, history_at long"
    schema = pa.schema([("urlkey", pa.string()), ("date", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("history_range", pa.int32()), ("history_at", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, parts, last = TaskContext.get().partitionId(), [], None
        for b in batches:
            cols = {c: b.column(i).to_pylist() for i, c in enumerate(source)}
            for r, *row in zip(cols["run"], *(cols[c] for c in names), strict=True):
                if r != last:
                    parts.append([])
                    last = r
                parts[-1].append(tuple(row))
        out, at = [], 0
        for row in LoserTree([iter(((r[0], r[1], r[2]), r) for r in rows) for rows in parts]):
            out.append((*row[1], task, at))
            at += 1
            if len(out) == 5000:
                yield batch(dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True)), schema)
                out = []
        if out:
            yield batch(dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True)), schema)

    return dealt.mapInArrow(run, kinds)


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written, read back, and merged into one history of captures that says where each record stands."""
    path = shared_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    runs = sorted_runs(read_archives(spark, path, payloads=False), shared_path(spark, "cdx-runs"))
    return merged_index(runs).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "date", "file", "offset", "length", "history_range", "history_at")
