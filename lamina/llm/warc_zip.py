"""WARC archives packaged as ZIP files, written by tasks and read back by range, without extraction.

Each archive is a ZIP of stored (uncompressed) members: archive/data.warc.gz, in which each record is
a gzip member of its own, and indexes/index.cdxj, a line for each record with its offset and length
there. The reader finds the end-of-central-directory record (through the ZIP64 locator where there
is one), parses the central directory, takes the place of each stored member from its local header,
and reads index and records by range.

Pages with equal payloads of at least `least` bytes are one response, that with the smallest page_id,
and revisits of it. Null html is empty, long html is one payload in a task's memory, and an empty table gives no archives and no rows. Pages without a page_id are responses of their own, and rows
that share the smallest page_id all are. Null urls become urn:page:<page_id>. Columns beyond
page_id, url and html are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm import _common as C

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: A task starts a new archive beyond so many bytes, so the largest to read back stays bounded.
ARCHIVE_BYTES = 32 << 20
#: Neighbouring records are fetched together, up to so many bytes.
FETCH_BYTES = 4 << 20
LEAST_PAYLOAD = 100
#: What Arrow calls the schemes of Spark's readers; others have one name in both.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs"}
DATE = "1970-01-01T00:00:00Z"


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """A WARC/1.1 response, or a revisit that carries no payload."""
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE), ("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%-._~") if url else f"urn:page:{page_id}")]
    if page_id is not None:
        head.append(("WARC-Page-Id", str(page_id)))
    head += [("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Payload-Length", str(len(payload)))]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is None:
        block = http + payload
    else:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(refers_to)), ("WARC-Refers-To-Page-Id", str(refers_to))]
        block = http
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """The headers and the block of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    size = int(headers["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return headers, rest[:size]


def classify(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """page_id, url, html, payload_digest and refers_to (null for responses)."""
    base = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).withColumn("payload_digest", F.sha2(F.col("html").cast("binary"), 256))
    shared = base.where((F.octet_length("html") >= least) & F.col("page_id").isNotNull()).groupBy("payload_digest").agg(F.min("page_id").alias("__first"), F.max("page_id").alias("__last")).where("__first < __last").drop("__last")
    revisit = (F.octet_length("html") >= least) & (F.col("page_id") != F.col("__first"))
    return base.join(shared, "payload_digest", "left").select("page_id", "url", "html", "payload_digest", F.when(revisit, F.col("__first")).alias("refers_to"))


def write(classified: DataFrame, directory: str) -> DataFrame:
    """Writes archives into the directory; a row for each: path, n_records, n_bytes.

    Names are unique to the attempt, and only the rows of tasks that ended well name archives, so
    what a lost executor leaves is never read. Save the result before using it twice.
    """
    C.prepare(classified.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in C.slices(batches):
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                archive = archive or _Writer(directory)
                archive.add(*row)
                if archive.size >= ARCHIVE_BYTES:
                    yield archive.close()
                    archive = None
        if archive:
            yield archive.close()

    return classified.select("page_id", "url", "html", "payload_digest", "refers_to").mapInArrow(run, "path string, n_records bigint, n_bytes bigint")


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and path of an archive: local folders that all executors share, hdfs, and object stores
    by the schemes that Spark's readers know them under."""
    scheme, _, rest = uri.partition("://")
    return pyarrow.fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}" if rest else uri)


class _Writer:
    def __init__(self, directory: str):
        self.uri = f"{directory}/{uuid.uuid4().hex}.zip"
        fs, path = file_system(self.uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = fs.open_output_stream(path)
        self.zip = zipfile.ZipFile(_Forward(self.out), "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.size, self.index = 0, []

    def add(self, page_id, url, html: str, digest: str, refers_to) -> None:
        raw = gzip.compress(record(page_id, url, html.encode(), digest, refers_to), 1, mtime=0)
        self.index.append(json.dumps({"page_id": page_id, "offset": self.size, "length": len(raw)}))
        self.member.write(raw)
        self.size += len(raw)

    def close(self) -> pa.RecordBatch:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.index))
        self.zip.close()
        size = self.out.tell()
        self.out.close()
        return pa.RecordBatch.from_pydict({"path": [self.uri], "n_records": [len(self.index)], "n_bytes": [size]})


class _Forward(io.RawIOBase):
    """A stream that can't seek, as object stores have."""

    def __init__(self, out):
        self.out = out

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        return self.out.write(bytes(data))

    def tell(self) -> int:
        raise OSError("no position")


def directory(read, size: int) -> dict[str, tuple[int, int]]:
    """Where the bytes of each stored member begin, and how many there are. read(offset, n) gives
    bytes of the archive, which has `size`."""
    tail_at = max(0, size - 65_557)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("not a ZIP archive: no end of central directory")
    entries, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
    if 0xFFFF in (entries,) or 0xFFFFFFFF in (length, start):
        locator = read(tail_at + at - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("the ZIP64 locator is missing")
        end = read(struct.unpack("<Q", locator[8:16])[0], 56)
        if end[:4] != b"PK\x06\x06":
            raise ValueError("the ZIP64 end of central directory is missing")
        entries, length, start = struct.unpack("<QQQ", end[32:56])
    raw, at, out = read(start, length), 0, {}
    for _ in range(entries):
        if raw[at : at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is broken")
        flags, method = struct.unpack("<HH", raw[at + 8 : at + 12])
        packed, full, names, extras, comments = struct.unpack("<IIHHH", raw[at + 20 : at + 34])
        local = struct.unpack("<I", raw[at + 42 : at + 46])[0]
        name = raw[at + 46 : at + 46 + names].decode("utf-8" if flags & 0x800 else "cp437")
        extra, x = raw[at + 46 + names : at + 46 + names + extras], 0
        while x + 4 <= len(extra):
            kind, n = struct.unpack("<HH", extra[x : x + 4])
            if kind == 1:  # 64-bit values of those that are all ones, in this order
                values = iter(struct.unpack(f"<{n // 8}Q", extra[x + 4 : x + 4 + n // 8 * 8]))
                full = next(values) if full == 0xFFFFFFFF else full
                packed = next(values) if packed == 0xFFFFFFFF else packed
                local = next(values) if local == 0xFFFFFFFF else local
            x += 4 + n
        if method == 0 and not name.endswith("/"):
            own = read(local, 30)
            if own[:4] != b"PK\x03\x04":
                raise ValueError("a local header is broken")
            out[name] = local + 30 + sum(struct.unpack("<HH", own[26:30])), packed
        at += 46 + names + extras + comments
    return out


def records(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive in the order of its index, by ranges of its file."""
    fs, path = file_system(uri)
    with fs.open_input_file(path) as file:
        found = directory(lambda at, n: file.read_at(n, at), file.size())
        data_at, data_size = found[DATA]
        index_at, index_size = found[INDEX]
        lines = [json.loads(x) for x in file.read_at(index_size, index_at).decode().splitlines()]
        k = 0
        while k < len(lines):
            first, end, m = lines[k]["offset"], lines[k]["offset"] + lines[k]["length"], k + 1
            while m < len(lines) and lines[m]["offset"] == end and end - first < FETCH_BYTES:
                end, m = end + lines[m]["length"], m + 1
            if end > data_size:
                raise ValueError("the index goes beyond the data")
            raw = file.read_at(end - first, data_at + first)
            for x in lines[k:m]:
                yield parse(zlib.decompress(raw[x["offset"] - first : x["offset"] - first + x["length"]], 31))
            k = m


RECORDS = T.StructType([T.StructField(n, t) for n, t in (("page_id", T.LongType()), ("payload_bytes", T.LongType()), ("payload_digest", T.StringType()), ("record_type", T.StringType()), ("refers_to", T.LongType()), ("url", T.StringType()), ("payload", T.BinaryType()))])


def read(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """A row for each record of the archives in column path. A response's length and digest are of
    the payload as read, which must agree with its headers; a revisit's are those of its headers.
    payload is null unless asked for, and for revisits."""
    C.prepare(archives.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows, size = [], 0
                for headers, block in records(uri):
                    kind, digest, length = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:"), int(headers["WARC-Payload-Length"])
                    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    if payload is not None and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"a payload of {uri} differs from its digest")
                    number = lambda name: int(headers[name]) if name in headers else None  # noqa: B023, E731
                    rows.append((number("WARC-Page-Id"), length, digest, kind, number("WARC-Refers-To-Page-Id"), headers["WARC-Target-URI"], payload if payloads else None))
                    size += len(block) if payloads else 100
                    if size >= FETCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
                yield _batch(rows)

    return archives.select("path").mapInArrow(run, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=RECORDS.names)


def round_trip(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    spark = pages.sparkSession
    scratch = C.Scratch(spark, "warc")
    archives = scratch.save(write(classify(pages, least), scratch.path("archives")), "manifest")
    # the manifest is small, so its rows would all be read by one task
    return read(archives.repartition(max(1, min(archives.count(), 4 * spark.sparkContext.defaultParallelism)), "path"))


def op8_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(C.table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP8_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
f AS (SELECT h, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d.h AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM d LEFT JOIN f USING (h)
"""
