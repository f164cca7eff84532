"""WARC: deterministic sharded writer, and a reader of what it wrote.

Records are dealt to shards by ranges of their id and a hash of their payload
(:func:`range_shards`), sorted inside a shard and written as one gzip member each. A file is rolled
when its compressed size passes ``file_bytes``. Headers are written anew:
record id (from the page id), target, date (fixed parameter), lengths, and
SHA-1 digests of payload and block. Of records with equal payloads of at
least ``min_revisit`` bytes the one with the largest id is the response, the
others are revisits that refer to it and have no payload. A file has a
temporary name until it is complete; the manifest table in the shared folder
lists the files that count and how many records they hold, which the reader
checks. Equal inputs give equal files byte for byte, so a file that a second
attempt of a task finds complete stays.

Nulls: a null payload is empty, a null url is written as an empty target, a
null id sorts first and keeps its own record without being referred to.
Rows with equal id and payload are written once each; the response is then
the id, and further rows of that id are responses too. An empty table gives
no files. Other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.session import materialize

from .common import commit_file, filesystem, range_shards, shared_folder, workers_import

SHARD_BYTES = 16 << 20
FILE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
MANIFEST = "shard int, part int, path string, n_records long, n_bytes long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, salt: str = "") -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}{salt}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One uncompressed record. A revisit keeps the headers of its payload but not the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    target = "".join(c for c in (url or "") if c not in "\r\n")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("X-Page-Id", "" if page_id is None else str(page_id)),
        ("X-Payload-Length", str(len(payload))),
    ]
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page-Id", str(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


class Archive:
    """Writes one file under a temporary name; ``close`` commits it."""

    def __init__(self, folder: str, name: str):
        self.fs, base = filesystem(folder)
        self.fs.create_dir(base, recursive=True)
        self.path, self.final, self.temp = f"{folder}/{name}", f"{base}/{name}", f"{base}/_{name}.{uuid.uuid4().hex}"
        self.out, self.size, self.n = self.fs.open_output_stream(self.temp), 0, 0

    def add(self, data: bytes) -> None:
        member = gzip.compress(data, 6, mtime=0)
        self.out.write(member)
        self.size += len(member)
        self.n += 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        commit_file(self.fs, self.temp, self.final)
        return self.path, self.n, self.size


def _writer(folder: str, file_bytes: int, date: str):
    """Rows come sorted by shard and id; the notes of an id (payload digest in ``url``, refers_to) come before its records."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])
        archive, shard, part, rows, noted, notes = None, None, 0, [], None, {}
        for batch in batches:
            html = batch.column(4)
            for k, (s, page_id, is_record, url) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)):
                if noted != page_id:
                    noted, notes = page_id, {}
                if not is_record:
                    notes[url] = batch.column(5)[k].as_py()
                    continue
                if s != shard:
                    if archive is not None:
                        rows.append((shard, part, *archive.close()))
                    archive, shard, part = None, s, 0
                elif archive is not None and archive.size >= file_bytes:
                    rows.append((shard, part, *archive.close()))
                    archive, part = None, part + 1
                if archive is None:
                    archive = Archive(folder, f"{shard:08d}-{part:04d}.warc.gz")
                payload = (html[k].as_py() or "").encode()
                refers_to = None if page_id is None else notes.get(hashlib.sha1(payload).hexdigest())
                archive.add(record(page_id, url, payload, digest(payload), refers_to, date))
        if archive is not None:
            rows.append((shard, part, *archive.close()))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], schema.types[i]) for i in range(len(schema))], schema=schema)

    return write


def write_warc(pages: DataFrame, folder: str | None = None, min_revisit: int = 0, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, date: str = DATE) -> DataFrame:
    """Write ``pages`` (page_id, url, html) and return the committed manifest, one row per file.

    Equal payloads are found by digest and length over ids alone, summed up
    before they meet, so a payload that a third of all pages share is one row
    per task. What a revisit refers to travels as a lean row of its own with
    the page's range, and the payloads are shuffled once.
    """
    spark = pages.sparkSession
    workers_import(spark)
    folder = folder or shared_folder(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    sums = materialize(rows.where("page_id is not null").select("page_id", F.sha1(F.col("html").cast("binary")).alias("sha"), F.octet_length("html").alias("n")).where(F.col("n") >= min_revisit), "warc-digests")
    last = sums.groupBy("sha", "n").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("_first")).where("_first <> refers_to").drop("_first")
    notes = sums.join(last, ["sha", "n"]).where("page_id <> refers_to")
    none = F.lit(None)
    both = rows.select("page_id", F.lit(True).alias("is_record"), "url", "html", none.cast("long").alias("refers_to")).unionByName(
        notes.select("page_id", F.lit(False).alias("is_record"), F.col("sha").alias("url"), none.cast("string").alias("html"), "refers_to"))
    # a note has the tie of its records, so a page's payload and what it refers to are in one shard
    sha = F.when(F.col("is_record"), F.sha1(F.col("html").cast("binary"))).otherwise(F.col("url"))
    tie = F.conv(F.substring(sha, 1, 15), 16, 10).cast("long")
    cut, shards = range_shards(both, "page_id", F.coalesce(F.octet_length("html"), F.lit(0)) + 64, shard_bytes, tie)
    cut = cut.select("shard", "page_id", tie.alias("tie"), "is_record", "url", "html", "refers_to").repartitionById(shards, F.col("shard"))
    dealt = cut.sortWithinPartitions("shard", F.asc_nulls_first("page_id"), "tie", "is_record", "url", "html", "refers_to").drop("tie")
    return materialize(dealt.mapInArrow(_writer(folder, file_bytes, date), MANIFEST), "warc-manifest")


def members(src, chunk: int = 1 << 20) -> Iterator[bytes]:
    """Uncompressed gzip members of a stream, one at a time."""
    unzip, parts, data = zlib.decompressobj(31), [], src.read(chunk)
    while data:
        parts.append(unzip.decompress(data))
        if unzip.eof:
            yield b"".join(parts)
            data, unzip, parts = unzip.unused_data, zlib.decompressobj(31), []
            if data:
                continue
        data = src.read(chunk)
    if parts:
        raise ValueError("the last member is cut off")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    return fields, rest[:int(fields["Content-Length"])]


def _reader(batches):
    for batch in batches:
        for path, n_records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            fs, at = filesystem(path)
            out = []
            with fs.open_input_stream(at, compression=None) as src:
                for data in members(src):
                    fields, block = parse(data)
                    if fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
                        raise ValueError(f"damaged record in {path}")
                    kind, sha = fields["WARC-Type"], fields["WARC-Payload-Digest"][5:]
                    size = int(fields["X-Payload-Length"])
                    if kind == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        size, sha = len(payload), digest(payload)
                    out.append((int(fields["X-Page-Id"]) if fields["X-Page-Id"] else None, fields["WARC-Target-URI"], size, sha, kind, int(fields["X-Refers-To-Page-Id"]) if kind == "revisit" else None))
            if len(out) != n_records:
                raise ValueError(f"{path} holds {len(out)} records of {n_records}")
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[i]) for i in range(6)], names=[c.split()[0] for c in RECORDS.split(", ")])


def read_warc(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Per record of the manifest's files: ``RECORDS``. Every block's digest and every file's number of records are checked."""
    workers_import(spark)
    return manifest.select("path", "n_records").repartition(max(1, manifest.count()), "path").mapInArrow(_reader, RECORDS)


ORACLE = r"""
WITH rows AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
last AS (SELECT sha, payload_bytes, max(page_id) AS last_id FROM rows WHERE page_id IS NOT NULL GROUP BY ALL)
SELECT r.page_id, regexp_replace(coalesce(r.url, ''), '[\r\n]', '', 'g') AS url, CAST(r.payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((CAST('0x' || substr(r.sha || '0', 1 + (5 * i) // 4, 2) AS INTEGER) >> (3 - (5 * i) % 4)) & 31), 1)), '') AS payload_digest,
       CASE WHEN r.page_id <> l.last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN r.page_id <> l.last_id THEN l.last_id END AS refers_to
FROM rows r LEFT JOIN last l ON r.sha = l.sha AND r.payload_bytes = l.payload_bytes AND r.page_id IS NOT NULL
"""
