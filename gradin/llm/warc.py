"""Web archives: a deterministic sharded writer, and a reader.

Records are sorted by range and written by the tasks that hold the ranges. A file ends when its
compressed size passes a bound, every record is a gzip member of its own with headers and digests
made anew from the payload, and nothing in a file depends on the clock or on chance. A file is
written under a temporary name and renamed when whole; the names of a range's files, with sizes
and digests, come back as rows, and the writer commits them as a manifest, written last. Readers
take the manifest's files alone, so what a lost or repeated task left behind is never seen.

Of records with equal payloads of a minimal size, the one with the largest id is written in
full as a response; the others are revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradin.operators.ranges import in_ranges

#: A file is closed once it has so many compressed bytes.
ROLL_AT = 32 << 20
#: Bytes of payload in a range.
RANGE_BYTES = 64 << 20
LEAST_BYTES = 1000
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, records bigint, bytes bigint, sha256 string"
_READ = 1 << 20


def store(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    if "://" in path or path.startswith("file:"):
        path = path if "://" in path else "file://" + path.removeprefix("file:")
        return pa.fs.FileSystem.from_uri(path)
    return pa.fs.LocalFileSystem(), path


def base32(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def record_id(page_id: int | None, url: str | None) -> str:
    """A name made from what the record is about, so that a rerun gives it the same one."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}')}>"


def _header_value(text: str) -> str:
    """A value on one line: line ends in it are written as in a URL."""
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record(row: dict, payload: bytes) -> bytes:
    """One WARC record; a revisit has the headers of its payload alone."""
    revisit = row["refers_to"] is not None
    sha1 = hashlib.sha1(payload).digest()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(row['page_id'], row['url'])}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_header_value(row['url'] or '')}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: {base32(sha1)}",
        f"WARC-Block-Digest: {base32(hashlib.sha1(block).digest())}",
        f"X-Page-Id: {'' if row['page_id'] is None else row['page_id']}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {record_id(row['refers_to'], row['refers_url'])}",
            f"WARC-Refers-To-Target-URI: {_header_value(row['refers_url'] or '')}",
            f"WARC-Refers-To-Date: {DATE}",
            f"X-Refers-To-Page-Id: {row['refers_to']}",
        ]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def file_record(name: str) -> bytes:
    """The record that opens a file and tells what wrote it."""
    block = b"software: gradin\r\nformat: WARC File Format 1.1\r\n"
    head = [
        "WARC/1.1",
        "WARC-Type: warcinfo",
        f"WARC-Record-ID: {record_id(None, name)}",
        f"WARC-Date: {DATE}",
        f"WARC-Filename: {name}",
        "Content-Type: application/warc-fields",
        f"WARC-Block-Digest: {base32(hashlib.sha1(block).digest())}",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)  # a gzip header without a time
    return packer.compress(data) + packer.flush()


class _Files:
    """The files of one range, each whole or absent."""

    def __init__(self, folder: str, shard: int, roll_at: int):
        self.fs, self.folder = store(folder)
        self.shard, self.roll_at, self.number = shard, roll_at, 0
        self.out = None

    def add(self, member: bytes) -> Iterator[tuple]:
        if self.out is None:
            self.name = f"records-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.folder}/_temporary/{self.name}.{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(self.temporary, compression=None)
            self.records, self.size, self.digest = 0, 0, hashlib.sha256()
            self._write(_gzip(file_record(self.name)))
        self._write(member)
        self.records += 1
        if self.size >= self.roll_at:
            yield self.close()

    def _write(self, member: bytes) -> None:
        self.out.write(member)
        self.digest.update(member)
        self.size += len(member)

    def close(self) -> tuple:
        self.out.close()
        self.out = None
        self.fs.move(self.temporary, f"{self.folder}/{self.name}")
        self.number += 1
        return self.name, self.records, self.size, self.digest.hexdigest()

    def rest(self) -> list[tuple]:
        return [] if self.out is None else [self.close()]


def write_archive(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = LEAST_BYTES,
    roll_at: int = ROLL_AT,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Write a record per row below `folder`, which must be new, and give the manifest.

    `folder` is one that all executors share. A null html is an empty payload, a null url an
    empty target. Rows are ordered by id, nulls first, and those of one id by a hash of url and payload;
    each range of that order is written by one task, and where files begin and end depends on
    the rows alone. Rows that repeat the largest id of equal payloads are responses as well; a
    null id is smaller than any, and where all ids are null all are responses. Other columns
    are not read.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("html"))
    rows = rows.withColumn("n", F.octet_length("html"))
    rows = rows.withColumn("key", F.when(F.col("n") >= least_bytes, F.sha2(F.col("html").cast("binary"), 256)))
    # of each payload the largest id; only those that occur twice have something to tell
    small = rows.where("key IS NOT NULL").select("page_id", "url", "key")
    largest = F.max(F.struct("page_id", "url"))
    originals = small.groupBy("key").agg(largest.alias("original"), F.count("*").alias("times"))
    originals = originals.where("times > 1 AND original.page_id IS NOT NULL").select("key", "original")
    # a mark tells the rows that it is sorted before what they refer to; so payloads move once
    marks = small.join(originals, "key").where(~F.col("page_id").eqNullSafe(F.col("original.page_id")))
    told = [F.col("original.page_id").alias("refers_to"), F.col("original.url").alias("refers_url")]
    marks = marks.select("page_id", "url", F.lit(None).cast("string").alias("html"), "key", *told).distinct()
    told = [F.lit(None).cast("bigint").alias("refers_to"), F.lit(None).cast("string").alias("refers_url")]
    rows = rows.select("page_id", "url", "html", "key", *told).unionByName(marks)
    rows = rows.withColumn("h", F.xxhash64("url", "key"))
    rows = rows.withColumn("n", F.coalesce(F.octet_length("html"), F.lit(0)) + 256)
    fs, path = store(folder)
    fs.create_dir(f"{path}/_temporary", recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, out, mark = None, [], None
        for batch in batches:
            for row in batch.to_pylist():
                if files is None or files.shard != row["shard"]:
                    out += files.rest() if files else []
                    files = _Files(folder, row["shard"], roll_at)
                same = row["page_id"], row["url"], row["key"]
                if row["html"] is None:
                    mark = same, row["refers_to"], row["refers_url"]
                    continue
                row["refers_to"], row["refers_url"] = mark[1:] if mark and mark[0] == same else (None, None)
                out += files.add(_gzip(record(row, row["html"].encode())))
        out += files.rest() if files else []
        names = ["file", "records", "bytes", "sha256"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        columns = list(zip(*out, strict=True)) or [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    rows = in_ranges(rows, "page_id", "h", "n", range_bytes, "shard", ["url", "key", "html"]).drop("h", "n")
    rows.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def records(data: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file of gzip members, read piece by piece."""
    unpacker, held = None, []
    for piece in data:
        while piece:
            unpacker = unpacker or zlib.decompressobj(31)
            held.append(unpacker.decompress(piece))
            piece = unpacker.unused_data
            if unpacker.eof:
                whole, unpacker, held = b"".join(held), None, []
                head, _, body = whole.partition(b"\r\n\r\n")
                lines = head.decode().split("\r\n")
                headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
                yield headers, body[: int(headers["Content-Length"])]


READ = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload binary,"
    " payload_bytes bigint, payload_digest string"
)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The records of a committed archive; of a revisit the payload is null, its length and its
    digest (lower-case hex SHA-1) are those of the full one. A record whose block or payload
    does not have its digest fails."""
    manifest = spark.read.parquet(f"{folder}/manifest").select("file")
    files = manifest.repartition(spark.sparkContext.defaultParallelism * 4, "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = store(folder)
        names = ["page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()]

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for name in batch.column("file").to_pylist():
                with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    out, size = [], 0
                    for headers, block in records(iter(lambda s=stream: s.read(_READ), b"")):
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        out.append(_row(headers, block))
                        size += len(block)
                        if size > 16 * _READ:
                            yield batch_of(out)
                            out, size = [], 0
                    if out:
                        yield batch_of(out)

    return files.mapInArrow(run, READ)


def _row(headers: dict[str, str], block: bytes) -> tuple:
    number = lambda name: int(headers[name]) if headers.get(name) else None
    if base32(hashlib.sha1(block).digest()) != headers["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {headers['WARC-Record-ID']}")
    kind, payload = headers["WARC-Type"], None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if base32(hashlib.sha1(payload).digest()) != headers["WARC-Payload-Digest"]:
            raise ValueError(f"payload digest of {headers['WARC-Record-ID']}")
    sha1 = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    length = number("X-Payload-Length")
    return number("X-Page-Id"), headers["WARC-Target-URI"], kind, number("X-Refers-To-Page-Id"), payload, length, sha1
