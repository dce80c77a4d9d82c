"""WARC records in seekable Zstandard bundles.

Records are gathered into frames of about FRAME bytes, each compressed on its own; a bundle ends with a seek table in a
skippable frame (sizes of all frames, their number, the seekable magic number). An index maps each record to its bundle, its
frame, and its offset in the frame's plain bytes, so that one record costs one seek and one frame.

A payload that several records share is stored once: the record with the smallest id is the response, the others are revisits
that name it. Only digests and ids are grouped; records meet the ids of shared payloads by digest and one of SALTS salts, so
that a payload of a third of all records is dealt over many tasks, and skewed joins split it further.

Bundles are written by tasks to a folder that all executors share, through pyarrow's file systems, under a name of the task
attempt's own. The index is a committed Parquet table and names only bundles of attempts that succeeded, so that lost
executors leave unread files at worst.

Null html is an empty payload, a null url an empty one; control characters in urls are percent-encoded. Rows that repeat an
id: those with a payload's smallest id are all responses. Null ids: revisits if an id shares the payload, else responses.
Long payloads make long frames; a row holds less than 2 GiB, so that frame sizes fit the 32 bits of the seek table. No rows in, no rows out.
"""

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voicegrid.llm.common import shared_dir, table

FRAME, BUNDLE, LEVEL, SALTS = 1 << 18, 1 << 28, 3, 16
DATE = "2000-01-01T00:00:00Z"

# Numbers of the seekable format and of the WARC revisit profile.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "bundle string, page_id long, frame int, offset long, length long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def of_urn(x: str | None) -> int | None:
    return None if x is None or x.endswith(":null>") else int(x[len("<urn:page:") : -1])


def record(page_id: int | None, url: str, payload: bytes, digest: str, first: int | None) -> bytes:
    """One WARC record; a revisit, without its payload, if `first` is another record's id."""
    revisit = first is not None and first != page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {urn(page_id)}", f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + "".join(c if ord(c) > 32 and ord(c) != 127 else f"%{ord(c):02X}" for c in url),
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: {urn(first)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record in a frame's plain bytes."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
        start, n = end + 4, int(head["Content-Length"])
        yield head, data[start : start + n]
        at = start + n + 4


class BundleWriter:
    """Writes records to one bundle."""

    def __init__(self, out, level: int = LEVEL, frame: int = FRAME):
        self.out, self.frame, self.sizes, self.written = out, frame, [], 0
        self.packer, self.plain = zstandard.ZstdCompressor(level=level, write_content_size=True), bytearray()
        self.add(f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: 18\r\n\r\nformat: WARC/1.1\r\n\r\n\r\n".encode())

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame number and offset of the record."""
        if self.plain and len(self.plain) + len(data) > self.frame:
            self.flush()
        at = len(self.sizes), len(self.plain)
        self.plain += data
        return at

    def flush(self) -> None:
        if self.plain:
            packed = self.packer.compress(bytes(self.plain))
            self.out.write(packed)
            self.sizes.append((len(packed), len(self.plain)))
            self.written += len(packed)
            self.plain.clear()

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()


class BundleReader:
    """Reads frames of one bundle by its seek table."""

    def __init__(self, file):
        self.file, size = file, file.size() if hasattr(file, "size") else file.seek(0, io.SEEK_END)
        file.seek(size - 9)
        n, _, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("no seek table")
        file.seek(size - 9 - 8 * n)
        flat = struct.unpack(f"<{2 * n}I", file.read(8 * n))
        self.sizes, self.starts, at = list(zip(flat[::2], flat[1::2])), [], 0
        for packed, _ in self.sizes:
            self.starts.append(at)
            at += packed

    def frame(self, i: int) -> bytes:
        self.file.seek(self.starts[i])
        return zstandard.ZstdDecompressor().decompress(self.file.read(self.sizes[i][0]), max_output_size=self.sizes[i][1])


def write(pages: DataFrame, to: str, least: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Bundles and their index under the folder `to`. Payloads under `least` bytes are always responses."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), payload.alias("payload"), F.unhex(F.sha1(payload)).alias("digest"))
    shared = rows.filter(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    shared = shared.select(F.col("digest").alias("_d"), "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    known = salted.join(shared.hint("shuffle_hash"), (salted["digest"] == shared["_d"]) & (salted["salt"] == shared["_s"]) & (F.octet_length("payload") >= least), "left")

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, store, root = TaskContext.get(), *fs.FileSystem.from_uri(to)
        names, writer, n = f"{task.partitionId():06d}-{task.taskAttemptId()}", None, 0
        for batch in batches:
            index: list[tuple] = []
            for page_id, url, data, digest, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "first")), strict=True):
                if writer is None:
                    name, n = f"{names}-{n:04d}.warc.zst", n + 1
                    writer = BundleWriter(store.open_output_stream(f"{root}/bundles/{name}", compression=None))
                made = record(page_id, url, data, base64.b32encode(digest).decode(), first)
                index.append((name, page_id, *writer.add(made), len(made)))
                if writer.written >= BUNDLE:
                    writer.close()
                    writer = None
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*index) if index else [[]] * 5, (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["bundle", "page_id", "frame", "offset", "length"])
        if writer:
            writer.close()

    store, root = fs.FileSystem.from_uri(to)
    store.create_dir(f"{root}/bundles", recursive=True)
    known.select("page_id", "url", "payload", "digest", "first").mapInArrow(bundles, INDEX).write.mode("overwrite").parquet(f"{to}/index")


def index(spark: SparkSession, at: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{at}/index")


def frames(spark: SparkSession, at: str, entries: DataFrame | None = None) -> DataFrame:
    """Each frame that holds some of the index entries (all of them by default), with the offsets of those entries.

    Frames are dealt by a hash other than that of the grouping, else the deal would be left out and small tables merged into one task.
    """
    return (index(spark, at) if entries is None else entries).groupBy("bundle", "frame").agg(F.collect_set("offset").alias("offsets")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.hash("bundle", "frame"))


def read(spark: SparkSession, at: str, entries: DataFrame | None = None) -> DataFrame:
    """Records of the archive with what their headers say, and the payload of responses. Digests of payloads are verified.

    `entries`, rows of the index, picks records; each of their frames is read once.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(at)
        name, reader = None, None
        for batch in batches:
            for bundle, frame, offsets in sorted(zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "offsets")), strict=True)):
                if bundle != name:
                    name, reader = bundle, BundleReader(store.open_input_file(f"{root}/bundles/{bundle}"))
                plain, out = reader.frame(frame), []
                for offset in sorted(offsets):
                    head, block = next(parse(memoryview(plain)[offset:].tobytes() if offset else plain))
                    http, _, body = block.partition(b"\r\n\r\n")
                    n, digest = int(http.rpartition(b": ")[2]), head["WARC-Payload-Digest"].removeprefix("sha1:")
                    response = head["WARC-Type"] == "response"
                    if response and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                        raise ValueError(f"{bundle}, frame {frame}, offset {offset}: the payload has another digest")
                    out.append((of_urn(head["WARC-Record-ID"]), n, digest, head["WARC-Type"], of_urn(head.get("WARC-Refers-To")), head["WARC-Target-URI"], body if response else None))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()), strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"])

    return frames(spark, at, entries).mapInArrow(records, f"{RECORDS}, url string, payload binary")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = f"{shared_dir(spark)}/warc-{uuid.uuid4()}"
    write(table(spark, sf_dir, "pages"), at)
    return read(spark, at).drop("url", "payload")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS x FROM pages),
h AS (SELECT page_id, strlen(x) AS payload_bytes, sha1(x) AS hex FROM p),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (((('0x' || substr(hex, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest FROM h),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS f FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS NOT DISTINCT FROM f THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM f THEN f END AS refers_to FROM f
"""
