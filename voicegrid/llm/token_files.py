"""Token ids of documents in files of patched frame-of-reference blocks.

Documents are dealt by ranges of their ids and sorted, each task encodes its own and writes one file, so that files in the order of
their parts hold all documents in ascending order, null ids last. Ids that repeat are ordered by a hash of the text, then by place in the input; the place
also splits a crowd of equal rows over several ranges. The texts are shuffled once.

A file is a run of blocks of BLOCK ids, the last one shorter: the least id, the width, the number of exceptions and of ids; the
low `width` bits of what is above the least id, packed bit by bit (the lowest of all ids first); places of the exceptions and their high bits. The width is that of
the id at PERCENTILE of the block, what is longer becomes an exception. The footer has the start of each block, the number of blocks and of
ids, and a magic number, so that any ids are read without the blocks before them.

The table `index` names file, first id and number of ids of each document. It's committed by Spark and names only files of attempts
that succeeded; lost executors leave unread files at worst. Reading deals an index by file and segment of SEGMENT ids.

Null texts are empty; each document ends with the id END, so that none is without ids. No rows in, no rows out.
"""

import struct
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voicegrid.llm.chunks import byte_vocabulary
from voicegrid.llm.common import CLEAN, shared_dir, table
from voicegrid.llm.pieces import blocks

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
END, BLOCK, SEGMENT, PERCENTILE = 0, 4096, 1 << 20, 97
HEAD, FOOT, MAGIC = struct.Struct("<IBHH"), struct.Struct("<QQQ"), 0x3152464F50
INDEX = "part int, file string, doc_id long, first long, n_tokens long"


def pack(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """One block of at most 65,535 ids."""
    low = int(ids.min())
    above = ids.astype(np.uint32) - np.uint32(low)
    nth = max(-(-percentile * len(ids) // 100) - 1, 0)
    width = int(np.partition(above, nth)[nth]).bit_length()
    least = above.astype(np.uint16) if width <= 16 else above
    planes = b"".join(np.packbits((least >> k & 1).astype(bool), bitorder="little").tobytes() for k in range(width))
    places = np.flatnonzero(above >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    high = above[places] >> np.uint32(width) if width < 32 else above[places]
    return HEAD.pack(low, width, len(places), len(ids)) + planes + places.astype("<u2").tobytes() + high.astype("<u4").tobytes()


def unpack(data: memoryview | bytes) -> np.ndarray:
    """The ids of a block."""
    low, width, exceptions, n = HEAD.unpack_from(data)
    at, one = HEAD.size, (n + 7) // 8
    size, above = one * width, np.zeros(n, np.uint16 if width <= 16 else np.uint32)
    for k in range(width):
        above |= np.unpackbits(np.frombuffer(data, np.uint8, one, at + k * one), count=n, bitorder="little").astype(above.dtype) << above.dtype.type(k)
    above = above.astype(np.uint32)
    at += size
    places = np.frombuffer(data, "<u2", exceptions, at)
    above[places] |= np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions) << np.uint32(width) if exceptions else np.empty(0, np.uint32)
    return above + np.uint32(low)


class Writer:
    """Writes ids to one file; keeps less than a block."""

    def __init__(self, out):
        self.out, self.starts, self.at, self.n, self.rest = out, [], 0, 0, np.empty(0, np.uint32)

    def add(self, ids: np.ndarray) -> None:
        self.n += len(ids)
        self.rest = np.concatenate([self.rest, ids])
        whole = len(self.rest) // BLOCK * BLOCK
        for i in range(0, whole, BLOCK):
            self._block(self.rest[i : i + BLOCK])
        self.rest = self.rest[whole:]

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids)
        self.out.write(data)
        self.starts.append(self.at)
        self.at += len(data)

    def close(self) -> None:
        if len(self.rest):
            self._block(self.rest)
        self.out.write(np.array(self.starts, "<u8").tobytes() + FOOT.pack(len(self.starts), self.n, MAGIC))
        self.out.close()


class Reader:
    """Reads ids of one file by its block starts."""

    def __init__(self, file):
        self.file, size = file, file.size()
        file.seek(size - FOOT.size)
        blocks, self.n, magic = FOOT.unpack(file.read(FOOT.size))
        if magic != MAGIC:
            raise ValueError("no footer of block starts")
        end = size - FOOT.size - 8 * blocks
        file.seek(end)
        self.starts = np.append(np.frombuffer(file.read(8 * blocks), "<u8"), np.uint64(end)).astype(np.int64)

    def ids(self, first: int, n: int) -> np.ndarray:
        a, b = first // BLOCK, -(-(first + n) // BLOCK)
        self.file.seek(int(self.starts[a]))
        data, base = memoryview(self.file.read(int(self.starts[b] - self.starts[a]))), int(self.starts[a])
        got = np.concatenate([unpack(data[self.starts[k] - base : self.starts[k + 1] - base]) for k in range(a, b)])
        return got[first - a * BLOCK : first - a * BLOCK + n]


def write(docs: DataFrame, to: str, vocabulary: str = VOCABULARY, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Files of ids under `to`/ids and their index under `to`/index."""
    shared = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("_place"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), "_place"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, task, writer = byte_vocabulary(shared.value, False), TaskContext.get(), None
        part, last = task.partitionId(), np.array([end], "<u4").tobytes()
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            for some in blocks(texts):
                if writer is None:
                    store, root = fs.FileSystem.from_uri(to)
                    name = f"{part:06d}-{task.taskAttemptId()}.pfor"
                    writer = Writer(store.open_output_stream(f"{root}/ids/{name}", compression=None))
                found = known.encode([texts[i] for i in some])
                n = np.array([len(x) // 4 + 1 for x in found], np.int64)
                first = writer.n + np.cumsum(n) - n
                writer.add(np.frombuffer(b"".join([x + last for x in found]), "<u4"))
                yield pa.record_batch([pa.array([part] * len(some), pa.int32()), pa.array([name] * len(some)), b.column("doc_id").take(pa.array(some)), pa.array(first), pa.array(n)], names=["part", "file", "doc_id", "first", "n_tokens"])
        if writer:
            writer.close()

    store, root = fs.FileSystem.from_uri(to)
    store.create_dir(f"{root}/ids", recursive=True)
    conf = docs.sparkSession.conf
    before = conf.get(CLEAN, None)
    conf.set(CLEAN, "true")  # the shuffle of texts goes once the files are there
    try:
        rows.mapInArrow(run, INDEX).write.mode("overwrite").parquet(f"{to}/index")
    finally:
        conf.unset(CLEAN) if before is None else conf.set(CLEAN, before)


def index(spark: SparkSession, at: str) -> DataFrame:
    """file, doc_id, first, n_tokens and start (ids of all documents before it) of each document. Only sums of files pass through one task."""
    rows = spark.read.schema(INDEX).parquet(f"{at}/index")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("_n")).select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    return rows.join(files, "part").select("file", "doc_id", "first", "n_tokens", (F.col("_o") + F.col("first")).alias("start"))


def read(spark: SparkSession, at: str, entries: DataFrame | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian 32-bit integers) of documents, from the files. `entries`, rows of the index, picks documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(at)
        for b in batches:
            for name, docs in zip(b.column("file").to_pylist(), b.column("docs").to_pylist(), strict=True):
                with store.open_input_file(f"{root}/ids/{name}") as file:
                    reader = Reader(file)
                    low = docs[0]["first"]
                    ids = reader.ids(low, max(d["first"] + d["n_tokens"] for d in docs) - low).astype("<u4").tobytes()
                cut = [ids[4 * (d["first"] - low) : 4 * (d["first"] - low + d["n_tokens"])] for d in docs]
                yield pa.record_batch([pa.array([d[c] for d in docs], pa.int64()) for c in ("doc_id", "start", "n_tokens")] + [pa.array(cut, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    rows = index(spark, at) if entries is None else entries
    each = F.array_sort(F.collect_list(F.struct("first", "doc_id", "start", "n_tokens")))
    parts = rows.groupBy("file", F.floor(F.col("first") / SEGMENT).alias("segment")).agg(each.alias("docs")).select("file", "docs")
    parts = parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.hash("file", F.col("docs")[0]["first"]))
    return parts.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = f"{shared_dir(spark)}/ids-{uuid.uuid4()}"
    write(table(spark, sf_dir, "documents"), at)
    return read(spark, at).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
