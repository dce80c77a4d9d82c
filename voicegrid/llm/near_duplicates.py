"""Near duplicates by DartMinHash: weighted signatures, a banded join, exact verification, classes.

A text is a multiset of shingles of WORDS words (runs of letters and digits, lower-cased; a shorter text is one shingle). Two
texts are linked if the weighted Jaccard similarity of their multisets, the sum of the smaller over that of the larger
counts, is at least LIKE. Classes are the connected components of links.

Each unit of a shingle's weight is a region at which darts arrive in a hashed Poisson process over rank; a dart
falls on one of BANDS * ROWS coordinates, and the one of least rank is kept for each. Two texts agree on a coordinate with a
probability of their similarity, and a signature takes the same number of darts for any length. Texts that agree on a whole
band meet. At a similarity of 0.8 the chance that no band agrees is 5e-8.

Copies, equal after normalisation, become one node first. Each two nodes that share a band's bucket are compared or already
connected (see grouping); a bucket of near copies costs a few comparisons a member. Pairs whose sizes rule a link out aren't
compared, nor are pairs that differ in more of ODD parity bits than linked texts can: both tell without error. So all pairs
that meet and may be linked are verified, whatever LIKE is; bands suit 0.8 and more, at 0.7 a pair in 5,000 doesn't meet.

No text without a word is linked, except to its exact copies. Null texts are classes of their own. Rows that repeat an id
and a text are one; null ids are kept apart by their text. A class is named by its smallest id; null if none has one.
"""

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from voicegrid.llm.common import lasting, saved, table
from voicegrid.llm.grouping import buckets, connect

WORDS, LIKE = 5, 0.8
TILE, SLICE = 1024, 16
ODD = 2048
BANDS, ROWS = 32, 4
K = BANDS * ROWS
#: Darts a signature expects: so many that few signatures miss a coordinate at first.
DARTS = K * (np.log(K) + 3)
CACHE = 150_000
TOKENS = re.compile(r"[^\W_]+")
MULT, GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x9E3779B97F4A7C15)


class Hashes(dict):
    """64-bit hashes of words; forgets all when it is full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


_hashes = Hashes()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MULT
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB) ^ (x >> np.uint64(31))


def words(text: str) -> list[str]:
    return TOKENS.findall(text.lower())


def shingles(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending, and their counts."""
    h = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    m = max(len(h) - WORDS + 1, 1)
    out = np.full(m, min(len(h), WORDS), np.uint64)
    for i in range(min(WORDS, len(h))):
        out = mixed(out * GOLD + h[i : i + m])
    return np.unique(out, return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both)


def regions(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash for each unit of weight."""
    unit = np.repeat(codes, counts)
    nth = np.arange(len(unit), dtype=np.uint64) - np.repeat(np.cumsum(counts) - counts, counts).astype(np.uint64)
    return mixed(unit + nth * GOLD)


def parities(region: np.ndarray) -> bytes:
    """ODD bits, each the parity of the units that fall on it. Two texts differ in no more bits than in units."""
    return np.packbits(np.bincount((region % np.uint64(ODD)).astype(np.int64), minlength=ODD).astype(np.uint8) & 1).tobytes()


def near(n: np.ndarray, m: np.ndarray, x: np.ndarray, y: np.ndarray, like: float) -> np.ndarray:
    """Whether sizes and parities of paired texts allow a link: of n + m units, at most (1 - like) / (1 + like) may differ."""
    bits = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return bits <= (n + m) * (1 - like) / (1 + like) + 1e-6


def signature(region: np.ndarray) -> np.ndarray:
    """For each coordinate, the hash of the dart of least rank."""
    reach = DARTS / len(region)
    while True:
        ranks, darts = np.zeros(0), np.zeros(0, np.uint64)
        alive, at, first = region, np.zeros(len(region)), 0
        while len(alive):
            steps = int(np.ceil(reach)) + 2
            dart = mixed(alive[:, None] + np.arange(first + 1, first + steps + 1, dtype=np.uint64) * MULT)
            wait = -np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            rank = at[:, None] + np.cumsum(wait, axis=1)
            hit = rank < reach
            ranks, darts = np.concatenate([ranks, rank[hit]]), np.concatenate([darts, dart[hit]])
            more = hit[:, -1]
            alive, at, first = alive[more], rank[more, -1], first + steps
        darts = mixed(darts + GOLD)
        coordinate = (darts % np.uint64(K)).astype(np.int64)
        order = np.lexsort((ranks, coordinate))
        there, where = np.unique(coordinate[order], return_index=True)
        if len(there) == K:
            return darts[order[where]]
        reach *= 2


def bands(sig: np.ndarray) -> np.ndarray:
    """A hash for each band, its number included."""
    out = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        out = mixed(out * GOLD + sig[i::ROWS])
    return out.view(np.int64)


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, th (a hash of the text), key (of the normalised text), n (its shingles), bands and odd of each text that isn't null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sizes, found, odds = [], [], [], []
            for text in b.column("_t"):
                text = text.as_py()
                w = words(text)
                keys.append(xxhash.xxh3_128_digest((" ".join(w) if w else f"\0{text}").encode("utf-8", "surrogatepass")))
                if not w:
                    sizes.append(0)
                    found.append(np.zeros(0, np.int64))
                    odds.append(b"")
                    continue
                codes, counts = shingles(w)
                region = regions(codes, counts)
                sizes.append(int(counts.sum()))
                found.append(bands(signature(region)))
                odds.append(parities(region))
            yield pa.record_batch([b.column("doc_id"), b.column("th"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64())), pa.array(odds, pa.binary())], names=["doc_id", "th", "key", "n", "bands", "odd"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("_t")).filter("_t is not null")
    schema = rows.select("doc_id", "th").schema.add("key", "binary").add("n", "long").add("bands", ArrayType(LongType())).add("odd", "binary")
    return rows.mapInArrow(run, schema)


def verified(pairs: DataFrame, texts: DataFrame, like: float = LIKE) -> DataFrame:
    """The pairs (a, b) whose texts are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, left = [], None, None
            for a, x, y in zip(batch.column("a").to_pylist(), batch.column("x"), batch.column("y"), strict=True):
                if a != last:
                    last, left = a, shingles(words(x.as_py()))
                keep.append(similarity(left, shingles(words(y.as_py()))) >= like)
            yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x, y = (texts.select(F.col("key").alias(k), F.col("text").alias(t)) for k, t in (("_ka", "x"), ("_kb", "y")))
    both = pairs.join(y, F.col("b") == F.col("_kb")).join(x, F.col("a") == F.col("_ka")).select("a", "b", "x", "y")
    return both.mapInArrow(run, "a binary, b binary")


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def screened(pairs: DataFrame, nodes: DataFrame, like: float) -> DataFrame:
    """The pairs (a, b) whose sizes and parities allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x").flatten(), batch.column("y").flatten()  # n, odd
            ok = near(x[0].to_numpy(), y[0].to_numpy(), _bytes(x[1], ODD // 8), _bytes(y[1], ODD // 8), like)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    x, y = (nodes.select(F.col("key").alias(k), F.struct("n", "odd").alias(t)) for k, t in (("_ka", "x"), ("_kb", "y")))
    both = pairs.join(x, F.col("a") == F.col("_ka")).join(y, F.col("b") == F.col("_kb")).select("a", "b", "x", "y")
    return both.mapInArrow(run, "a binary, b binary")


def agreeing(open_: DataFrame, nodes: DataFrame, like: float) -> DataFrame:
    """The pairs in a bucket, of different components and one of them apart, whose sizes and parities allow a link.

    A bucket is dealt into tiles, each two of which meet in one place. There, parities are compared as arrays, and
    only pairs that pass become rows, in the first of the buckets that they share.
    """
    tiles = open_.groupBy(F.col("band").alias("_t")).agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    rows = open_.join(tiles, F.col("band") == F.col("_t")).withColumn("t", F.pmod(F.xxhash64("key"), "tiles").cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("o"))
    rows = rows.select("band", F.least("t", "o").alias("lo"), F.greatest("t", "o").alias("hi"), "t", "key", F.col("x").alias("n"), F.xxhash64("root").alias("root"), "apart")
    rows = rows.join(nodes.select(F.col("key").alias("_k"), "bands", "odd"), F.col("key") == F.col("_k")).drop("_k")

    def pairs(r: dict[str, np.ndarray], a: slice) -> pa.RecordBatch:
        n, root, apart, t = (r[c][a] for c in ("n", "root", "apart", "t"))
        bands, odd = r["bands"][a], r["odd"][a]
        keys = r["key"][a]
        found = []
        for i in range(0, len(n), SLICE):
            s = slice(i, i + SLICE)
            ok = (root[s, None] != root) & (apart[s, None] | apart) & (np.minimum(n[s, None], n) >= like * np.maximum(n[s, None], n))
            ok &= (t[s, None] < t) | (r["lo"][a.start] == r["hi"][a.start]) & (np.arange(i, i + len(n[s]))[:, None] < np.arange(len(n)))
            x, y = np.nonzero(ok)
            for k in range(0, len(x), 1 << 14):
                u, v = x[k : k + (1 << 14)] + i, y[k : k + (1 << 14)]
                same = near(n[u], n[v], odd[u], odd[v], like)
                u, v = u[same], v[same]
                common = bands[u] == bands[v]
                same = bands[u, common.argmax(axis=1)] == r["band"][a.start]  # else another bucket has the pair
                found += zip(u[same].tolist(), v[same].tolist(), strict=True)
        ends = [(min(keys[u], keys[v]), max(keys[u], keys[v])) for u, v in found]
        return pa.record_batch([pa.array([e[0] for e in ends], pa.binary()), pa.array([e[1] for e in ends], pa.binary())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in chain(batches, [None]):
            table = left if batch is None else pa.Table.from_batches([batch]) if left is None else pa.concat_tables([left, pa.Table.from_batches([batch])])
            left = None
            if table is None or not len(table):
                continue
            r = {c: table.column(c).to_numpy() for c in ("band", "lo", "hi", "t", "n", "root", "apart")}
            r["key"] = table.column("key").to_pylist()
            r["odd"] = _bytes(table.column("odd"), ODD // 8)
            r["bands"] = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
            new = (r["band"][1:] != r["band"][:-1]) | (r["lo"][1:] != r["lo"][:-1]) | (r["hi"][1:] != r["hi"][:-1])
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(table)]
            if batch is not None:  # the last group may go on
                left = table.slice(cuts[-2])
                cuts.pop()
            for a, b in zip(cuts, cuts[1:]):
                if b - a > 1:
                    yield pairs(r, slice(a, b))

    n = int(open_.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "band", "lo", "hi").sortWithinPartitions("band", "lo", "hi")
    return dealt.mapInArrow(run, "a binary, b binary")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", like: float = LIKE) -> DataFrame:
    """doc_id, th (xxhash64 of the text), class_id, and kept: whether the row is its class's first. One row for each row of docs."""
    rows = saved(sketches(docs, id_col, text_col))
    name = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "th")
    nodes = saved(rows.groupBy("key").agg(F.min(name).alias("name"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("odd").alias("odd")))

    def texts_of(keys: DataFrame) -> DataFrame:
        wanted = nodes.join(keys.withColumnRenamed("key", "_k"), F.col("key") == F.col("_k"), "left_semi").select("key", F.col("name.doc_id").alias("_d"), F.col("name.th").alias("_h"))
        source = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
        return source.join(wanted, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_h"))).groupBy("key").agg(F.first("text").alias("text"))

    met = buckets(nodes.select("key", F.col("n").alias("x"), "bands"))
    texts = saved(texts_of(met.select("key").distinct()))
    part = connect(met, lambda x, y: F.least(x, y) >= like * F.greatest(x, y), lambda pairs: verified(screened(pairs, nodes, like), texts, like), lambda rows: agreeing(rows, nodes, like), hubs=2)
    of = nodes.select("key", "name").join(part, F.col("key") == F.col("node"), "left").select("key", "name", F.coalesce("root", "key").alias("root"))
    best = of.groupBy(F.col("root").alias("_r")).agg(F.min("name").alias("best"))
    of = of.join(best, F.col("root") == F.col("_r")).select(F.col("key").alias("_k"), "best")
    out = rows.select("doc_id", "th", "key").join(of, F.col("key") == F.col("_k")).select("doc_id", "th", F.col("best.doc_id").alias("class_id"), (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("th") == F.col("best.th"))).alias("kept"))
    alone = docs.filter(F.col(text_col).isNull()).select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(id_col).alias("class_id"), F.lit(True).alias("kept"))
    return out.unionAll(alone)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", like: float = LIKE) -> DataFrame:
    """One row of each class, whole; null texts stay."""
    keep = lambda: classes(docs, id_col, text_col, like).filter("kept").select(F.struct("doc_id", "th").alias("_k")).distinct()
    (keep,) = lasting(docs.sparkSession, keep)
    # one key for the join and for rows that repeat, so that texts are shuffled once; a hash that is never null would be cast for the join
    th = F.when(F.col(text_col).isNotNull(), F.xxhash64(text_col))
    rows = docs.select(F.struct("*").alias("_row"), F.struct(F.col(id_col).alias("doc_id"), th.alias("th")).alias("_of"), F.col(text_col).isNull().alias("_null"))
    texts = rows.filter("not _null").join(keep, F.col("_of") == F.col("_k"), "left_semi").dropDuplicates(["_of"])
    return texts.unionAll(rows.filter("_null")).select("_row.*")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")
