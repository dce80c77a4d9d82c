"""Quality classifier: logistic regression over hashed word n-grams, fitted by follow-the-regularised-leader updates.

Tokens are runs of letters, digits and underscores, and runs of other marks. A document's features are the bins of its
tokens and pairs of neighbouring tokens, weighted by 1 plus the log of their count and scaled to unit length; pairs of equal
tokens share a bin. There is a constant besides. Its score is the logistic of the sparse dot product.

The model is fitted on labelled rows, SAMPLE at most, the first by MD5 of their id, in EPOCHS passes over that order. One
task does it; it sees the sample alone, which doesn't grow with the corpus. Every document is scored, whole, without a
shuffle.

Null and empty texts have the constant alone. An id with several labels counts once, with the smallest. Rows that
repeat are scored alike. Without labelled rows all scores are 0.5.
"""

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voicegrid.llm.common import md5_bits, table

BITS, PAIR = 18, 65_599
SAMPLE, EPOCHS = 12_000, 4
#: Learning rate and penalty with the least log loss on a quarter of the training rows of sf0.1, of rates 0.5, 2, 8 and penalties 0, 0.02, 0.2.
ALPHA, BETA, L1, L2 = 8.0, 1.0, 0.2, 0.0
TOKENS = re.compile(r"\w+|[^\w\s]+")
CACHE = 300_000


class Hashes(dict):
    """CRC-32 of tokens; forgets all when it is full."""

    def __missing__(self, token: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[token] = zlib.crc32(token.encode("utf-8", "surrogatepass"))
        return h


_hashes = Hashes()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct bins of a text, ascending, and their weights. Bin 0 is the constant, bin 1 a pair of equal tokens."""
    tokens = TOKENS.findall(text) if text else []
    h = np.fromiter(map(_hashes.__getitem__, tokens), np.int64, len(tokens))
    pairs = np.where(h[:-1] == h[1:], -1, (h[:-1] * PAIR + h[1:]) % ((1 << BITS) - 2))
    seen, n = np.unique(np.concatenate([h % ((1 << BITS) - 2), pairs]) + 2, return_counts=True)
    x = 1 + np.log(n)
    return np.concatenate([[0], seen]), np.concatenate([[1.0], x / max(np.sqrt(x @ x), 1.0)])


def logistic(z: float) -> float:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


class Ftrl:
    """Follow the regularised leader, with a learning rate for each coordinate."""

    def __init__(self, size: int = 1 << BITS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (logistic(w @ x) - label) * x
        n = self.n[at]
        more = n + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(n)) / self.alpha * w
        self.n[at] = more


def sample(labels: DataFrame, usable: Column, most: int = SAMPLE) -> DataFrame:
    """Ids, labels and order of the rows to learn from: few enough to broadcast."""
    good = labels.filter(usable & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    one = good.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").cast("int").alias("_y"))
    return one.withColumn("_o", md5_bits(F.col("_id").cast("string"))).orderBy("_o", "_id").limit(most)


def fit(docs: DataFrame, picked: DataFrame, id_col: str = "doc_id", text_col: str = "text", epochs: int = EPOCHS) -> np.ndarray:
    """The weights of all bins."""

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [features(t) for t in b.column("_t").to_pylist()]
            yield pa.record_batch([b.column("_o"), b.column("_id").cast(pa.string()), b.column("_y"), pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.float64()))], names=["o", "id", "y", "at", "x"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("o", "id", "y")), *([v.values.to_numpy() for v in b.column(c)] for c in ("at", "x")), strict=True)]
        rows.sort(key=lambda r: (r[0], r[1], len(r[3]), r[3].tobytes(), r[4].tobytes()))
        model = Ftrl()
        for _ in range(epochs):
            for _, _, y, at, x in rows:
                model.learn(at, x, y)
        w = model.weights()
        at = np.flatnonzero(w)
        yield pa.record_batch([pa.array(at, pa.int32()), pa.array(w[at])], names=["bin", "w"])

    rows = docs.select(F.col(id_col).alias("_d"), F.col(text_col).alias("_t")).join(F.broadcast(picked), F.col("_d") == F.col("_id")).select("_o", "_id", "_y", "_t")
    learned = rows.mapInArrow(featurise, "o long, id string, y int, at array<int>, x array<double>").repartition(1).mapInArrow(train, "bin int, w double").toArrow()
    w = np.zeros(1 << BITS)
    w[learned["bin"].to_numpy()] = learned["w"].to_numpy()
    return w


def score(df: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """The rows with `score` instead of the text."""
    shared = df.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    keep = [c for c in df.columns if c not in (text_col, "score")]
    rows = df.select(F.struct(*keep).alias("_row"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value.astype(np.float64)
        for b in batches:
            out = np.empty(b.num_rows)
            for i, text in enumerate(b.column("_text")):
                at, x = features(text.as_py())
                out[i] = logistic(w[at] @ x)
            yield pa.record_batch([b.column("_row"), pa.array(out)], names=["_row", "score"])

    schema = rows.select("_row").schema.add("score", "double")
    return rows.mapInArrow(run, schema).select("_row.*", "score")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = lambda: F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    weights = fit(docs, sample(table(spark, sf_dir, "labels"), fold() != 0))
    return score(docs, weights).select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
