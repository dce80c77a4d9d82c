"""Language identification by rank-order n-gram profiles.

Texts are lower-cased letters, all else is a space, and each word has a space before and after it. A profile is the SIZE most
frequent n-grams of 1 to 5 characters that lie within a padded word, in rank order. The distance of a document to a language
is the sum, over the document's profile, of how far each n-gram is out of place in the language's; one that isn't there is
SIZE places out. The nearest language wins, ties go to the smaller name.

Language profiles are learned from SAMPLE documents a language at most, the first by MD5 of their id; n-gram counts
of these are added up by Spark, and only the profiles reach the driver. There may be LANGUAGES of them, more than are spoken. Every document is
predicted, whole: n-grams of long texts are counted in pieces cut at words.

A null text, or one without letters, is `und` with score 0, and so is every text if there is nothing to learn from. Equal
counts rank by the n-gram's code. The score is 1 less the distance as a share of the largest possible one.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voicegrid.llm.common import md5_bits, table

SIZE, ORDERS = 300, 5
SAMPLE, LANGUAGES = 1_000, 10_000
#: Parts of a language that are cut to SAMPLE rows each before they are ranked together, so that no task ranks all its documents.
PARTS = 64
PIECE = 1 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)

_lower: np.ndarray | None = None


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased letters of a text, a 32 for each run of others, also at both ends."""
    global _lower
    if _lower is None:
        _lower = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            if (x := chr(c)).isalpha():
                _lower[c] = ord(x.lower()[0])
    x = _lower[np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)]
    space = x == 32
    return x[~(space & np.r_[False, space[:-1]])]


def grams(x: np.ndarray) -> np.ndarray:
    """Codes of all n-grams: 64-bit hashes of their characters, in the order of length."""
    space, out = x == 32, []
    code = np.zeros(len(x), np.uint64)
    inside = np.ones(len(x), bool)
    for n in range(1, ORDERS + 1):
        m = len(x) - n + 1
        if m < 1:
            break
        code = (code[:m] ^ x[n - 1 :].astype(np.uint64)) * MIX
        code ^= code >> np.uint64(29)
        if n == 1:
            out.append(code[~space])
            continue
        if n > 2:
            inside = inside[:m] & ~space[n - 2 : n - 2 + m]
        inside = inside[:m]
        out.append(code[inside])
    return np.concatenate(out)


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a text's n-grams, ascending, and their counts."""
    x = letters(text or "")
    pieces, at = [], 0
    while at < len(x) - 1:
        end = min(at + PIECE, len(x))
        if end < len(x):
            cut = np.flatnonzero(x[end - 1 :: -1][: end - at - 1] == 32)
            end = end - int(cut[0]) if len(cut) else len(x)
        pieces.append(np.unique(grams(x[at:end]), return_counts=True))
        at = end - 1  # the space belongs to both words
    return added(pieces)


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sum of several counts."""
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)


def ranked(codes: np.ndarray, counts: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The codes of the `size` greatest counts in rank order."""
    if len(codes) > size:
        least = np.partition(counts, -size)[-size]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))[:size]]


def learn(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Profiles by language."""
    order = md5_bits(F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    rows = docs.filter(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), order.alias("place"))
    if rows.select("lang").distinct().count() > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    first = lambda df, *by: df.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy("place", "id"))).filter(F.col("n") <= SAMPLE)
    picked = first(first(rows.select("lang", "place", "id", (F.col("place") % PARTS).alias("part")), "lang", "part"), "lang")
    limits = picked.groupBy(F.col("lang").alias("of")).agg(F.max("place").alias("most"))
    texts = rows.join(F.broadcast(limits), F.col("lang") == F.col("of")).filter("place <= most").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by: dict[str, list] = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                by.setdefault(lang, []).append(counted(text))
            for lang, found in by.items():
                codes, n = added(found)
                yield pa.record_batch([pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)), pa.array(n)], names=["lang", "code", "n"])

    sums = texts.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    best = sums.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))).filter(F.col("r") <= SIZE)
    found = best.orderBy("lang", "r").toArrow()
    langs, codes = np.array(found["lang"].to_pylist(), dtype=object), found["code"].to_numpy().view(np.uint64)
    return {lang: codes[langs == lang] for lang in dict.fromkeys(langs.tolist())}


class Profiles:
    """Distances of document profiles to all language profiles at once."""

    def __init__(self, profiles: dict[str, np.ndarray]):
        self.names = sorted(profiles)
        self.codes = np.unique(np.concatenate([profiles[n] for n in self.names])) if profiles else np.zeros(0, np.uint64)
        self.ranks = np.full((len(self.codes) + 1, len(self.names)), -1, np.int32)
        for i, n in enumerate(self.names):
            self.ranks[np.searchsorted(self.codes, profiles[n]), i] = np.arange(len(profiles[n]))

    def nearest(self, profile: np.ndarray) -> tuple[str, float]:
        if not len(profile) or not self.names:
            return "und", 0.0
        at = np.searchsorted(self.codes, profile)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != profile)] = len(self.codes)
        ranks = self.ranks[at]
        out = np.where(ranks < 0, SIZE, np.minimum(np.abs(ranks - np.arange(len(profile))[:, None]), SIZE)).sum(axis=0)
        best = int(out.argmin())
        return self.names[best], 1 - float(out[best]) / (SIZE * len(profile))


def predict(df: DataFrame, profiles: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """The rows with lang_pred and score instead of the text. No shuffle."""
    keep = [c for c in df.columns if c not in (text_col, "lang_pred", "score")]
    rows = df.select(F.struct(*keep).alias("_row"), F.col(text_col).alias("_text"))
    shared = df.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Profiles(shared.value)
        for b in batches:
            found = [known.nearest(ranked(*counted(t.as_py()))) for t in b.column("_text")]
            yield pa.record_batch([b.column("_row"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["_row", "lang_pred", "score"])

    schema = rows.select("_row").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, schema).select("_row.*", "lang_pred", "score")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = lambda: F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    found = predict(docs.select("doc_id", "text"), learn(docs, fold() != 1))
    return found.select("doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
