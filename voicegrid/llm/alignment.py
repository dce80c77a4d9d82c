"""Alignment of two tokenizers' tokens by the bytes that they cover.

Texts get the tokens of a byte-level BPE (A) and of a piece model (B). A text falls into chunks, cut before spaces that follow anything else; no
token of either goes over such a cut, so each cut is an end that both have, and the groups and links of a text are those of its chunks side by side.
Python tokenises a chunk and links its tokens once while it is remembered, all new chunks of a block of texts together by numpy: where either has an
end, a link ends, and where both have one, a group. So a text of any length costs what its tokens cost, and no pair is tried that isn't a link.
What a text costs beyond its new chunks is a look-up a chunk.

Counts of id pairs over the corpus are summed in each task before the shuffle, so that a pair that every document has is one row a task. They
meet the links again by a join: a broadcast if there are at most SMALL pairs (counted first), else a shuffle by pair of the links as summed by
document, whose hot keys Spark splits.

The aligned rows are saved once, with a number a link, under numbers of their own, so that rows that repeat, also with the same id, stay apart. Null and empty
texts, and those whose tokens don't spell a space and the text, have no tokens: numbers are 0, the groups are empty. No rows in, no rows out.
"""

from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from voicegrid.llm.chunks import LONG, ByteVocabulary, byte_vocabulary, spaced
from voicegrid.llm.common import saved, table
from voicegrid.llm.pieces import MARK, MODEL, WHOLE, Vocabulary, blocks, vocabulary
from voicegrid.llm.token_files import VOCABULARY

SMALL, CACHE = 1_000_000, 100_000
_OWN = ("n_a", "n_b", "n_groups", "groups", "pairs")
#: Groups (ids of A and B as text), links (A's id times the number of B's ids, and B's id, as bytes of longs) and the number of A's tokens.
Links = tuple[bytes, bytes, int]


class Chunks:
    """The links of texts by those of their chunks, each of which is a space and what follows; None if the tokens don't spell it."""

    def __init__(self, left: ByteVocabulary, right: Vocabulary):
        self.left, self.right, self.width = left, right, len(right.text)
        self.sizes = [np.array([len(x) for x in v.text], np.int64) for v in (left, right)]
        #: Ids as text with what comes after them: between tokens, at the end of A's in a group, of a group, of a chunk.
        self.name = [f"{i}{x}" for i in range(max(map(len, self.sizes))) for x in ",|;\n"]
        self.mark = np.frombuffer(right.packed[MARK], "=i4").tolist()
        #: A cut before each space that follows anything else is one for both tokenizers.
        self.cut = right.plain and right.word.pattern != WHOLE
        self.known: dict[str, Links | None] = {}
        self.older: dict[str, Links | None] = {}

    def made(self, chunks: list[str]) -> list[Links | None]:
        """The links of chunks without the space in front, of all of them at once: side by side they are one text, with an end of both after each."""
        of_a = [e.ids for e in self.left.lib.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)]
        # a space alone, at the end of a text, is a piece there, where the empty text has none
        of_b = [x if c else self.mark for c, x in zip(chunks, self.right.lib.encode(chunks, num_threads=1), strict=True)]
        want = [(" " + c).encode() for c in chunks]
        a, b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (of_a, of_b))
        n_a, n_b = (np.cumsum([len(x) for x in of]) for of in (of_a, of_b))
        ends_a, ends_b, ends = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b]), np.cumsum([len(x) for x in want])
        found = [b"".join(map(v.text.__getitem__, x.tolist())) for v, x in ((self.left, a), (self.right, b))]
        last = [np.concatenate([[0], e])[n] for e, n in ((ends_a, n_a), (ends_b, n_b))]
        if not (found[0] == found[1] == b"".join(want) and all(np.array_equal(x, ends) for x in last)):
            return self.made_apart(chunks, want, of_a, of_b)

        # where either has an end, a link ends
        at = np.union1d(ends_a, ends_b)
        pairs = (a[np.searchsorted(ends_a, at)] * self.width + b[np.searchsorted(ends_b, at)]).astype("<i8").tobytes()
        to = [0, *(8 * np.searchsorted(at, ends, "right")).tolist()]
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        groups = [np.searchsorted(cuts, e) for e in (ends_a, ends_b)]
        # tokens in the order of groups, those of A before those of B, each with what comes after it
        count = [np.concatenate([[0], np.cumsum(np.bincount(g, minlength=len(cuts)))]) for g in groups]
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + count[1][groups[0]]] = 4 * a + np.isin(ends_a, cuts, assume_unique=True)
        codes[np.arange(len(b)) + count[0][groups[1] + 1]] = 4 * b + 2 * np.isin(ends_b, cuts, assume_unique=True) + np.isin(ends_b, ends)
        text = "".join(map(self.name.__getitem__, codes.tolist())).encode().split(b"\n")
        return [(text[i], pairs[to[i] : to[i + 1]], n) for i, n in enumerate(np.diff(n_a, prepend=0).tolist())]

    def made_apart(self, chunks: list[str], want: list[bytes], of_a: list[list[int]], of_b: list[list[int]]) -> list[Links | None]:
        """The same where the tokens of some chunks don't spell them."""
        spelt = [w == b"".join([self.left.text[i] for i in x]) == b"".join([self.right.text[i] for i in y]) for w, x, y in zip(want, of_a, of_b, strict=True)]
        good = [c for c, yes in zip(chunks, spelt, strict=True) if yes]
        made = iter(self.made(good) if good else [])
        return [next(made) if yes else None for yes in spelt]

    def encode(self, texts: list[str]) -> list[Links | None]:
        """The links of a space and each text; None if the tokens don't spell it or it is empty."""
        # a text that mustn't be cut is a chunk; the space in front of a chunk isn't kept
        split = [spaced(t) if self.cut and not self.left.whole(t) else [t] for t in texts]
        need = set().union(*split) - self.known.keys()
        if len(self.known) + len(need) > CACHE:  # what was in use lately stays for a while
            self.older, self.known = self.known, {}
            need = set().union(*split)
        again = need & self.older.keys()
        self.known |= {c: self.older[c] for c in again}
        new = list(need - again)
        self.known |= zip(new, self.made(new) if new else [], strict=True)
        out = [self.whole(list(map(self.known.__getitem__, s))) if t else None for s, t in zip(split, texts, strict=True)]
        for c in new:
            if len(c) > LONG:
                del self.known[c]
        return out

    @staticmethod
    def whole(found: list[Links | None]) -> Links | None:
        if None in found:
            return None
        groups, pairs, n = zip(*found, strict=True)
        return b";".join(groups), b"".join(pairs), sum(n)


def linked(docs: DataFrame, a: str = VOCABULARY, b: str = MODEL, text_col: str = "text") -> DataFrame:
    """The rows with n_a, n_b, n_groups, `groups` (a text such as `a1,a2|b1;a3|b2,b3`) and `pairs` (a number a link: A's id times the number of B's ids,
    and B's id, in order) instead of the text; zeros and nothing where there are no tokens."""
    context = docs.sparkSession.sparkContext
    both = context.broadcast((Path(a).read_bytes(), Path(b).read_bytes()))
    keep = [c for c in docs.columns if c not in (text_col, *_OWN)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = chunks_of(both.value)
        for batch in batches:
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            for part in blocks(texts):
                found = [x or (b"", b"", 0) for x in known.encode([texts[i] for i in part])]
                groups = [x[0] for x in found]
                n_links, n_a, n_groups = (np.array(x, np.int64) for x in ([len(x[1]) // 8 for x in found], [x[2] for x in found], [g.count(b"|") for g in groups]))
                # each link ends a token of A, of B, or both and with them a group
                numbers = [pa.array(x) for x in (n_a, n_links + n_groups - n_a, n_groups)]
                pairs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_links)]), pa.int32()), pa.array(np.frombuffer(b"".join([x[1] for x in found]), "<i8")))
                yield pa.record_batch([batch.column("_row").take(pa.array(part)), *numbers, pa.array(groups, pa.string()), pairs], names=["_row", *_OWN])

    rows = docs.select(F.struct(*keep).alias("_row"), F.col(text_col).alias("_text"))
    schema = rows.select("_row").schema
    for c, kind in zip(_OWN, (LongType(), LongType(), LongType(), StringType(), ArrayType(LongType(), False)), strict=True):
        schema = schema.add(c, kind)
    return rows.mapInArrow(run, schema).select("_row.*", *_OWN)


_known: dict[tuple[bytes, bytes], Chunks] = {}


def chunks_of(models: tuple[bytes, bytes]) -> Chunks:
    if models not in _known:
        _known.clear()
        _known[models] = Chunks(byte_vocabulary(models[0], True), vocabulary(models[1]))
    return _known[models]


def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """pair, n (links of that pair in all rows of `linked`) and best (whether no other A id has more with that B id)."""
    n = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    most = n.groupBy((F.col("pair") % width).alias("b_id")).agg(F.max("n").alias("_most"))
    return n.join(most, F.col("pair") % width == F.col("b_id")).select("pair", "n", (F.col("n") == F.col("_most")).alias("best"))


def align(docs: DataFrame, a: str = VOCABULARY, b: str = MODEL, text_col: str = "text", small: int = SMALL, digest: bool = False) -> DataFrame:
    """The rows with n_a, n_b, n_groups, groups, n_links, n_best and count_sum instead of the text. digest: the SHA-256 of the groups, which are
    about as long as the text several times over ('' stays)."""
    own = ("n_a", "n_b", "n_groups", "groups", "n_links", "n_best", "count_sum")
    keep, width = [c for c in docs.columns if c not in (text_col, *own)], len(vocabulary(Path(b).read_bytes()).text)
    rows = linked(docs.select(F.monotonically_increasing_id().alias("_id"), F.struct(*keep).alias("_kept"), F.col(text_col).alias("_t")), a, b, "_t")
    groups = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)) if digest else F.col("groups")
    rows = saved(rows.select("_id", "_kept", "n_a", "n_b", F.size("pairs").cast("long").alias("n_links"), "n_groups", groups.alias("groups"), "pairs"))
    counts = saved(pair_counts(rows, width))
    each = rows.select("_id", F.explode("pairs").alias("pair"))
    if counts.count() <= small:
        per = each.join(F.broadcast(counts), "pair").withColumn("_x", F.lit(1).cast("long"))
    else:
        per = each.groupBy("_id", "pair").agg(F.count("*").alias("_x")).join(counts, "pair")
    per = per.groupBy("_id").agg(F.sum(F.when(F.col("best"), F.col("_x")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("_x")).alias("count_sum"))
    return rows.drop("pairs").join(per, "_id", "left").select("_kept.*", *own[:5], *[F.coalesce(c, F.lit(0)).cast(LongType()).alias(c) for c in own[5:]])


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = align(table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)
    return rows.withColumnRenamed("groups", "groups_sha256").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
