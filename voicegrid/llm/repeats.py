"""Runs of repeated words in texts, found by a suffix automaton.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends keeping q, of `least` words and
two periods at least. The automaton of a stretch of words has a state for each set of end positions; sets are merged from the
longest states to the shorter ones, small into large, kept in order. Two positions that become neighbours in the set of a state
at a distance d not above its length are the ends of two equal words of d letters side by side: the seed of a run with period d, which
is the smallest one, as another end would lie between them otherwise. The length of the state is the longest common suffix of both
positions, so the seed starts where its run does; seeds with the same start and period extend to the run, which ends with
the last of them.

Before that, stretches without a chance go: in a run of `least` words each word lies in a window of least / 2 words that comes again
within the run. Words outside such windows end a stretch, and stretches are screened again by themselves until nothing
changes. Windows are compared by hash codes, so the screen may keep too much, never too little. An automaton's memory is in
proportion to its stretch.

Texts are taken whole, one by one, without a shuffle. Null and empty texts have no words and no runs. Rows that repeat are treated alike.
Columns of the rows named like a result are replaced. No rows in, no rows out.
"""

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from voicegrid.llm.common import WORD, shielded, table
from voicegrid.llm.pieces import blocks

LEAST = 12
CHUNK = 512
RUNS = ArrayType(StructType([StructField(n, LongType()) for n in ("start", "length", "period")]))
_OWN = ("n_words", "runs", "collapsed")


class Positions:
    """A set of numbers in order, in chunks, so that an insertion moves few of them."""

    def __init__(self, one: int):
        self.chunks, self.firsts, self.size = [[one]], [one], 1

    def __iter__(self) -> Iterator[int]:
        for c in self.chunks:
            yield from c

    def add(self, x: int) -> tuple[int | None, int | None]:
        """Inserts a number that isn't in it; the numbers before and after it."""
        k = max(bisect_right(self.firsts, x) - 1, 0)
        c = self.chunks[k]
        i = bisect_left(c, x)
        before = c[i - 1] if i else None
        after = c[i] if i < len(c) else self.chunks[k + 1][0] if k + 1 < len(self.chunks) else None
        c.insert(i, x)
        self.firsts[k] = c[0]
        self.size += 1
        if len(c) > CHUNK:
            half = len(c) // 2
            self.chunks[k : k + 1] = [c[:half], c[half:]]
            self.firsts[k : k + 1] = [c[0], c[half]]
        return before, after

    def follows(self, a: int, b: int) -> bool:
        """Whether b is the next one after a."""
        k = bisect_right(self.firsts, a) - 1
        c = self.chunks[k]
        i = bisect_left(c, a) + 1
        return (c[i] if i < len(c) else self.chunks[k + 1][0] if k + 1 < len(self.chunks) else None) == b


def automaton(x: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Length, suffix link and own end position (-1 if none) of each state; state 0 is the empty word's."""
    length, link, end, to = [0], [-1], [-1], [{}]
    last = 0
    for i, c in enumerate(x):
        new = len(length)
        length.append(i + 1)
        link.append(0)
        end.append(i)
        to.append({})
        p, last = last, new
        while p >= 0 and c not in to[p]:
            to[p][c] = new
            p = link[p]
        if p < 0:
            continue
        q = to[p][c]
        if length[q] == length[p] + 1:
            link[new] = q
            continue
        clone = len(length)
        length.append(length[p] + 1)
        link.append(link[q])
        end.append(-1)
        to.append(to[q].copy())
        link[q] = link[new] = clone
        while p >= 0 and to[p].get(c) == q:
            to[p][c] = clone
            p = link[p]
    return length, link, end


def seeds(x: list[int], shortest: int) -> Iterator[tuple[int, int, int]]:
    """(period, start, end) of seeds from states of at least `shortest` words."""
    length, link, end = automaton(x)
    sets: dict[int, Positions] = {}
    fresh: dict[int, list[tuple[int, int]]] = {}

    def merge(state: int, own: Positions) -> None:
        there = sets.get(state)
        if there is None:
            sets[state] = own
            return
        small, large = (own, there) if own.size <= there.size else (there, own)
        most, found, last = length[state], fresh.setdefault(state, []), None
        for e in small:
            before, after = large.add(e)
            if before is not None and before != last and e - before <= most:
                found.append((before, e))
            if after is not None and after - e <= most:
                found.append((e, after))
            last = e
        sets[state] = large

    for v in sorted((v for v in range(1, len(length)) if length[v] >= shortest), key=length.__getitem__, reverse=True):
        if end[v] >= 0:
            merge(v, Positions(end[v]))
        own = sets.pop(v)
        n = length[v]
        for a, b in fresh.pop(v, ()):
            if own.follows(a, b):  # none came between them later
                yield b - a, a - n + 1, b
        if length[link[v]] >= shortest:
            merge(link[v], own)


def runs_of(x: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence, by start and period."""
    last: dict[tuple[int, int], int] = {}
    for period, start, end in seeds(x, (least + 1) // 2):
        last[start, period] = max(end, last.get((start, period), 0))
    return sorted((s, e - s + 1, q) for (s, q), e in last.items() if e - s + 1 >= max(least, 2 * q))


def stretches(codes: np.ndarray, text: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """(from, to) of the parts of the concatenated texts that may hold runs. codes: of words; text: the number of each word's text."""
    w, at = (least + 1) // 2, np.arange(len(codes))
    mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    mixed ^= mixed >> np.uint64(29)
    label = text.astype(np.int64)
    while len(at) >= w:
        # windows within one stretch whose hash comes twice in it
        h = np.zeros(len(at) - w + 1, np.uint64)
        for k in range(w):
            h = h * np.uint64(0x100000001B3) + mixed[at[k : k + len(h)]]
        ok = label[: len(h)] == label[w - 1 :]
        h ^= label[: len(h)].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        where = np.flatnonzero(ok)
        order = where[np.argsort(h[where], kind="stable")]
        same = h[order[1:]] == h[order[:-1]]
        again = np.zeros(len(order), bool)
        again[1:] |= same
        again[:-1] |= same
        edge = np.zeros(len(at) + 1, np.int64)
        np.add.at(edge, order[again], 1)
        np.add.at(edge, order[again] + w, -1)
        covered = np.cumsum(edge[:-1]) > 0
        cut = np.ones(len(at), bool)
        cut[1:] = (at[1:] != at[:-1] + 1) | (label[1:] != label[:-1]) | (covered[1:] != covered[:-1])
        number = np.cumsum(cut) - 1
        good = covered & (np.bincount(number)[number] >= least)
        if good.all():
            break
        at, label = at[good], number[good]
    else:
        return []
    first = np.ones(len(at), bool)
    first[1:] = label[1:] != label[:-1]
    starts = np.flatnonzero(first)
    return [(int(at[i]), int(at[j - 1]) + 1) for i, j in zip(starts, [*starts[1:], len(at)], strict=True)]


def found(texts: list[list[str]], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    known: dict[str, int] = {}
    codes = np.fromiter((known.setdefault(w, len(known)) for t in texts for w in t), np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    begin, text = np.concatenate([[0], np.cumsum(sizes)]), np.repeat(np.arange(len(texts)), sizes)
    for i, j in stretches(codes, text, least):
        k = int(text[i])
        out[k] += [(s + i - int(begin[k]), n, q) for s, n, q in runs_of(codes[i:j].tolist(), least)]
    return [sorted(x) for x in out]


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words but for those that a run has after its first period, joined by spaces."""
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for s, n, q in runs:
            gone[s + q] += 1
            gone[s + n] -= 1
        words = [w for w, g in zip(words, np.cumsum(gone[:-1]).tolist(), strict=True) if not g]
    return " ".join(words)


def runs(docs: DataFrame, text_col: str = "text", least: int = LEAST) -> DataFrame:
    """The rows with n_words, runs (start, length, period; by start, then period) and collapsed (the text without repeats) instead of the text."""
    word = re.compile(WORD)
    keep = [c for c in docs.columns if c not in (text_col, *_OWN)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column("_text").to_pylist()]
            for part in blocks(texts):
                words = [word.findall(texts[i]) for i in part]
                each = found(words, least)
                flat = np.array([r for x in each for r in x], np.int64).reshape(-1, 3)
                structs = pa.StructArray.from_arrays([pa.array(c) for c in flat.T], ["start", "length", "period"])
                ends = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in each])]), pa.int32())
                columns = [pa.array([len(w) for w in words], pa.int64()), pa.ListArray.from_arrays(ends, structs), pa.array(map(collapsed, words, each), pa.string())]
                yield pa.record_batch([b.column("_row").take(pa.array(part)), *columns], names=["_row", *_OWN])

    rows = docs.select(F.struct(*keep).alias("_row"), F.col(text_col).alias("_text"))
    schema = rows.select("_row").schema.add("n_words", LongType()).add("runs", RUNS).add("collapsed", StringType())
    return rows.mapInArrow(run, schema).select("_row.*", *_OWN)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; for one id of ten by CRC-32, the text's words repeat from some place on with some period, both by the hash.

    The words are made once a row, as a column: a lambda that held their expression would split the text for each word.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
    rows = shielded(F.struct("doc_id", "text"), {"w": words, "g": F.floor(h / 10)}, docs).withColumn("n", F.greatest(F.size("w"), F.lit(1)).cast("bigint"))
    rows = shielded(F.struct("doc_id", "text", "w", "n"), {"a": F.col("g") % F.col("n"), "g": F.col("g")}, rows)
    rows = shielded(F.struct("doc_id", "text", "w", "a"), {"p": 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))}, rows)
    repeated = F.transform("w", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return rows.select("doc_id", F.when(F.col("w").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = runs(planted(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return rows.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("_b"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", (-F.col("_b.start")).alias("start"), F.col("_b.length").alias("length"), (-F.col("_b.period")).alias("period"),
        F.floor(1000 * F.col("_b.length") / -F.col("_b.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
