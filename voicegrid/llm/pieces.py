"""SentencePiece encoding and decoding by a shared-prefix Viterbi.

A normalised text falls into marked words: a run of marks (the escaped space) with what follows, up to the next mark; line
feeds stand alone. No piece crosses such a cut; a model with one that does has its texts encoded whole. The distinct words of
a block are sorted, which makes them the depth-first order of their trie: the forward states of a word's prefix are those of
its predecessor up to the characters they share, and only the rest is computed.

The forward state of a prefix depends on the model's type. Unigram: the best score of a segmentation and its last piece.
BPE: the last piece of the prefix's own encoding. A sequence of pieces is a BPE encoding if and only if each two neighbours
are one, so that exactly one piece ends a prefix and agrees with the state before it: a Viterbi whose transitions are
possible or not. The highest sum of scores would not be the library's encoding of a BPE model; this is. Words with several
marks in a row, whose pieces tie in score, are merged pair by pair.

Characters without a piece become the pieces of their UTF-8 bytes, if the model has these, else the unknown piece.

The vocabulary file is read on the driver and sent to executors. Nothing is shuffled, texts are taken whole. Null texts
have null ids and decode to null; the empty text has no ids. A mark in the text itself decodes to a space, as in the library.
Rows that repeat are encoded alike.
"""

import heapq
import re
import struct
from collections import defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType

from voicegrid.llm.common import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CACHE, BLOCK = 200_000, 1 << 20
UNIGRAM, BPE = 1, 2
WHOLE = r"(?s).+"
UNKNOWN_PENALTY = 10.0


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protocol buffer message's fields."""

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    at = 0
    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + n]
            at += n


class Packed(dict):
    """Ids of pieces, as bytes of 32-bit integers; of other characters those of their UTF-8 bytes, or the unknown piece's."""

    def __init__(self, of: "Vocabulary"):
        self.of = of
        super().__init__({p: struct.pack("=i", i) for p, i in of.id.items()})

    def __missing__(self, char: str) -> bytes:
        return b"".join(struct.pack("=i", self.of.bytes[b]) for b in char.encode("utf-8", "replace")) if self.of.bytes else struct.pack("=i", self.of.unknown)


class Vocabulary:
    """Pieces of a model, and the encoding of words."""

    def __init__(self, model: bytes):
        parts = dict(x for x in fields(model) if x[0] in (2, 3))  # trainer and normaliser settings
        self.kind = dict(fields(parts.get(2, b""))).get(3, UNIGRAM)
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are known")
        self.lib = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        settings = dict(fields(parts.get(3, b"")))
        #: Marks for spaces and one in front are all that the normaliser does.
        self.plain = not settings.get(2) and settings.get(3, 1) == 1 and settings.get(4, 1) == 0 and settings.get(5, 1) == 1
        n = sp.get_piece_size()
        usual = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.id = {sp.id_to_piece(i): i for i in usual}
        self.score = {p: sp.get_score(i) for p, i in self.id.items()}
        self.unknown, self.unknown_score = sp.unk_id(), min(self.score.values(), default=0.0) - UNKNOWN_PENALTY
        self.bytes = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        text = {i: sp.id_to_piece(i).replace(MARK, " ").encode() for i in usual}
        self.text = [bytes([int(sp.id_to_piece(i)[1:-1], 16)]) if sp.is_byte(i) else text.get(i, " ⁇ ".encode() if i == self.unknown else b"") for i in range(n)]
        cut = all(MARK not in p.lstrip(MARK) and ("\n" not in p or p == "\n") for p in self.id)
        self.word = re.compile(rf"\n|{MARK}*[^{MARK}\n]+|{MARK}+" if cut else WHOLE)
        self.halves: dict[str, tuple[str, str] | None] = {}
        self.agree: dict[str, dict[str, bool]] = defaultdict(dict)
        self.agreed = 0
        #: Ends of pieces, and whether they are pieces themselves.
        self.tails = {p[i:]: False for p in self.id for i in range(len(p))} | dict.fromkeys(self.id, True)
        self.packed = Packed(self)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def normalised(self, text: str) -> str:
        if not text:
            return ""
        return MARK + text.replace(" ", MARK) if self.plain else self.lib.normalize(text)

    def merged(self, word: str, stop: int = 1) -> list[str]:
        """BPE by definition: the pair with the best score merges, the first of equals, while there are more than `stop`."""
        part, left, right = list(word), list(range(-1, len(word) - 1)), list(range(1, len(word) + 1))
        heap, alive = [], len(part)

        def offer(i: int) -> None:
            if i >= 0 and right[i] < len(part) and (s := self.score.get(part[i] + part[right[i]])) is not None:
                heap.append((-s, i, part[i], part[right[i]]))

        for i in range(len(part) - 1):
            offer(i)
        heapq.heapify(heap)
        while heap and alive > stop:
            _, i, a, b = heapq.heappop(heap)
            j = right[i] if part[i] else len(part)
            if part[i] != a or j >= len(part) or part[j] != b:
                continue
            part[i], part[j], right[i], alive = a + b, "", right[j], alive - 1
            if right[i] < len(part):
                left[right[i]] = i
            for k in (left[i], i):
                if k >= 0 and right[k] < len(part) and (s := self.score.get(part[k] + part[right[k]])) is not None:
                    heapq.heappush(heap, (-s, k, part[k], part[right[k]]))
        return [p for p in part if p]

    def split(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge makes this one; None for characters."""
        if piece not in self.halves:
            two = self.merged(piece, 2) if len(piece) > 1 else []
            self.halves[piece] = (two[0], two[1]) if len(two) == 2 else None
        return self.halves[piece]

    def neighbours(self, a: str, b: str) -> bool:
        """Whether BPE leaves these two pieces apart: merges undone from the last, none across the border comes before."""
        x, y, limit = a, b, None
        while True:
            across = self.score.get(x + y)
            # a merge across wins by a better score than the side's, or by an equal one if it lies to the left of it
            if across is not None and (limit is None or across > limit[0] or across == limit[0] and limit[1]):
                return False
            sx, sy = self.split(x), self.split(y)
            if sx is None and sy is None:
                return True
            if sy is None or sx is not None and self.score[x] < self.score[y]:
                limit, x = (self.score[x], False), sx[1]
            else:
                limit, y = (self.score[y], True), sy[0]

    def ending(self, word: str, j: int) -> list[tuple[int, str]]:
        """Start and string of the pieces that end word[:j], longest last; the last character, if there are none."""
        out, i, tails = [], j - 1, self.tails
        while i >= 0 and (whole := tails.get(p := word[i:j])) is not None:
            if whole:
                out.append((i, p))
            i -= 1
        return out or [(j - 1, word[j - 1])]

    def step_bpe(self, word: str, j: int, states: list) -> str:
        """The last piece of the encoding of word[:j]; states[i] is that of word[:i]."""
        for i, p in reversed(self.ending(word, j)):
            if i == 0:
                return p
            known = self.agree[states[i]]
            if (yes := known.get(p)) is None:
                self.agreed += 1
                yes = known[p] = states[i] not in self.id or p not in self.id or self.neighbours(states[i], p)
            if yes:
                return p
        return word[j - 1]

    def step_unigram(self, word: str, j: int, states: list) -> tuple[float, str]:
        """The best score of word[:j] and its last piece."""
        return max(((states[i][0] + self.score.get(p, self.unknown_score), p) for i, p in self.choices(word, j)), key=lambda x: x[0])

    def choices(self, word: str, j: int) -> list[tuple[int, str]]:
        found = self.ending(word, j)
        return found if found[0][0] == j - 1 else [(j - 1, word[j - 1]), *found]

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of sorted distinct words, as bytes of 32-bit integers."""
        bpe, ids = self.kind == BPE, self.packed.__getitem__
        step, states, last, out = self.step_bpe if bpe else self.step_unigram, ["" if bpe else (0.0, "")], "", {}
        if self.agreed > 2 * CACHE:
            self.agree.clear()
            self.agreed = 0
        for word in words:
            if bpe and MARK + MARK in word:
                out[word] = b"".join(map(ids, self.merged(word)))
                continue
            same, most = 0, min(len(last), len(word))
            while same < most and last[same] == word[same]:
                same += 1
            del states[same + 1 :]
            for j in range(same + 1, len(word) + 1):
                states.append(step(word, j, states))
            last, pieces, j = word, [], len(word)
            while j:
                p = states[j] if bpe else states[j][1]
                pieces.append(p)
                j -= len(p)
            out[word] = b"".join(map(ids, pieces[::-1]))
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.word.findall(self.normalised(t)) for t in texts]
        need = set().union(*split) - self.cache.keys()
        if len(self.cache) + len(need) > CACHE:  # what was in use lately stays for a while
            self.older, self.cache = self.cache, {}
            need = set().union(*split)
        again = need & self.older.keys()
        self.cache |= {w: self.older[w] for w in again}
        self.cache |= self.encode_words(sorted(need - again))
        return [np.frombuffer(b"".join(map(self.cache.__getitem__, w)), np.int32) for w in split]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.text.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text.removeprefix(" ") if self.plain else text.lstrip(" ")


_known: dict[bytes, Vocabulary] = {}


def vocabulary(model: bytes) -> Vocabulary:
    if model not in _known:
        _known.clear()
        _known[model] = Vocabulary(model)
    return _known[model]


def blocks(texts: list[str | None]) -> Iterator[list[int]]:
    """Indices of the texts that aren't null, in runs of about BLOCK characters."""
    run, n = [], 0
    for i, t in enumerate(texts):
        if t is not None:
            run.append(i)
            n += len(t)
            if n >= BLOCK:
                yield run
                run, n = [], 0
    if run:
        yield run


def encode(docs: DataFrame, model: str = MODEL, text_col: str = "text", check: bool = True) -> DataFrame:
    """The rows with n_tokens, ids and, if asked, round_trip (whether the ids decode to the text) instead of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(Path(model).read_bytes())
    own = ["n_tokens", "ids", *["round_trip"] * check]
    keep = [c for c in docs.columns if c not in (text_col, *own)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(shared.value)
        for b in batches:
            texts = b.column("_text").to_pylist()
            for part in blocks(texts):
                found = known.encode([texts[i] for i in part])
                ends = np.concatenate([[0], np.cumsum([len(x) for x in found])])
                columns = [pa.array(np.diff(ends), pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)))]
                if check:
                    columns.append(pa.array([known.decode(x) == texts[i].replace(MARK, " ") for i, x in zip(part, found, strict=True)]))
                rows = b.take(pa.array(part))
                yield pa.record_batch([rows.column("_row"), *columns], names=["_row", *own])
            if none := [i for i, t in enumerate(texts) if t is None]:
                rows = b.take(pa.array(none))
                yield pa.record_batch([rows.column("_row"), pa.array([0] * len(none), pa.int64()), pa.nulls(len(none), pa.list_(pa.int32())), *[pa.nulls(len(none), pa.bool_())] * check], names=["_row", *own])

    rows = docs.select(F.struct(*keep).alias("_row"), F.col(text_col).alias("_text"))
    schema = rows.select("_row").schema.add("n_tokens", LongType()).add("ids", ArrayType(IntegerType()))
    return rows.mapInArrow(run, schema.add("round_trip", BooleanType()) if check else schema).select("_row.*", *own)


def decode(df: DataFrame, model: str = MODEL, ids_col: str = "ids", to: str = "text") -> DataFrame:
    """The rows with the text of their ids instead of the ids."""
    shared = df.sparkSession.sparkContext.broadcast(Path(model).read_bytes())
    keep = [c for c in df.columns if c not in (ids_col, to)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(shared.value)
        for b in batches:
            texts = [None if x is None else known.decode(np.array(x, np.int32)) for x in b.column("_ids").to_pylist()]
            yield pa.record_batch([b.column("_row"), pa.array(texts, pa.string())], names=["_row", to])

    rows = df.select(F.struct(*keep).alias("_row"), F.col(ids_col).alias("_ids"))
    return rows.mapInArrow(run, rows.select("_row").schema.add(to, StringType())).select("_row.*", to)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
