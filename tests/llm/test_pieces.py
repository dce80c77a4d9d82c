import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voicegrid.llm import pieces

SF = "/root/testdata/sf0.01"
MODEL = open(pieces.MODEL, "rb").read()
LIB = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
ODD = ["", " ", "  ", "a", " a", "a ", "a  b   c", "\n", "a\nb\n\n c", "\t x", "é日本😀 ▁x", "\0", "<s> <0x41>", "x" * 3000, " " * 3000, "9" * 500, "aaaa" * 300, "ＡＢ ﬁ", "­a​b", "ab\r\ncd"]


def as_unigram(model):
    """The same pieces and scores in a unigram model: the field model_type of the trainer settings says so."""
    out, at = bytearray(), 0
    trainer = next(v for k, v in pieces.fields(model) if k == 2)
    i = model.index(trainer)
    at = 0
    while trainer[at] != 0x18:  # number 3, a varint
        key = trainer[at]
        assert key < 128
        at += 1
        if key & 7 == 0:
            while trainer[at] > 127:
                at += 1
            at += 1
        elif key & 7 == 2:
            n = shift = 0
            while True:
                n |= (trainer[at] & 127) << shift
                shift += 7
                at += 1
                if trainer[at - 1] < 128:
                    break
            at += n
        else:
            at += 4 if key & 7 == 5 else 8
    out += model
    out[i + at + 1] = pieces.UNIGRAM
    return bytes(out)


def test_bpe_equals_library(spark):
    v = pieces.Vocabulary(MODEL)
    assert v.kind == pieces.BPE and v.plain
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for t, ids in zip(texts, v.encode(texts)):
        assert ids.tolist() == LIB.encode(t), t[:200]
        assert v.decode(ids) == LIB.decode(ids.tolist())


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aeinorst  \n▁éЖ日1.,'\t"), max_size=60))
def test_bpe_equals_library_on_any_text(text):
    v = pieces.vocabulary(MODEL)
    assert v.encode([text])[0].tolist() == LIB.encode(text)


def score(v, found):
    return sum(v.score.get(p, v.unknown_score) for p in found)


def test_unigram_finds_the_best_sum_of_scores():
    v = pieces.Vocabulary(as_unigram(MODEL))
    assert v.kind == pieces.UNIGRAM
    rng = random.Random(1)
    words = sorted({pieces.MARK + "".join(rng.choice("aeinorstЖ") for _ in range(rng.randint(1, 9))) for _ in range(200)})
    for w, ids in v.encode_words(words).items():
        best = [0.0]
        for j in range(1, len(w) + 1):
            best.append(max(best[i] + v.score.get(w[i:j], v.unknown_score if j == i + 1 else float("-inf")) for i in range(j)))
        if "Ж" in v.id or "Ж" not in w:
            assert abs(score(v, [v.lib.id_to_piece(int(i)) for i in memoryview(ids).cast("i")]) - best[-1]) < 1e-6


def test_shared_prefixes_change_nothing():
    v, w = pieces.Vocabulary(MODEL), pieces.Vocabulary(MODEL)
    words = sorted({"▁" + x for x in ("a", "an", "ant", "antique", "antiquity", "anti", "b", "", "banana", "band")})
    assert v.encode_words(words) == {x: w.encode_words([x])[x] for x in words}


def test_query(spark):
    rows = pieces.op5(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    assert all(r.round_trip and r.n_tokens == len(r.ids) and r.ids == LIB.encode(texts[r.doc_id]) for r in rows)


def test_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, None), (None, "x"), (0, ""), (0, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit(1), "_x": F.lit("k"), "n_tokens": F.lit("q")})
    out = pieces.encode(df)
    assert out.columns == ["doc_id", "_x", "n_tokens", "ids", "round_trip"] and out.count() == len(rows)
    assert sum(r.ids is None for r in out.collect()) == 1
    back = pieces.decode(out)
    assert sorted((str(r.doc_id), str(r.text)) for r in back.collect()) == sorted((str(i), str(t and t.replace("▁", " "))) for i, t in rows)
    assert pieces.encode(df.filter("doc_id > 99")).count() == 0


@pytest.mark.parametrize("texts", [[], [None], ["a" * 3, None, "b"]])
def test_blocks(texts):
    assert [i for b in pieces.blocks(texts) for i in b] == [i for i, t in enumerate(texts) if t is not None]
