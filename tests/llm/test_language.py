import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from voicegrid.llm import language as lg

SF = "/root/testdata/sf0.01"


def plain(text):
    """N-gram counts word by word."""
    out = Counter()
    clean = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
    for w in clean.split(" "):
        if w:
            w = f" {w} "
            for n in range(1, lg.ORDERS + 1):
                for i in range(len(w) - n + 1):
                    if w[i : i + n] != " ":
                        out[w[i : i + n]] += 1
    return out


def code(gram):
    x = np.array([ord(c) for c in gram], np.uint64)
    h = np.zeros(1, np.uint64)
    for c in x:
        h = (h ^ c) * lg.MIX
        h ^= h >> np.uint64(29)
    return int(h[0])


@pytest.mark.parametrize("text", ["", "a", "The cat, the CAT", "é日本 ßİ x1y", "..1..", "ab " * 50, "word" * 400])
@pytest.mark.parametrize("piece", [1 << 20, 16])
def test_counts_equal_plain_counts(monkeypatch, text, piece):
    monkeypatch.setattr(lg, "PIECE", piece)
    codes, n = lg.counted(text)
    assert dict(zip(codes.tolist(), n.tolist())) == {code(g): k for g, k in plain(text).items()}


def test_distance_equals_plain_distance():
    profiles = {k: lg.ranked(*lg.counted(t)) for k, t in {"x": "the cat sat on the mat", "y": "der hund und die katze"}.items()}
    doc = lg.ranked(*lg.counted("the dog and the cat"))
    out = {k: sum(abs(p.tolist().index(g) - i) if g in p.tolist() else lg.SIZE for i, g in enumerate(doc.tolist())) for k, p in profiles.items()}
    best = min(out, key=lambda k: (out[k], k))
    assert lg.Profiles(profiles).nearest(doc) == (best, 1 - out[best] / (lg.SIZE * len(doc)))


def test_held_out_accuracy(spark):
    got = lg.op1(spark, SF)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [lang[r.doc_id] == r.lang_pred for r in rows if r.held_out]
    assert sum(held) >= 0.99 * len(held)


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 !?", "de"), (4, "the cat and the dog", "en"), (4, "the cat and the dog", "en"), (None, "der hund und die katze", "de"), (5, "und der mann", None), (6, "a" * 500_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"_text": F.lit("x"), "score": F.lit(1), "_l": F.lit(2)})
    out = lg.predict(df, lg.learn(df, F.lit(True)))
    assert out.columns == ["doc_id", "lang", "_text", "_l", "lang_pred", "score"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] == "en" and got[None][0] == got[5][0] == "de"
    assert {r.lang_pred for r in lg.predict(df, lg.learn(df.filter("doc_id > 99"), F.lit(True))).collect()} == {"und"}
    assert lg.predict(df.filter("doc_id > 99"), {}).count() == 0


def test_the_whole_query_equals_a_plain_one(spark, monkeypatch):
    """Learning from the first documents of each language, ranks and distances, with dictionaries instead of arrays."""
    monkeypatch.setattr(lg, "SAMPLE", 15)
    small, mask = SF.replace("0.01", "0.001"), (1 << 64) - 1
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    fold = {i: zlib.crc32(str(i).encode()) % 3 for i, _, _ in docs}
    counts, codes = {i: plain(t or "") for i, t, _ in docs}, {}
    for gram in {g for c in counts.values() for g in c}:
        h = 0
        for c in gram:
            h = (h ^ ord(c)) * int(lg.MIX) & mask
            h ^= h >> 29
        codes[gram] = h
    signed = lambda g: codes[g] - (codes[g] >> 63 << 64)
    profiles = {}
    for lang in {x for i, t, x in docs if x is not None and t is not None and fold[i] != 1}:
        own = sorted((hashlib.md5(str(i).encode()).hexdigest()[:8], i) for i, t, x in docs if x == lang and t is not None and fold[i] != 1)
        total = sum((counts[i] for _, i in own[:15]), Counter())
        profiles[lang] = {g: k for k, g in enumerate(sorted(total, key=lambda g: (-total[g], signed(g)))[: lg.SIZE])}
    want = {}
    for i, _, _ in docs:
        top = sorted(counts[i], key=lambda g: (-counts[i][g], codes[g]))[: lg.SIZE]
        out = {x: sum(min(abs(p[g] - k), lg.SIZE) if g in p else lg.SIZE for k, g in enumerate(top)) for x, p in profiles.items()}
        best = min(out, key=lambda x: (out[x], x))
        want[i] = (fold[i] == 1, best, 1 - out[best] / (lg.SIZE * len(top))) if top else (fold[i] == 1, "und", 0.0)
    assert {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in lg.op1(spark, small).collect()} == want
