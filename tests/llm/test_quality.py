import zlib

from pyspark.sql import functions as F

from voicegrid.llm import quality_classifier as qc
from voicegrid.llm import quality_rules as qr

SF = "/root/testdata/sf0.01"
GOOD = " ".join(f"word{i} is fine" for i in range(40))
ROWS = [(1, None), (2, ""), (3, " \n\t\x0b\x1c "), (4, "a b c a b c"), (5, GOOD), (6, GOOD), (6, GOOD), (None, GOOD), (7, "x\n\nx\n \nx\n"), (8, "a b a b a b a b"), (9, "#*$ %&| <> é 日本"), (10, "w " * 30_000), (11, " ".join(map(str, range(30_000))))]


def repeated(w):
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i : i + 3]), []).append(i)
    return len({j for x in at.values() if len(x) > 1 for i in x for j in range(i, i + 3)})


def test_base_measures(spark):
    import re

    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(2).withColumns({"_w": F.lit(1), "_row": F.lit(2), "score": F.lit("x")})
    trusted = spark.createDataFrame([(5,)], "_id long")
    out = qr.judge(df, trusted)
    assert out.columns == ["doc_id", "text", "_w", "_row", "word_chars", "n_symbols", "n_dup_lines", "n_words", "n_repeat_words", "base_failed", "score", "kept"]
    got = out.collect()
    assert len(got) == len(ROWS)
    for r in got:
        t = r.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        n = repeated(w)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), n)
        assert r.base_failed == (len(w) < 50 or 100 * n > 50 * len(w)) and r.kept == (not r.base_failed and r.score >= qr.THRESHOLD)
    assert qr.judge(df.filter("doc_id > 99"), trusted).count() == 0
    none = qr.judge(df, trusted.filter("_id > 99")).collect()
    assert {r.score for r in none} == {0.0} and sum(r.kept for r in none) == sum(not r.base_failed for r in none)


def test_rules_tell_labelled_documents_apart(spark):
    out = qr.op2(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("not base_failed")
    n = {(r.quality, r.kept): r["count"] for r in out.groupBy("quality", "kept").count().collect()}
    assert n[1, True] >= 0.99 * (n[1, True] + n.get((1, False), 0)) and n[0, False] >= 0.95 * (n[0, False] + n.get((0, True), 0))


def test_classifier_on_held_out_documents(spark):
    out = qc.op4(spark, SF)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    y = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(r.predicted, y[r.doc_id]) for r in rows if r.held_out and r.doc_id in y]
    assert sum(a == b for a, b in held) >= 0.93 * len(held)
    assert sorted(rows) == sorted(qc.op4(spark, SF).collect())


def test_classifier_odd_rows(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumns({"_text": F.lit("x"), "score": F.lit(1)})
    labels = spark.createDataFrame([(1, 0), (5, 1), (5, 0), (8, None), (None, 1), (9, 7), (77, 1)], "doc_id long, quality int")
    w = qc.fit(df, qc.sample(labels, F.lit(True)))
    out = qc.score(df, w)
    assert out.columns == ["doc_id", "_text", "score"] and out.count() == len(ROWS)
    assert {r.score for r in qc.score(df, qc.fit(df, qc.sample(labels.filter("doc_id > 99"), F.lit(True)))).collect()} == {0.5}
    assert qc.score(df.filter("doc_id > 99"), w).count() == 0
