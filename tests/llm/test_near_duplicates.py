from collections import defaultdict
from itertools import combinations
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from voicegrid.llm import near_duplicates as nd
from voicegrid.llm.common import shared_dir
from voicegrid.llm.components import components

SF = "/root/testdata/sf0.01/documents.parquet"


def brute(rows):
    """Class of each (id, text) by comparing all texts that share a shingle."""
    key = {}
    for i, text in rows:
        w = nd.words(text)
        key[i, text] = " ".join(w) or "\0" + text
    sets = {k: nd.shingles(k.split(" ")) for k in set(key.values()) if not k.startswith("\0")}
    at = defaultdict(set)
    for k, (codes, _) in sets.items():
        for c in codes.tolist():
            at[c].add(k)
    root = {k: k for k in key.values()}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    pairs = {p for ks in at.values() for p in combinations(sorted(ks), 2)}
    for a, b in pairs:
        if nd.similarity(sets[a], sets[b]) >= nd.LIKE:
            root[find(a)] = find(b)
    out = defaultdict(list)
    for (i, _), k in key.items():
        out[find(k)].append(i)
    return {i: min(x) for x in out.values() for i in x}


def test_classes_equal_brute_force(spark):
    docs = spark.read.parquet(SF)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = nd.classes(docs).collect()
    want = brute(rows)
    assert len(got) == len(rows) and {r.doc_id: r.class_id for r in got} == want
    assert len(set(want.values())) < len({t for _, t in rows})
    assert sorted(r.doc_id for r in got if r.kept) == sorted(set(want.values()))
    left = nd.deduplicated(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == sorted(set(want.values()))


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None), (2, None), (3, ""), (4, ""), (5, "..."), (6, "... "), (7, "One two"), (7, "One two"), (8, "one, TWO!"), (9, long), (10, long.replace("w7 ", "x ")), (None, "a b c d e f"), (None, "A b c d e f"), (11, "q r s t u v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit("x"), "th": F.lit(1), "band": F.lit(2)})
    got = sorted((str(r.doc_id), str(r.class_id), r.kept) for r in nd.classes(docs).collect())
    assert [x for x in got if x[0] != "None"] == sorted([("1", "1", True), ("2", "2", True), ("3", "3", True), ("4", "3", False), ("5", "5", True), ("6", "6", True), ("7", "7", True), ("7", "7", True), ("8", "7", False), ("9", "9", True), ("10", "9", False), ("11", "11", True)])
    assert sorted(x[2] for x in got if x[0] == "None") == [False, True]
    left = nd.deduplicated(docs)
    assert left.columns == docs.columns and sorted(str(r.doc_id) for r in left.collect()) == sorted(["1", "2", "3", "5", "6", "7", "9", "None", "11"])
    assert nd.classes(docs.filter("doc_id > 99")).count() == 0


def test_gray_zone_bucket_loses_no_link(spark):
    """A chain in which neighbours are similar and others are not: one class, found although few are like the least."""
    w = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(30):
        rows.append((i, " ".join(w)))
        w = w[8:] + [f"n{i}_{j}" for j in range(8)]
    got = nd.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0}


@pytest.mark.parametrize("n", [0, 1, 50])
def test_components_of_a_chain(spark, n):
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100 + i, 100) for i in range(1, n)], "x long, y long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(n + 1) if n} | {100 + i: 100 for i in range(n) if n > 1}


def test_texts_are_shuffled_once_and_tables_go(spark):
    saved = lambda: {p.name for p in Path(urlparse(shared_dir(spark)).path).glob("saved-*")}
    shared_dir(spark)
    before = saved()
    rows = [(1, "one two three four five six", "a"), (1, "one two three four five six", "b"), (None, "one two three four five six seven eight", "c"), (2, "One two three four five six!", "d"), (3, None, "e"), (3, None, "f")]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = nd.deduplicated(spark.createDataFrame(rows, "doc_id long, text string, m string"))
        assert len(saved() - before) == 1
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning") == 2  # of texts and of the ids that stay
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted([("1", rows[0][1]), ("None", rows[2][1]), ("3", "None"), ("3", "None")])
