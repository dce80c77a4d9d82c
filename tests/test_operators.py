import json
import random
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voicegrid import cli, rules
from voicegrid.functions import jsonfix
from voicegrid.functions import text as X
from voicegrid.operators import clean, generate, grid, profile, schedule
from voicegrid.schemas import AUGMENTED, CORRUPT
from voicegrid.sources import files

POSTS = ["오늘 날씨가 정말 좋네요!", "배고파요.", "뭐 해요?", "그냥", "ㅋ", " ", "", None, "a b　c", "❤️ 좋아요", "가" * 600]


def posts(spark):
    return spark.createDataFrame([(i, x) for i, x in enumerate(POSTS)], "id long, content string")


def test_strip_is_idempotent_and_keeps_null(spark):
    once = posts(spark).select("id", X.strip(F.col("content")).alias("c"))
    twice = once.select("id", X.strip(F.col("c")).alias("c"))
    got = {r.id: r.c for r in once.collect()}
    assert got == {r.id: r.c for r in twice.collect()}
    assert got[8] == "a b c" and got[7] is None and got[5] == ""


def test_quality_and_keep_first(spark):
    kept = {r.id for r in clean.quality(posts(spark)).collect()}
    assert kept == {0, 1, 2, 8, 9}
    twice = posts(spark).unionByName(posts(spark).withColumn("id", F.col("id") + 100))
    assert sorted(r.id for r in clean.keep_first(twice, "content", "id").collect()) == list(range(len(POSTS)))


def test_rule_transform_on_korean(spark):
    out = generate.transform(posts(spark), "id")
    assert out.count() == 12 * len(POSTS) and set(out.columns) == {"id", *AUGMENTED.names}
    rows = {(r.id, r.post_type, r.emotion): r.transformed_content for r in out.collect()}
    for p, endings in rules.ENDINGS.items():
        said = rows[0, p, "grumpy"]
        assert any(said == f"오늘 날씨가 정말 좋{e}!" for e in endings)
        assert rows[0, p, "sad"].endswith(" 😢") and rows[7, p, "sad"] is None
    assert rows == {(r.id, r.post_type, r.emotion): r.transformed_content for r in out.collect()}


def test_picks_and_quotas(spark):
    df = spark.range(200).withColumn("cell", F.col("id") % 7)
    picks = grid.n_emotions(df, "id", 2).groupBy("id").agg(F.countDistinct("emotion").alias("n")).collect()
    assert len(picks) == 200 and {r.n for r in picks} == {2}
    n = [r["count"] for r in grid.balanced(df, ["cell"], "id", 20).groupBy("cell").count().collect()]
    assert n == [20] * 7
    assert grid.target_count(df, "id", 33).count() == 33
    assert grid.topics_by_emotion(spark).distinct().count() == 138


def test_domain_check_and_merge(spark):
    rows = [("a", "Happy", "cat", "x"), ("a", "odd", "cat", "x"), ("a", "sad", "dog", None), (None, None, None, None)]
    df = spark.createDataFrame(rows, AUGMENTED)
    good, bad = clean.domain_check(df)
    assert good.count() == 1 and bad.count() == 3
    assert clean.merge([df, df]).count() == 8 and clean.merge([df, df], AUGMENTED.names).count() == 4
    assert clean.merge([df, df.drop("emotion")]).count() == 8


def test_json_repair(spark):
    good = '{"transformed_content": "냥, }"}'
    raws = [good, f"```json\n{good}\n```", '{"transformed_content": "a",}', "{'transformed_content': 'a'}", '{"transformed_content": "a"', "", "prose", '["a"]', '{"transformed_content": "a", "more": [1, 2,]}', None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "id long, raw string")
    good_rows, quarantine = generate.parsed(df)
    got = {r.id: r.transformed_content for r in good_rows.collect()}
    assert got == {0: "냥, }", 1: "냥, }", 2: "a", 3: "a", 4: "a", 8: "a"}  # 4 is cut after a whole member
    assert sorted(r.id for r in quarantine.collect()) == [5, 6, 7, 9]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.sampled_from(["k", "m"]), st.one_of(st.integers(), st.text("ab,}] ", max_size=5))), max_size=5))
def test_repair_never_changes_what_parses(spark, objects):
    df = spark.createDataFrame([(json.dumps(o),) for o in objects], "raw string")
    both = df.select(jsonfix.parse(F.col("raw"), "k string, m string").alias("a"), jsonfix.parse(F.col("raw"), "k string, m string", fix=False).alias("b")).collect()
    assert all(r.a == r.b for r in both)


def test_model_seam_keeps_errors(spark):
    def model(prompt):
        if "배고파" in prompt:
            raise TimeoutError("no answer")
        return '{"transformed_content": "냥"}'

    df = generate.with_prompt(grid.fan_out(posts(spark).filter("id < 3")))
    out = generate.call_model(df, model).cache()
    assert out.count() == 36 and out.filter("error is not null").count() == 12 and out.select("request_id").distinct().count() == 36
    good, bad = generate.parsed(out)
    assert good.count() == 24 and bad.count() == 12


def test_schedule(spark):
    calls = spark.range(500).select(F.col("id").alias("call_id"), F.timestamp_seconds(F.col("id") * 13).alias("ts"), (F.col("id") % 4).alias("key_id"))
    plan = schedule.round_robin(calls, "ts", "call_id").collect()
    assert sorted(r.pos for r in plan) == list(range(500)) and max(r.key_id for r in plan) == 8
    by = {}
    for r in plan:
        by[r.key_id, r.minute] = by.get((r.key_id, r.minute), 0) + 1
    assert max(by.values()) == 15
    same = spark.createDataFrame([(i, 0, 0) for i in range(16)] + [(i, 1, 59 + (i > 30) * 2) for i in range(20, 50)], "call_id long, key_id long, s long").withColumn("ts", F.timestamp_seconds("s"))
    ok = schedule.admitted(same, "ts", "key_id", "call_id").filter("admitted").groupBy("key_id").count().collect()
    assert {r.key_id: r["count"] for r in ok} == {0: 15, 1: 26}
    recent = {r.call_id: r.n_recent for r in schedule.rolling_usage(same, "ts", "key_id", 60).collect()}
    assert recent[15] == 16 and recent[49] == 30


def test_rolling_usage_of_busy_intervals(spark):
    r = random.Random(7)
    rows = [(i, r.choice([None, 0, 1]), None if i % 50 == 0 else r.randrange(-3_000_000, 9_000_000) // 250_000 * 250_000) for i in range(2000)]
    calls = spark.createDataFrame(rows, "call_id long, key_id long, us long").withColumn("ts", F.timestamp_micros("us"))
    near = lambda t, u: u == t if t is None or u is None else t - 2_000_000 <= u <= t
    want = {i: sum(k == m and near(t, u) for _, m, u in rows) for i, k, t in rows}
    found = schedule.rolling_usage(calls, "ts", "key_id", 2)
    assert {x.call_id: x.n_recent for x in found.collect()} == want and found.columns == [*calls.columns, "n_recent"]
    # a frame that slides over an interval would go over its rows again for each row
    frames = re.findall(r"specifiedwindowframe\((.*?)\)", found._jdf.queryExecution().optimizedPlan().toString(), re.I)
    assert frames and all("unboundedpreceding$" in f for f in frames)


def test_profile(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 3, "k string")
    r = profile.balance(df, "k").first()
    assert (r.spread, r.ratio, r.entropy, r.chi2) == (0, 1.0, 1.0, 0.0)
    assert sum(x.pct for x in profile.shares(df, ["k"]).collect()) == 100


def test_files(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text('{"content": "냥"}\n\n{"content": \n{"content": 3}\n', encoding="utf-8")
    good, bad = files.split_corrupt(files.read_originals(spark, str(tmp_path / "bad.jsonl")).cache())
    assert sorted(r.content for r in good.collect()) == ["3", "냥"] and [r[CORRUPT] for r in bad.collect()] == ['{"content": ']
    rows = [("a", "sad", "cat", None), ("❤️", "sad", "cat", "냥 😢")]
    files.write_jsonl(spark.createDataFrame(rows, AUGMENTED), str(tmp_path / "out"), one_file=True)
    lines = "".join(p.read_text("utf-8") for p in (tmp_path / "out").glob("part-*"))
    assert '"transformed_content":null' in lines and "😢" in lines
    assert sorted(map(tuple, files.read_augmented(spark, str(tmp_path / "out")).drop(CORRUPT).collect()), key=str) == sorted(rows, key=str)
    (tmp_path / "all.json").write_text(json.dumps([dict(zip(AUGMENTED.names, r)) for r in rows]), encoding="utf-8")
    files.unify(spark, str(tmp_path / "all.json"), str(tmp_path / "lines"), AUGMENTED)
    assert files.read_augmented(spark, str(tmp_path / "lines")).count() == 2
    (tmp_path / ".env").write_text("# no\nVG_KEY_1='a=b'\nOTHER=1\n")
    assert files.read_env(str(tmp_path / ".env"), "VG_") == {"VG_KEY_1": "a=b"}


def test_cli(spark, tmp_path):
    (tmp_path / "posts.jsonl").write_text("".join(json.dumps({"content": f"오늘은 {i}번째 날이에요!"}) + "\n" for i in range(30)), encoding="utf-8")
    run = lambda *a: cli.main(list(map(str, a)), spark)
    run("transform", "--input_file", tmp_path / "posts.jsonl", "--output_file", tmp_path / "aug", "--target_count", 100)
    out = files.read_augmented(spark, str(tmp_path / "aug")).drop(CORRUPT)
    assert out.count() == 100 and clean.domain_check(out)[1].count() == 0
    n = [r["count"] for r in out.groupBy("post_type", "emotion").count().collect()]
    assert len(n) == 12 and max(n) - min(n) <= 9
    run("transform", "--input_file", tmp_path / "posts.jsonl", "--output_file", tmp_path / "two", "--n_emotions", 2)
    assert files.read_augmented(spark, str(tmp_path / "two")).count() == 30 * 2 * 2
    run("generate", "--output_file", tmp_path / "gen", "--count", 200)
    assert files.read_originals(spark, str(tmp_path / "gen")).count() == 200
    run("merge", "--input_file", tmp_path / "aug", tmp_path / "two", "--output_file", tmp_path / "both")
    assert files.read_augmented(spark, str(tmp_path / "both")).count() == 220
    run("profile", "--input_file", tmp_path / "both", "--output_prefix", tmp_path / "chart")
    assert len(list(tmp_path.glob("chart_*.png"))) == 4
    (tmp_path / "crawl.txt").write_text("좋은 아침이에요\n좋은  아침이에요\n짧\n", encoding="utf-8")
    run("filter", "--input_file", tmp_path / "crawl.txt", "--output_file", tmp_path / "kept")
    assert files.read_originals(spark, str(tmp_path / "kept")).count() == 1
