import json
import time

from pyspark.sql import functions as F

from voicegrid import cli
from voicegrid.operators import clean, generate, grid, profile, progress
from voicegrid.sources import charts, files


def test_allowance_waits_until_the_window_has_passed():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    a = generate.Allowance(2, 60, lambda: now[0], sleep)
    for _ in range(5):
        a.wait()
    assert slept == [60.0, 60.0]


def test_each_key_has_its_own_calls(spark):
    posts = spark.createDataFrame([(i, f"post {i}") for i in range(40)], "id long, content string")
    rows = generate.with_prompt(grid.fan_out(posts).filter("emotion = 'sad' and post_type = 'cat'"))
    out = generate.call_model(rows, lambda prompt, key: f"{key}:{prompt[-2:]}", keys=["k0", "k1", "k2"], per_minute=1000).collect()
    assert len(out) == 40 and all(r.raw.startswith(f"k{r.key_id}:") and r.error is None for r in out) and {r.key_id for r in out} == {0, 1, 2}


def test_tries_count_against_the_allowance_and_errors_stay(spark):
    rows = spark.createDataFrame([("p", "r")], "prompt string, request_id string")

    def broken(prompt):
        raise ValueError("no")

    r = generate.call_model(rows, broken, keys=1, attempts=3, per_minute=2, seconds=0.2).collect()[0]
    assert r.raw is None and r.error == "ValueError: no"


def test_observed_counts(spark):
    df, seen = progress.observed(spark.range(10), "t", odd=F.col("id") % 2 == 1)
    df.collect()
    assert seen.get == {"rows": 10, "odd": 5} and progress.bar(1, 2, 4) == "[##..] 1/2" and list(progress.task_shares(spark)) == []


def test_newest_and_counts_by_file(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, None, "z"), (None, 3, "w")], "k string, v int, t string")
    assert sorted(r.t for r in clean.newest(df, ["k"], "v").collect()) == ["w", "y"]
    for name, n in (("one", 2), ("two", 1)):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps({"content": "abc"}) for _ in range(n)))
    found = profile.counts_by_file(files.read_originals(spark, str(tmp_path / "*.jsonl")), "content").collect()
    assert {(r.file, r.n, r.mean_chars) for r in found} == {("one.jsonl", 2, 3.0), ("two.jsonl", 1, 3.0)}


def test_a_folder_of_part_files_counts_as_one_file(spark, tmp_path):
    rows = spark.createDataFrame([(i, "ab", i % 2) for i in range(10)], "i long, text string, half int")
    rows.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    rows.repartition(2).write.partitionBy("half").parquet(str(tmp_path / "halves"))
    (tmp_path / "single").mkdir()
    for i in range(2):
        rows.toPandas().to_parquet(tmp_path / f"v1.{i}.parquet")
        rows.toPandas().to_parquet(tmp_path / "single" / f"of.{i}.parquet")
    (tmp_path / "data.parquet").mkdir()
    rows.toPandas().to_parquet(tmp_path / "data.parquet" / "data_0.parquet")
    rows.toPandas().to_parquet(tmp_path / "data.parquet" / "data_1.parquet")
    said = lambda *names: {r.file: (r.n, r.mean_chars) for r in profile.counts_by_file(spark.read.parquet(*[str(tmp_path / n) for n in names]), "text").collect()}
    assert said("documents.parquet") == {"documents.parquet": (10, 2.0)}
    assert said("halves") == {"halves": (10, 2.0)}
    assert said("data.parquet") == {"data.parquet": (20, 2.0)}
    assert said("v1.0.parquet", "v1.1.parquet") == {"v1.0.parquet": (10, 2.0), "v1.1.parquet": (10, 2.0)}
    assert said("single") == {"of.0.parquet": (10, 2.0), "of.1.parquet": (10, 2.0)}


def test_corrupt_lines_go_to_quarantine(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"content": "오늘 날씨가 좋네요"}\n{"content": broken\n')
    cli.main(["transform", "--input_file", str(tmp_path / "in.jsonl"), "--output_file", str(tmp_path / "out")], spark)
    assert spark.read.json(str(tmp_path / "out")).count() == 12
    assert [r.value for r in spark.read.text(str(tmp_path / "out_corrupt")).collect()] == ['{"content": broken']


def test_originals_from_a_model(spark, tmp_path):
    (tmp_path / ".env").write_text("API_KEY_1=a\nAPI_KEY_2=b\nOTHER=c\n")
    cli.main(["generate", "--count", "20", "--output_file", str(tmp_path / "out"), "--model", "tests.fake_model:write", "--env", str(tmp_path / ".env"), "--per_minute", "100"], spark)
    rows = [r.content for r in spark.read.json(str(tmp_path / "out")).collect()]
    assert len(rows) == 20 and all(r.startswith(("a wrote: Write one", "b wrote: Write one")) for r in rows)


def test_posts_from_a_model_and_its_failures(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"content": "오늘 날씨가 좋네요"}\n{"content": "배고파요 정말로"}\n', encoding="utf-8")
    lexicon = {"sounds": {"cat": ["야옹"]}, "expressions": {"dog/sad": ["힝"]}}
    (tmp_path / "lexicons.json").write_text(json.dumps(lexicon))
    flags = ["transform", "--input_file", str(tmp_path / "in.jsonl"), "--lexicons", str(tmp_path / "lexicons.json"), "--per_minute", "0"]
    cli.main([*flags, "--output_file", str(tmp_path / "out"), "--model", "tests.fake_model:speak"], spark)
    rows = spark.read.json(str(tmp_path / "out")).collect()
    assert len(rows) == 20 and all(r.transformed_content == f"{r.post_type} {r.emotion}" for r in rows)
    assert spark.read.parquet(str(tmp_path / "out_failed")).count() == 4
    cli.main([*flags, "--output_file", str(tmp_path / "plain")], spark)
    said = {(r.post_type, r.emotion): r.transformed_content for r in spark.read.json(str(tmp_path / "plain")).collect()}
    assert " 야옹 🐾" in said["cat", "normal"] and said["dog", "sad"].endswith(" 힝 😢") and "야옹" not in said["dog", "happy"]


def test_a_run_that_broke_off_goes_on(spark, tmp_path):
    log, at = str(tmp_path / "calls"), str(tmp_path / "ledger")
    requests = spark.range(40).select(F.concat(F.lit("p"), "id").alias("prompt"), F.sha2(F.col("id").cast("string"), 256).alias("request_id"))
    requests = requests.unionAll(requests.limit(5))
    runs = []

    def model(prompt):
        with open(log, "a") as f:
            f.write(prompt + "\n")
        if prompt == "p7" and len(runs) < 5:
            raise ValueError("not yet")
        return prompt.upper()

    def call(df):
        runs.append(1)
        if len(runs) == 4:
            raise KeyboardInterrupt
        return generate.call_model(df, model, keys=2, attempts=1)

    try:
        generate.resumed(requests, at, call, 8)
        raise AssertionError
    except KeyboardInterrupt:
        pass
    first = open(log).read().split()
    assert 0 < len(first) < 40
    (tmp_path / "ledger" / "broken").mkdir()  # what a batch that broke off leaves
    runs += [1] * 5
    rows = generate.resumed(requests, at, call, 8).collect()
    calls = open(log).read().split()
    assert sorted(r.raw for r in rows) == sorted(f"P{i}" for i in range(40))
    assert sorted(set(calls)) == sorted(f"p{i}" for i in range(40)) and len(calls) == 40 + ("p7" in first)
    assert generate.resumed(requests, at, call, 8).count() == 40 and open(log).read().split() == calls


def test_shares_are_seen_while_a_job_runs(spark):
    said = []
    with progress.watched(spark, said.append, 0.05) as seen:
        spark.range(0, 40, 1, 40).rdd.map(lambda x: time.sleep(0.2)).count()
    assert any(0 < done < total for done, total in seen) and len(said) == len(seen) and said[0].startswith("[")
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def test_batches_of_a_stream_are_seen(spark):
    listener = progress.Batches(lambda x: None)
    spark.streams.addListener(listener)
    try:
        spark.readStream.schema("event_id long").parquet("/root/testdata/sf0.001/events.parquet*").writeStream.format("memory").queryName("seen").trigger(availableNow=True).start().awaitTermination(60)
        for _ in range(50):
            if listener.seen:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.seen and listener.seen[0][1] == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()


def test_bars_beyond_the_limit_are_summed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(charts, "MOST_BARS", 2)
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("d",)], "emotion string")
    path = charts.write_charts(df, str(tmp_path / "x"))["emotion_distribution"]
    assert "all others" in open(path).read() and ">3<" in open(path).read()
