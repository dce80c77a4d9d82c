from pyspark.sql import functions as F

from voicegrid.operators import schedule
from voicegrid.streaming import monitor

EVENTS = "/root/testdata/sf0.001/events.parquet"


def run(spark, df, mode, at):
    q = df.writeStream.outputMode(mode).format("memory").queryName(at).trigger(availableNow=True).start()
    q.awaitTermination(180)
    return spark.table(at)


def calls(spark):
    batch = spark.read.parquet(EVENTS)
    stream = spark.readStream.schema(batch.schema).parquet(EVENTS + "*")
    return [x.select(F.col("event_id").alias("call_id"), (F.col("user_id") % 9).alias("key_id"), F.col("ts").cast("timestamp").alias("ts")) for x in (batch, stream)]


def test_usage_equals_batch(spark):
    batch, stream = calls(spark)
    got = run(spark, monitor.usage_stream(stream, "1 hour"), "complete", "usage")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, schedule.usage(batch, "ts", "key_id", "1 hour").collect()))


def test_limiter_equals_batch(spark):
    batch, stream = calls(spark)
    got = run(spark, monitor.limit_stream(stream, 1, 86400), "append", "limited")
    want = schedule.admitted(batch, "ts", "key_id", "call_id", "day", 1).select("call_id", "key_id", "admitted")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.filter("not admitted").count() > 0


def test_recent_calls_equal_rolling_usage(spark):
    batch, stream = calls(spark)
    got = run(spark, monitor.recent_stream(stream, 36000), "append", "recent")
    want = schedule.rolling_usage(batch, "ts", "key_id", 36000).select("call_id", "key_id", "n_recent")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.agg(F.max("n_recent")).first()[0] > 2


def in_files(spark, df, at, parts):
    """A stream of a file a batch, in the order given."""
    for k, part in enumerate(parts):
        df.filter(part).coalesce(1).write.mode("append").parquet(f"{at}/{k}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(at)


def test_late_calls_count_and_old_ones_go(spark, tmp_path):
    times = [1000 + t for t in (0, 30, 59, 60, 61, 200, 100, 1000, 5000, 5001)]
    df = spark.createDataFrame([(i, 1, t) for i, t in enumerate(times)], "call_id long, key_id long, t long").withColumn("ts", F.timestamp_seconds("t"))
    got = run(spark, monitor.recent_stream(in_files(spark, df, str(tmp_path), [f"call_id = {i}" for i in range(len(times))]), 60, 300), "append", "late")
    want = {i: sum(t - 60 <= u <= t for u in times[: i + 1]) for i, t in enumerate(times)}
    assert {r.call_id: r.n_recent for r in got.collect()} == want


def test_least_used_key_by_cost_equals_a_heap(spark, tmp_path):
    df = spark.range(300).select(F.col("id").alias("call_id"), (F.col("id") % 2).alias("pool"), F.timestamp_seconds("id").alias("ts"), F.when(F.col("id") % 7 == 0, 0.5).when(F.col("id") % 5 > 0, F.col("id") % 11 * 1.0).alias("cost"))
    got = {r.call_id: (r.pool, r.key_id) for r in run(spark, monitor.balance_stream(in_files(spark, df, str(tmp_path), ["call_id < 100", "call_id between 100 and 199", "call_id >= 200"]), 4), "append", "balanced").collect()}
    used = {0: [0.0] * 4, 1: [0.0] * 4}
    for r in df.orderBy("call_id").collect():
        k = min(range(4), key=lambda k: (used[r.pool][k], k))
        used[r.pool][k] += r.cost or 0
        assert got[r.call_id] == (r.pool, k)
    assert len(got) == 300
