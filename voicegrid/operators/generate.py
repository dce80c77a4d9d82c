"""Rewriting posts.

`rule_transform` is the offline generator: columns only, the same on every run. It attaches endings and emojis; tone and
natural style need a model. `call_model` is the seam for one.
"""

import time
import uuid
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voicegrid import rules
from voicegrid.functions import jsonfix
from voicegrid.functions import text as X
from voicegrid.operators import grid


#: Columns of a cell that results don't keep.
CELL = ("tone", "endings", "emojis", "sounds", "expressions")


def parted(posts: DataFrame, content: str = "content", polite: str = rules.POLITE) -> DataFrame:
    """The posts with `_s`, what all rewritings of a post share: its stem and its last punctuation mark."""
    stem, mark = X.stem_and_mark(F.col(content), polite)
    return posts.withColumn("_s", F.struct(stem.alias("stem"), mark.alias("mark")))


def suffixed(df: DataFrame, key: str) -> DataFrame:
    """Rows of a fan-out with `_x`: what follows the stem in each cell, as a struct of ending, expression, sound and emoji (null if the cell has none)."""
    seed = F.concat_ws("|", F.col(key).cast("string"), "post_type", "emotion")
    more = {n: X.pick(F.col(f"{n}s"), F.concat_ws("|", seed, F.lit(n))).alias(n) for n in ("expression", "sound") if f"{n}s" in df.columns}
    return df.withColumn("_x", F.struct(X.pick(F.col("endings"), seed).alias("ending"), *more.values(), X.pick(F.col("emojis"), seed).alias("emoji")))


def rule_transform(df: DataFrame, key: str, content: str = "content") -> DataFrame:
    """Rows of a fan-out of parted posts with `transformed_content`: an ending, the last punctuation mark, and the cell's expression, sound and emoji if it has any. Null texts stay null."""
    spoken = F.concat("_s.stem", "_x.ending", "_s.mark")
    more = [f"_x.{n}" for n in ("expression", "sound") if f"{n}s" in df.columns]
    return suffixed(df, key).withColumn("transformed_content", F.when(F.col(content).isNotNull(), F.concat_ws(" ", spoken, *more, "_x.emoji"))).drop("_s", "_x")


def transform(posts: DataFrame, key: str, content: str = "content", **lexicons) -> DataFrame:
    """Every post in all twelve voices: the flagship plan. One stage, no shuffle; a post is taken apart once, before the fan-out.

    `sounds` and `expressions` are lexicons as `rules.cells` takes them.
    """
    return rule_transform(grid.fan_out(parted(posts, content), rules.cells(**lexicons)), key, content).drop(*CELL)


def voice_profile(posts: DataFrame, key: str, content: str = "content") -> DataFrame:
    """key, post_type, emotion, emojis (their number) and hangul (share of Hangul) of every post in all twelve voices.

    Characters of a stem are counted once a post, before the fan-out, and those of ending, mark and emoji added to them.
    """
    one = parted(posts, content)
    stem = F.col("_s.stem")
    one = one.select(key, F.col("_s.mark").alias("mark"), F.struct(X.emoji_count(stem).alias("emojis"), X.hangul_count(stem).alias("hangul"), F.length(stem).alias("chars")).alias("_n"))
    # the counts are carried as rows, so that no later step repeats them
    rows = suffixed(grid.fan_out(one.select(key, "mark", F.explode_outer(F.array("_n")).alias("_n"))), key)
    added = F.concat("_x.ending", "mark", F.when(F.col("_x.emoji").isNotNull(), F.concat(F.lit(" "), F.col("_x.emoji"))).otherwise(F.lit("")))
    rows = rows.select(key, "post_type", "emotion", "_n", added.alias("_a"))
    hangul = (F.col("_n.hangul") + X.hangul_count(F.col("_a"))) / (F.col("_n.chars") + F.length("_a"))
    return rows.select(key, "post_type", "emotion", (F.col("_n.emojis") + X.emoji_count(F.col("_a"))).alias("emojis"), F.round(hangul, 6).alias("hangul"))


def with_prompt(df: DataFrame, template: str = rules.PROMPT, content: str = "content") -> DataFrame:
    """The prompt of each row, its template filled from the row's columns."""
    out = F.lit(template)
    for name, value in {"post_type": F.col("post_type"), "emotion": F.col("emotion"), "tone": F.col("tone"), "endings": F.concat_ws(", ", "endings"), "emojis": F.concat_ws(" ", "emojis"), "content": F.coalesce(F.col(content), F.lit(""))}.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return df.withColumn("prompt", out).withColumn("request_id", F.sha2("prompt", 256))


class Allowance:
    """Waits until a key may be used again: `most` calls in any `seconds`."""

    def __init__(self, most: int, seconds: float = 60, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.most, self.seconds, self.clock, self.sleep, self.times = most, seconds, clock, sleep, deque()

    def wait(self) -> None:
        while len(self.times) >= self.most:
            left = self.times[0] + self.seconds - self.clock()
            if left > 0:
                self.sleep(left)
            self.times.popleft()
        self.times.append(self.clock())


def call_model(df: DataFrame, model: Callable[..., str], keys: int | list[str] = 9, attempts: int = 2, per_minute: int | None = None, batch_rows: int | None = None, seconds: float = 60) -> DataFrame:
    """Rows of `with_prompt` with columns `raw`, `error` and `key_id`.

    mapInPandas runs once for each row, where a plain UDF may be evaluated twice. Each API key has one partition of its own, dealt by
    the hash of the request, so that its allowance of `per_minute` calls in `seconds` is kept within one task. With a list of keys the model
    gets (prompt, key); keys are part of the task's closure and never become columns. Rows are handed on in batches of
    `batch_rows` (Spark's own by default).

    Write the result before using it twice; a retried task repeats its calls, and `request_id` tells the repeats. An exception
    is tried again, which counts against the allowance, then kept in `error` with a null `raw`.
    """
    secrets = keys if isinstance(keys, list) else None
    n = len(secrets) if secrets else keys

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        allowances: dict[int, Allowance] = {}
        for pdf in (x.iloc[i : i + (batch_rows or len(x))] for x in batches for i in range(0, len(x), batch_rows or len(x))):
            raws, errors = [], []
            for prompt, key in zip(pdf["prompt"], pdf["key_id"], strict=True):
                raw = error = None
                for _ in range(attempts):
                    if per_minute:
                        allowances.setdefault(key, Allowance(per_minute, seconds)).wait()
                    try:
                        raw, error = model(prompt, secrets[key]) if secrets else model(prompt), None
                        break
                    except Exception as e:  # whatever a client raises; it is kept in the row
                        error = f"{type(e).__name__}: {e}"
                raws.append(raw)
                errors.append(error)
            yield pdf.assign(raw=raws, error=errors)

    rows = df.withColumn("key_id", F.pmod(F.xxhash64("request_id"), F.lit(n)).cast("int")).repartitionByRange(n, "key_id")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", raw string, error string"
    return rows.mapInPandas(run, schema)


def finished(spark: SparkSession, at: str) -> DataFrame | None:
    """The ledger: rows of all committed batches under `at`; None if there are none. Folders of batches that broke off don't count."""
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    store = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not store.exists(path):
        return None
    names = [x.getPath().toString() for x in store.listStatus(path)]
    good = [x for x in names if store.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{x}/_SUCCESS"))]
    return spark.read.parquet(*good) if good else None


def resumed(requests: DataFrame, at: str, call: Callable[[DataFrame], DataFrame], batches: int = 16, pause: float = 0) -> DataFrame:
    """Rows of `call` for each request_id, one each; a rerun calls only for those that the ledger under `at` doesn't have yet.

    Requests are dealt to `batches` by a hash of their ids, and each batch is committed by itself, so that what breaks off loses one batch at
    most. Calls that failed (null `raw`) are made again by the next run. More requests than before may come; requests that repeat are
    called once. `pause` seconds pass between two batches, so that allowances, which begin anew with each, hold over their border.
    """
    spark = requests.sparkSession
    done, called = finished(spark, at), False
    part = F.pmod(F.xxhash64("request_id", F.lit("batch")), F.lit(batches))
    for k in range(batches):
        todo = requests.filter(part == k).dropDuplicates(["request_id"])
        if done is not None:
            todo = todo.join(done.filter("raw is not null").select("request_id").distinct(), "request_id", "left_anti")
        if todo.isEmpty():
            continue
        if called:
            time.sleep(pause)
        called = True
        call(todo.select(*requests.columns)).write.parquet(f"{at}/{uuid.uuid4()}")
    rows = finished(spark, at)
    row = F.struct(*rows.columns)
    return rows.groupBy("request_id").agg(F.max_by(row, F.struct(F.col("raw").isNotNull(), F.xxhash64(row))).alias("_r")).select("_r.*")


def with_topic_prompt(df: DataFrame, template: str = rules.TOPIC_PROMPT) -> DataFrame:
    """The prompt for an original about each row's topic in its emotion; `_i` tells repeats apart."""
    out = F.lit(template)
    for name in ("topic", "emotion"):
        out = F.replace(out, F.lit("{" + name + "}"), F.col(name))
    return df.withColumn("prompt", out).withColumn("request_id", F.sha2(F.concat_ws("|", "prompt", F.col("_i").cast("string")), 256))


def parsed(df: DataFrame, raw: str = "raw") -> tuple[DataFrame, DataFrame]:
    """Responses that parse, with `transformed_content`, and the quarantine."""
    out = df.withColumn("_p", jsonfix.parse(F.col(raw), "transformed_content string"))
    ok = F.col("_p.transformed_content").isNotNull()
    return out.filter(ok).withColumn("transformed_content", F.col("_p.transformed_content")).drop("_p"), out.filter(~ok | ok.isNull()).drop("_p")
