"""Command line: transform, generate, profile, merge, unify, filter.

python -m voicegrid.cli transform --input_file posts.jsonl --output_file out --target_count 1000
"""

import argparse
import importlib
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voicegrid import rules
from voicegrid.functions import text as X
from voicegrid.operators import clean, generate, grid, progress
from voicegrid.schemas import AUGMENTED, CORRUPT, ORIGINALS
from voicegrid.sources import charts, files


def with_id(df: DataFrame) -> DataFrame:
    return df.withColumn("post_id", F.sha2("content", 256))


def quarantined(df: DataFrame, path: str) -> DataFrame:
    """The good rows. Lines that don't parse go to `path`_corrupt, as they are, and their number is said."""
    good, bad = files.split_corrupt(df)
    # Spark refuses to read nothing but the corrupt lines, so another column comes along
    bad, seen = progress.observed(bad.select(F.coalesce(CORRUPT, df.columns[0]).alias("value")), "corrupt")
    bad.write.mode("overwrite").text(f"{path}_corrupt")
    print(f"lines that don't parse: {seen.get['rows']}")
    return good


def lexicons(path: str | None) -> dict:
    """sounds by animal and expressions by `animal/emotion`, from a JSON file."""
    found = json.loads(Path(path).read_text(encoding="utf-8")) if path else {}
    return {"sounds": found.get("sounds"), "expressions": {tuple(k.split("/")): v for k, v in found.get("expressions", {}).items()}}


def answered(spark, a, requests: DataFrame) -> DataFrame:
    """One row of answers for each request, from the model that --model names, with the keys of --env. A rerun goes on where the last one broke off."""
    module, _, name = a.model.partition(":")
    model, keys = getattr(importlib.import_module(module), name), list(files.read_env(a.env, "API_KEY").values()) if a.env else 9
    with progress.watched(spark):
        done = generate.resumed(requests, f"{a.output_file}_raw", lambda df: generate.call_model(df, model, keys or 9, per_minute=a.per_minute), a.batches, 60 if a.per_minute else 0)
    n = done.agg(F.count("*").alias("all"), F.count("raw").alias("said")).first()
    print(progress.bar(n["said"], n["all"]))
    return done


def run_transform(spark, a) -> None:
    posts = quarantined(files.read_originals(spark, a.input_file), a.output_file)
    posts = with_id(clean.quality(clean.cleaned(posts)))
    cells = rules.cells(**lexicons(a.lexicons))
    if a.n_emotions < 6:
        picked = grid.n_emotions(generate.parted(posts), "post_id", a.n_emotions).withColumnRenamed("emotion", "_picked")
        rows = grid.fan_out(picked, cells).filter("emotion = _picked").drop("_picked")
    else:
        rows = grid.fan_out(generate.parted(posts), cells)
    rows = rows.withColumn("_id", F.concat_ws("|", "post_id", "post_type", "emotion"))
    if a.target_count:
        quota = -(-a.target_count // 12)
        rows = grid.target_count(grid.balanced(rows, ["post_type", "emotion"], "_id", quota), "_id", a.target_count)
    if not a.model:
        rows = generate.rule_transform(rows, "post_id")
    else:
        requests = generate.with_prompt(rows.drop("_s")).select("prompt", "request_id", "content", "emotion", "post_type")
        rows, bad = generate.parsed(answered(spark, a, requests))
        bad.select("request_id", "raw", "error").write.mode("overwrite").parquet(f"{a.output_file}_failed")
    with progress.watched(spark):
        files.write_jsonl(rows.select(*AUGMENTED.names), a.output_file)


def run_generate(spark, a) -> None:
    """Originals by topic and emotion: from the model that --model names (module:function), with the keys of --env; else prompts' names."""
    topics = files.read_text(spark, a.topics) if a.topics else None
    rows = grid.topics_by_emotion(spark, topics)
    each = rows.count() if a.topics else 138
    rows = rows.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(-(-a.count // each)))))
    rows = grid.target_count(rows.withColumn("_n", F.concat_ws(" ", "topic", "emotion", F.col("_i").cast("string"))), "_n", a.count)
    if not a.model:
        files.write_jsonl(rows.select(F.col("_n").alias("content")), a.output_file)
        return
    done = answered(spark, a, generate.with_topic_prompt(rows).select("prompt", "request_id"))
    files.write_jsonl(done.filter("raw is not null").select(F.col("raw").alias("content")), a.output_file)


def run_profile(spark, a) -> None:
    rows = quarantined(files.read_augmented(spark, a.input_file), a.output_prefix)
    print(*charts.write_charts(rows, a.output_prefix, "content", a.charts).values(), sep="\n")


def run_merge(spark, a) -> None:
    files.write_jsonl(clean.merge([quarantined(files.read_augmented(spark, p), f"{a.output_file}_{i}") for i, p in enumerate(a.input_file)], AUGMENTED.names if a.dedup else None), a.output_file)


def run_unify(spark, a) -> None:
    print(f"objects that don't parse: {files.unify(spark, a.input_file, a.output_file, ORIGINALS if a.originals else AUGMENTED)}")


def run_filter(spark, a) -> None:
    read = files.read_text(spark, a.input_file)
    read = read.withColumn("content", X.html_to_text(F.col("content"))) if a.html else read
    posts = clean.quality(clean.cleaned(read), least=a.min_len, most=a.max_len)
    files.write_jsonl(clean.keep_first(posts, "content", "content"), a.output_file)


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    top = argparse.ArgumentParser(prog="voicegrid")
    sub = top.add_subparsers(dest="what", required=True)
    for name, run, flags in (
        ("transform", run_transform, {"--input_file": {"required": True}, "--output_file": {"required": True}, "--target_count": {"type": int, "default": 0}, "--n_emotions": {"type": int, "default": 6}, "--lexicons": {}, "--model": {}, "--env": {}, "--per_minute": {"type": int, "default": 15}, "--batches": {"type": int, "default": 1}}),
        ("generate", run_generate, {"--output_file": {"required": True}, "--count": {"type": int, "required": True}, "--topics": {}, "--model": {}, "--env": {}, "--per_minute": {"type": int, "default": 15}, "--batches": {"type": int, "default": 1}}),
        ("profile", run_profile, {"--input_file": {"required": True}, "--output_prefix": {"required": True}, "--charts": {"choices": ["png", "svg"], "default": "png"}}),
        ("merge", run_merge, {"--input_file": {"nargs": "+", "required": True}, "--output_file": {"required": True}, "--dedup": {"action": "store_true"}}),
        ("unify", run_unify, {"--input_file": {"required": True}, "--output_file": {"required": True}, "--originals": {"action": "store_true"}}),
        ("filter", run_filter, {"--input_file": {"required": True}, "--output_file": {"required": True}, "--min_len": {"type": int, "default": 5}, "--max_len": {"type": int, "default": 500}, "--html": {"action": "store_true"}}),
    ):
        p = sub.add_parser(name)
        p.set_defaults(run=run)
        for flag, kw in flags.items():
            p.add_argument(flag, **kw)
    a = top.parse_args(args)
    a.run(spark or SparkSession.builder.appName("voicegrid").getOrCreate(), a)


if __name__ == "__main__":
    main()
