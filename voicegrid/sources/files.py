"""JSON, JSONL, text and HTML readers; JSONL writers; .env settings."""

import atexit
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voicegrid.operators import progress
from voicegrid.schemas import AUGMENTED, CORRUPT, ORIGINALS, with_corrupt
from voicegrid.sources import json_arrays


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One object a line, by a fixed schema. Lines that don't parse come as nulls with the line in `_corrupt`; files split."""
    return spark.read.schema(with_corrupt(schema)).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def read_originals(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, ORIGINALS)


def read_augmented(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, AUGMENTED)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the lines that didn't parse."""
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), df.filter(F.col(CORRUPT).isNotNull())


def read_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Whole-document JSON, an array or an object, by Spark's own reader: a file is one task. `json_arrays.read_array` splits files."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def unify(spark: SparkSession, source: str, to: str, schema: T.StructType) -> int:
    """Whole-document JSON, read by ranges of bytes, to JSONL. Objects that don't parse go to `to`_corrupt as they are; their number."""
    good, bad = split_corrupt(json_arrays.read_array(spark, source, schema))
    write_jsonl(good, to)
    bad, seen = progress.observed(bad.select(F.col(CORRUPT).alias("value")), "corrupt")
    bad.write.mode("overwrite").text(f"{to}_corrupt")
    return seen.get["rows"]


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Crawled text, a post a line."""
    return spark.read.text(path).withColumnRenamed("value", "content")


def write_jsonl(df: DataFrame, path: str, one_file: bool = False) -> None:
    """JSONL with null fields written out, Hangul and emoji unescaped."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local master gets a temporary one, others raise ValueError."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir isn't set; it has to name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="voicegrid")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(d)
    return d


def read_env(path: str, prefix: str = "") -> dict[str, str]:
    """NAME=value lines of a .env file under the process environment. Driver side only: values never become columns."""
    out = {}
    if Path(path).exists():
        for line in Path(path).read_text(encoding="utf-8").splitlines():
            name, eq, value = line.partition("=")
            if eq and not line.lstrip().startswith("#"):
                out[name.strip()] = value.strip().strip("'\"")
    return {k: os.environ.get(k, v) for k, v in out.items() if k.startswith(prefix)}
