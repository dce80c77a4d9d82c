"""What several operators share."""

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPACE = r"[\x20\x09-\x0D]+"
#: Folders of the tables saved by what lasting() is given, and the tables; None outside it.
_WITHIN: ContextVar[list[tuple[str, DataFrame]] | None] = ContextVar("within", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local master gets one of our own; others raise ValueError."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir isn't set; it has to name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="voicegrid")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(d)
    return d if "://" in d or d.startswith("file:") else f"file://{d}"


def saved(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder once as Parquet; later steps read them from there, whatever executor is lost."""
    at, conf = f"{shared_dir(df.sparkSession)}/saved-{uuid.uuid4()}", df.sparkSession.conf
    before = conf.get(CLEAN, None)
    conf.set(CLEAN, "true")  # once the table is there, nobody needs the shuffles that made it
    try:
        df.write.option("compression", "zstd").parquet(at)  # snappy pages would pile up in direct buffers
    finally:
        conf.unset(CLEAN) if before is None else conf.set(CLEAN, before)
    out = df.sparkSession.read.schema(df.schema).parquet(at)
    if (within := _WITHIN.get()) is not None:
        within.append((at, out))
    return out


def lasting(spark: SparkSession, *make: Callable[..., DataFrame], skip: int = 0) -> list[DataFrame]:
    """The saved results of functions, each given those of the ones before, but for the first `skip`.

    Other tables saved on the way are deleted at the end, so nothing but the results may depend on them.
    """
    outer, within, made = _WITHIN.get(), [], []
    token = _WITHIN.set(within)
    try:
        for f in make:
            out = f(*made)
            made.append(out if any(df is out for _, df in within) else saved(out))
    finally:
        _WITHIN.reset(token)
    for at, df in within:
        if not any(df is out for out in made[skip:]):
            _delete(spark, at)
        elif outer is not None:
            outer.append((at, df))
    return made[skip:]


def forget(df: DataFrame) -> None:
    """Deletes a table saved within lasting() before its end. Nothing may depend on it any more; elsewhere it stays."""
    for at, known in list(_WITHIN.get() or []):
        if known is df:
            _WITHIN.get().remove((at, known))
            _delete(df.sparkSession, at)


def _delete(spark: SparkSession, at: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def shielded(row: Column, values: dict[str, Column], df: DataFrame) -> DataFrame:
    """The fields of the struct `row` and the values. A generator in between keeps later filters from repeating their expressions."""
    made = F.explode_outer(F.array(F.struct(*[v.alias(k) for k, v in values.items()])))
    return df.select(row.alias("_row"), made.alias("_made")).select("_row.*", "_made.*")


def word_count(text: Column) -> Column:
    """Words of a text; 0 if null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def md5_bits(x: Column) -> Column:
    """32 bits of MD5 as a long, the same in any SQL engine."""
    return F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("bigint")
