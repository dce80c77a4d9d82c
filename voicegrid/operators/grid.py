"""Fan-out over the grid, picks of emotions, and quotas.

Fan-out explodes a literal array, so that it needs no join. Picks and quotas order rows by MD5, so that reruns agree.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voicegrid import rules
from voicegrid.functions.text import stable_hash
from voicegrid.schemas import EMOTIONS


def fan_out(df: DataFrame, cells: Column | None = None) -> DataFrame:
    """Each row once for each cell of the grid."""
    return df.select(*df.columns, F.explode(rules.cells() if cells is None else cells).alias("_c")).select(*df.columns, "_c.*")


def topics_by_emotion(spark: SparkSession, topics: list[str] | DataFrame | None = None) -> DataFrame:
    """Every topic in every emotion; one prompt key for a generated original each. Topics: a list, or the first column of a table, each value once."""
    if isinstance(topics, DataFrame):
        rows = topics.select(F.col(topics.columns[0]).alias("topic")).distinct()
    else:
        rows = spark.range(1).select(F.explode(F.array(*map(F.lit, topics or rules.TOPICS))).alias("topic"))
    return rows.select("topic", F.explode(F.array(*map(F.lit, EMOTIONS))).alias("emotion"))


def n_emotions(df: DataFrame, key: str, n: int = 2) -> DataFrame:
    """`n` different emotions for each row, the first by hash of row key and emotion. Sorts an array in the row; no shuffle."""
    ranked = F.sort_array(F.array(*[F.struct(stable_hash(F.concat_ws("|", F.col(key).cast("string"), F.lit(e))).alias("h"), F.lit(e).alias("emotion")) for e in sorted(EMOTIONS)]))
    return df.select(*df.columns, F.explode(F.slice(ranked, 1, n)).alias("_e")).select(*df.columns, F.col("_e.emotion").alias("emotion"))


def balanced(df: DataFrame, cell: list[str], key: str, quota: int) -> DataFrame:
    """At most `quota` rows of each cell, the first by hash of the key. Spark cuts each task's rows to the quota before the shuffle."""
    w = Window.partitionBy(*cell).orderBy(stable_hash(F.col(key).cast("string")), key)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= quota).drop("_n")


def target_count(df: DataFrame, key: str, n: int, small: int = 10_000) -> DataFrame:
    """`n` rows in all, the first by hash of the key, then by the key; null keys first.

    Up to `small` rows are the tops of each task's, merged. More are found by the n-th hash: counts by its upper 12 bits tell which
    of those it has, counts of the rows with these the next 12, and so the last 8. Then rows below it pass a filter, and of those with
    that very hash the first keys fill up. Counting takes three jobs as the plan is made, with at most 4,096 rows each.
    """
    h = F.coalesce(stable_hash(F.col(key).cast("string")), F.lit(-1))
    if n <= small:
        return df.orderBy(h, F.col(key).asc_nulls_first()).limit(n)
    hashes, left, found = df.select(h.alias("h")), n, None
    for shift in (20, 8, 0):
        counts = sorted((r["p"], r["n"]) for r in hashes.groupBy(F.shiftright("h", shift).alias("p")).agg(F.count("*").alias("n")).collect())
        for prefix, m in counts:
            if m > left:
                break
            left -= m
        else:  # there are no more than n rows
            return df
        hashes, found = hashes.filter(F.shiftright("h", shift) == prefix), prefix
    return df.filter(h < found).unionAll(df.filter(h == found).orderBy(F.col(key).asc_nulls_first()).limit(left))
