"""Cleaning: strip, filter, keep one of equal posts, merge."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voicegrid.functions import text as X
from voicegrid.schemas import EMOTIONS, POST_TYPES


def cleaned(df: DataFrame, col: str = "content", **how) -> DataFrame:
    """Texts stripped, and decomposed Hangul composed, so that length and endings are found whatever keyboard they came from."""
    return df.withColumn(col, X.compose(X.strip(F.col(col), **how)))


def quality(df: DataFrame, col: str = "content", least: int = 5, most: int = 500, symbols: float | None = None, hangul: float | None = None) -> DataFrame:
    """Rows whose text has a good length and, if asked, few symbols and enough Hangul. Null texts go."""
    ok = X.good_length(F.col(col), least, most)
    if symbols is not None:
        ok &= X.symbol_share(F.col(col)) <= symbols
    if hangul is not None:
        ok &= X.hangul_share(F.col(col)) >= hangul
    return df.filter(ok)


def keep_first(df: DataFrame, key: str | Column, order: str, carry: list[str] | None = None) -> DataFrame:
    """One row for each key, that with the smallest `order`; null keys count as equal.

    A key is hashed before the shuffle, and min_by combines on the map side, so that a text that a third of
    the rows share meets its copies as one row a task.
    """
    k = F.col(key) if isinstance(key, str) else key
    carry = carry or df.columns
    row = F.struct(*[F.col(c) for c in carry])
    return df.groupBy(F.sha2(F.coalesce(F.concat(F.lit("+"), k), F.lit("-")), 256).alias("_k")).agg(F.min_by(row, F.struct(order, F.xxhash64(row))).alias("_r")).select("_r.*")


def newest(df: DataFrame, key: list[str], version: str) -> DataFrame:
    """The row of the greatest `version` for each key; of equals, that with the smallest hash. Null versions are the oldest."""
    row = F.struct(*df.columns)
    return df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]).agg(F.max_by(row, F.struct(F.col(version), -F.xxhash64(row).cast("decimal(20,0)"))).alias("_r")).select("_r.*")


def domain_check(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Augmented rows with both enums in their domains (in lower case), and the others."""
    df = df.withColumns({c: F.lower(F.trim(c)) for c in ("emotion", "post_type")})
    ok = F.coalesce(F.col("emotion").isin(*EMOTIONS) & F.col("post_type").isin(*POST_TYPES) & F.col("transformed_content").isNotNull(), F.lit(False))
    return df.filter(ok), df.filter(~ok)


def merge(frames: list[DataFrame], dedup: list[str] | None = None, order: str | None = None) -> DataFrame:
    """All rows of all frames, columns matched by name; with `dedup`, one row for each value of those columns."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if not dedup:
        return out
    return keep_first(out, F.to_json(F.struct(*dedup)), order or dedup[0])
