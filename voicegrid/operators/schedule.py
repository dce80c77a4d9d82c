"""Call scheduling over a pool of rate-limited keys, in batch.

Positions over all calls come from counts by time bucket and running sums over those, so that no task sees all rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS, PER_MINUTE = 9, 15


def position(df: DataFrame, ts: str, key: str, unit: str = "minute") -> DataFrame:
    """Rows with `pos`, their place from 0 in the order of (ts, key), over all rows.

    Rows are ranked within their `unit`, units are summed within their day, and only a row a day passes through one task. A rank
    takes all rows of one unit to one task, so it should be one that holds a part of a day.
    """
    bucketed = df.withColumn("_b", F.date_trunc(unit, ts))
    day = Window.partitionBy("_day").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    days = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    units = bucketed.groupBy("_b").agg(F.count("*").alias("_n")).withColumn("_day", F.date_trunc("day", "_b"))
    totals = units.groupBy("_day").agg(F.sum("_n").alias("_n")).select(F.col("_day").alias("_d"), F.coalesce(F.sum("_n").over(days), F.lit(0)).alias("_before"))
    units = units.withColumn("_o", F.coalesce(F.sum("_n").over(day), F.lit(0))).join(totals, F.col("_day").eqNullSafe(F.col("_d"))).select("_b", (F.col("_o") + F.col("_before")).alias("_o"))
    rows = bucketed.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(ts, key)))
    return rows.join(units, rows["_b"].eqNullSafe(units["_b"])).select(*df.columns, (F.col("_o") + F.col("_r") - 1).alias("pos"))


def start_times(df: DataFrame, ts: str, key: str, keys: int = KEYS, per_unit: int = PER_MINUTE, seconds: int = 60, block: int = 4096) -> DataFrame:
    """Rows with key_id and `starts`, the time at which each call may be made: in order, over the least used key, at most `per_unit` of a key in any `seconds`.

    start(i) = max(ts(i), start(i - keys * per_unit) + seconds). Calls fall into keys * per_unit lanes; in a lane, call j starts at
    j * seconds after the greatest of ts(k) - k * seconds for k up to j. That running maximum is taken within blocks of a lane, and from the
    blocks before by a row a block, so that no task sees a whole lane.
    """
    lanes, step = keys * per_unit, seconds * 1_000_000
    rows = position(df, ts, key).withColumns({"_lane": F.col("pos") % lanes, "_j": F.floor(F.col("pos") / lanes)})
    rows = rows.withColumns({"_v": F.unix_micros(F.col(ts).cast("timestamp")) - F.col("_j") * step, "_block": F.floor(F.col("_j") / block)})
    before = Window.partitionBy("_lane").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("_lane", "_block").agg(F.max("_v").alias("_most")).select("_lane", "_block", F.max("_most").over(before).alias("_most"))
    within = Window.partitionBy("_lane", "_block").orderBy("_j").rowsBetween(Window.unboundedPreceding, 0)
    both = rows.withColumn("_v", F.max("_v").over(within)).join(blocks, ["_lane", "_block"])
    starts = F.timestamp_micros(F.greatest("_v", "_most") + F.col("_j") * step)
    return both.select(*df.columns, "pos", (F.col("pos") % keys).alias("key_id"), starts.alias("starts"))


def round_robin(df: DataFrame, ts: str, key: str, keys: int = KEYS, per_minute: int = PER_MINUTE) -> DataFrame:
    """The key and the minute of each call. With calls of equal cost this is what picking the least used key gives."""
    return position(df, ts, key).withColumns({"key_id": F.col("pos") % keys, "minute": F.floor(F.col("pos") / (keys * per_minute))})


def usage(df: DataFrame, ts: str, key: str | Column, width: str = "1 minute") -> DataFrame:
    """Calls by key and tumbling window."""
    k = F.col(key) if isinstance(key, str) else key
    return df.groupBy(F.window(ts, width).alias("w"), k.alias("key_id")).agg(F.count("*").alias("n_calls")).select(F.col("w.start").alias("window_start"), "key_id", "n_calls")


def rolling_usage(df: DataFrame, ts: str, key: str, seconds: int = 60) -> DataFrame:
    """Rows with `n_recent`, the calls of the same key in the `seconds` up to and with this one.

    Windows are by key and time bucket. Each row also goes to the next bucket, where all rows of the bucket before count from the start
    and each leaves once it is too old. So counts are running sums, which don't go over the rows of an interval again for each row.
    """
    at, width = F.unix_micros(F.col(ts).cast("timestamp")), seconds * 1_000_000
    rows = df.withColumn("_t", at).withColumn("_b", F.floor(F.col("_t") / width))
    rows = rows.withColumn("_d", F.explode(F.when(F.col("_t").isNull(), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))))
    rows = rows.withColumns({"_b": F.col("_b") + F.col("_d"), "_t": F.col("_t") + F.col("_d") * (width + 1)})
    bucket = Window.partitionBy(key, "_b")
    so_far = F.sum(1 - 2 * F.col("_d")).over(bucket.orderBy("_t").rangeBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("n_recent", F.sum("_d").over(bucket) + so_far).filter("_d = 0").drop("_t", "_b", "_d")


def admitted(df: DataFrame, ts: str, key: str, call: str, unit: str = "minute", most: int = PER_MINUTE) -> DataFrame:
    """Rows with `admitted`: whether the call is among the first `most` of its key in its calendar unit."""
    w = Window.partitionBy(key, F.date_trunc(unit, ts)).orderBy(ts, call)
    return df.withColumn("admitted", F.row_number().over(w) <= most)


def least_used(df: DataFrame, key: str, cost: str) -> DataFrame:
    """The key with the smallest total cost; of equals, the smallest key."""
    totals = df.groupBy(key).agg(F.sum(cost).alias("used"))
    return totals.agg(F.min_by(key, F.struct("used", key)).alias(key), F.min("used").alias("used"))
