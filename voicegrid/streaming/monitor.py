"""Usage of keys as a stream, and a rate limiter that keeps state by key."""

import heapq
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def usage_stream(calls: DataFrame, width: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Calls by key and tumbling window of a stream with columns ts and key_id. The watermark bounds the state."""
    timed = calls.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", width).alias("w"), "key_id").agg(F.count("*").alias("n_calls")).select(F.col("w.start").alias("window_start"), "key_id", "n_calls")


class Limiter(StatefulProcessor):
    """Admits the first `most` calls of a key in each calendar unit of `seconds`. State: the current unit and its count.

    Within a batch calls are taken by time. A call of an earlier unit than the current one is refused: its count is gone.
    """

    def __init__(self, most: int, seconds: int):
        self.most, self.seconds = most, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("unit", "unit bigint, n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        calls = pd.concat(list(rows)).sort_values(["ts", "call_id"], kind="stable")
        unit, n = self.state.get() if self.state.exists() else (-1, 0)
        out = []
        for at in (calls["ts"].astype("datetime64[us]").astype("int64") // (self.seconds * 1_000_000)).tolist():
            if at > unit:
                unit, n = at, 0
            ok = at == unit and n < self.most
            n += ok
            out.append(ok)
        self.state.update((unit, n))
        yield pd.DataFrame({"call_id": calls["call_id"].to_numpy(), "key_id": key[0], "admitted": out})

    def close(self) -> None:
        pass


def limit_stream(calls: DataFrame, most: int = 15, seconds: int = 60) -> DataFrame:
    """Calls (call_id, key_id, ts) with `admitted`. Needs the RocksDB state store provider."""
    timed = calls.select("call_id", "key_id", F.col("ts").cast("timestamp").alias("ts"))
    return timed.groupBy("key_id").transformWithStateInPandas(Limiter(most, seconds), "call_id bigint, key_id bigint, admitted boolean", "append", "none")


def micros(times: pd.Series) -> list[int]:
    return times.astype("datetime64[us]").astype("int64").tolist()


class Recent(StatefulProcessor):
    """Calls of a key in the `seconds` up to and with each call. State: times of calls; a timer drops those that no call to come can count.

    A call may come up to `late` seconds after later ones; it is counted like the others then, and by calls after it.
    """

    def __init__(self, seconds: int, late: int):
        self.span, self.late = seconds * 1_000_000, late * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.times = handle.getListState("times", "t bigint")

    def keep(self, times: list[int], now: int) -> None:
        """Keeps the times that still count at `now` and sets the timer at which the last of them goes."""
        times = times[bisect_left(times, now - self.span - self.late) :]
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t[0] if isinstance(t, tuple) else t)
        if times:
            self.times.put([(t,) for t in times])
            self.handle.registerTimer((times[-1] + self.span + self.late) // 1000 + 1)
        else:
            self.times.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        calls = pd.concat(list(rows)).sort_values(["ts", "call_id"], kind="stable")
        new, times = micros(calls["ts"]), [t for (t,) in self.times.get()]
        for t in new:  # all of a batch are there before any is counted, so that calls of one time count each other
            insort(times, t)
        out = [bisect_right(times, t) - bisect_left(times, t - self.span) for t in new]
        self.keep(times, times[-1])
        yield pd.DataFrame({"call_id": calls["call_id"].to_numpy(), "key_id": key[0], "n_recent": out})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.keep([t for (t,) in self.times.get()], expiredTimerInfo.getExpiryTimeInMs() * 1000)
        yield from ()

    def close(self) -> None:
        pass


def recent_stream(calls: DataFrame, seconds: int = 60, late: int = 600) -> DataFrame:
    """Calls (call_id, key_id, ts) with `n_recent`, as they come. The watermark fires the timers. Needs the RocksDB state store provider."""
    timed = calls.select("call_id", "key_id", F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", f"{late} seconds")
    return timed.groupBy("key_id").transformWithStateInPandas(Recent(seconds, late), "call_id bigint, key_id bigint, n_recent bigint", "append", "eventTime")


class Balancer(StatefulProcessor):
    """Gives each call of a pool the key that has been used least so far, by cost; of equals the smallest. State: the use of each key, read as a heap.

    Within a batch calls are taken by time. Each choice depends on all before it, so a pool is one group; pools run side by side.
    """

    def __init__(self, keys: int):
        self.keys = keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.used = handle.getValueState("used", "used array<double>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        calls = pd.concat(list(rows)).sort_values(["ts", "call_id"], kind="stable")
        used = list(self.used.get()[0]) if self.used.exists() else [0.0] * self.keys
        heap, out = [(u, k) for k, u in enumerate(used)], []
        heapq.heapify(heap)
        for cost in calls["cost"].fillna(0).tolist():
            u, k = heap[0]
            heapq.heapreplace(heap, (u + cost, k))
            out.append(k)
        for u, k in heap:
            used[k] = u
        self.used.update((used,))
        yield pd.DataFrame({"call_id": calls["call_id"].to_numpy(), "pool": key[0], "key_id": out})

    def close(self) -> None:
        pass


def balance_stream(calls: DataFrame, keys: int = 9) -> DataFrame:
    """Calls (call_id, pool, ts, cost) with `key_id`, the least used key of their pool. Null costs count as 0. Needs the RocksDB state store provider."""
    timed = calls.select("call_id", "pool", F.col("ts").cast("timestamp").alias("ts"), F.col("cost").cast("double").alias("cost"))
    return timed.groupBy("pool").transformWithStateInPandas(Balancer(keys), "call_id bigint, pool bigint, key_id int", "append", "none")
