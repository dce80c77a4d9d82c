"""Progress of running jobs: counts observed while rows pass, and shares of tasks done."""

import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def observed(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """The rows, and an observation of `rows` and of the counts of rows for which each given condition holds.

    Its `get` has the numbers once an action has run; they cost no job of their own.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in counts.items()]), seen


def task_shares(spark: SparkSession) -> Iterator[tuple[int, str, int, int]]:
    """(stage, name, tasks done, tasks) of each stage that is running."""
    tracker = spark.sparkContext.statusTracker()
    for stage in tracker.getActiveStageIds():
        info = tracker.getStageInfo(stage)
        if info:
            yield stage, info.name, info.numCompletedTasks, info.numTasks


def bar(done: int, total: int, width: int = 30) -> str:
    """A line of text for a share, empty for no tasks."""
    filled = width * done // total if total else 0
    return f"[{'#' * filled}{'.' * (width - filled)}] {done}/{total}"


def tasks_of(spark: SparkSession, group: str) -> tuple[int, int]:
    """Tasks done and tasks known so far of all jobs of a group. Stages that were skipped don't count."""
    tracker, done, total = spark.sparkContext.statusTracker(), 0, 0
    for job in tracker.getJobIdsForGroup(group):
        info = tracker.getJobInfo(job)
        for stage in info.stageIds if info else ():
            if (s := tracker.getStageInfo(stage)) and (s.numActiveTasks or s.numCompletedTasks or info.status == "RUNNING"):
                done, total = done + s.numCompletedTasks, total + s.numTasks
    return done, total


@contextmanager
def watched(spark: SparkSession, say: Callable[[str], None] = print, every: float = 2.0) -> Iterator[list[tuple[int, int]]]:
    """While actions run in its block, says the share of their tasks done each `every` seconds, if it changed. Gives the list of what it has seen.

    A thread asks Spark's status tracker about the block's job group; the jobs themselves aren't touched.
    """
    group, over, seen = f"watched-{uuid.uuid4()}", threading.Event(), []

    def poll() -> None:
        while not over.wait(every):
            now = tasks_of(spark, group)
            if now[1] and now != (seen[-1] if seen else None):
                seen.append(now)
                say(bar(*now))

    before = {k: spark.sparkContext.getLocalProperty(k) for k in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")}
    spark.sparkContext.setJobGroup(group, "watched")
    thread = threading.Thread(target=poll, daemon=True)
    thread.start()
    try:
        yield seen
    finally:
        over.set()
        thread.join()
        for k, v in before.items():
            spark.sparkContext.setLocalProperty(k, v)


class Batches(StreamingQueryListener):
    """Says each batch of the streams of a session: its number, its rows and rows a second. `seen` has what it said."""

    def __init__(self, say: Callable[[str], None] = print):
        self.say, self.seen = say, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.seen.append((p.batchId, p.numInputRows))
        self.say(f"batch {p.batchId}: {p.numInputRows} rows, {p.processedRowsPerSecond:.0f} a second")

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.say(f"stream ended: {event.exception}")
