"""Connected components by large-star and small-star rounds, in DataFrame operations only.

Each round joins edges with the least neighbour of their node and writes the result to the shared folder. Long chains shrink by
half or more a round; the loop ends when all components are stars. One row at most reaches the driver.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voicegrid.llm.common import saved


def _open(edges: DataFrame) -> bool:
    """Whether some node has two edges to smaller ones, or both smaller and larger neighbours."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(edges.select("b", F.lit(0), F.lit(1)))
    return bool(ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up + down > 1").head(1))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b), a > b. Large star: larger neighbours of a node move to its least; small star: smaller ones and itself do."""
    pairs = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = pairs.groupBy(F.col("a").alias("_n")).agg(F.min("b").alias("_m")).withColumn("_m", F.least("_n", "_m"))
    moved = pairs.join(least, F.col("a") == F.col("_n"))
    if large:
        out = moved.filter("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    else:
        out = moved.filter("b != _m").select(F.col("b").alias("a"), F.col("_m").alias("b")).unionAll(least.select(F.col("_n").alias("a"), F.col("_m").alias("b")))
    return out.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Nodes that have an edge (node), each with the least node of its component (root). Ids may have any type with an order."""
    a, b = edges.columns[:2]
    now = saved(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a != b").distinct())
    while _open(now):
        now = saved(_star(_star(now, True), False))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
