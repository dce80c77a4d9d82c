"""Links among nodes that share a bucket, without all pairs of a bucket."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voicegrid.llm.common import saved
from voicegrid.llm.components import components

#: Buckets of a member by which the last step tells whether another bucket has the pair.
LISTED = 8


def buckets(nodes: DataFrame) -> DataFrame:
    """band, key and x of each node (key, x, bands) that shares a band with others."""
    member = nodes.select("key", "x", F.explode("bands").alias("band"))
    shared = member.groupBy(F.col("band").alias("_b")).agg(F.count("*").alias("_c")).filter("_c > 1").select("_b")
    return saved(member.join(shared, F.col("band") == F.col("_b"), "left_semi").select("band", "key", "x"))


def connect(met: DataFrame, fits: Callable[[Column, Column], Column], verify: Callable[[DataFrame], DataFrame], rest: Callable[[DataFrame], DataFrame] | None = None, hubs: int = 1, known: DataFrame | None = None, last: bool = True, windowed: bool = False) -> DataFrame:
    """Components (node, root) of all links between members (band, key, x) of the same bucket.

    First, members are compared with one member of each of their buckets, its hub. Where that leaves several components in a
    bucket, members are compared with up to `hubs - 1` more hubs, if they are outside those ones' components. A hub has then met
    all others, so it leaves its bucket, as buckets do in which no two members are left to compare. Where several components
    remain, each member outside the first one is compared with all members of other components. So each two members of a
    bucket are compared or already connected, while a bucket of members that are alike costs a few comparisons a member.

    `fits(x, y)` is a cheap test without which there is no link. `verify(pairs)` keeps the linked ones of pairs (a, b).
    `rest(open)` gives the pairs of the last step that may be linked, from (band, key, x, root, apart: outside the first
    component); by default a join does. `known` are components (node, root) to start from. Without `last`, members that hubs leave
    unconnected stay so. If `windowed`, members are shuffled once to meet their hubs, without a join.
    """
    found, part = (None, None) if known is None else (known.select(F.col("node").alias("a"), F.col("root").alias("b")), known)
    for seeds in filter(None, ([0], list(range(1, hubs)))):
        named = met.withColumn("root", F.col("key")) if part is None else _named(met, part)
        hub = {f"h{i}": F.min_by(F.struct("key", "x", "root"), F.struct(F.xxhash64("key", "band", F.lit(i)), "key")) for i in seeds}
        hub = {"_m": F.min("root"), "_x": F.max("root"), "_n": F.count("*")} | hub
        if windowed:
            dealt = named.select("*", *[c.over(Window.partitionBy("band")).alias(k) for k, c in hub.items()]).filter("_m != _x")
        else:
            of = named.groupBy(F.col("band").alias("_b")).agg(*[c.alias(k) for k, c in hub.items()]).filter("_m != _x")
            dealt = named.join(of, F.col("band") == F.col("_b"))
        to = [F.when((F.col("root") != F.col(f"h{i}.root")) & fits(F.col("x"), F.col(f"h{i}.x")), F.col(f"h{i}.key")) for i in seeds]
        stays = (F.col("_n") > 2) & ~F.col("key").isin(*[F.col(f"h{i}.key") for i in seeds])
        dealt = dealt.select("band", "key", "x", stays.alias("stays"), F.array(*to).alias("to"))
        dealt = saved(dealt.filter(F.col("stays") | F.exists("to", lambda h: h.isNotNull())))
        pairs = dealt.select("key", F.explode("to").alias("h")).filter("h is not null")
        pairs = saved(pairs.select(F.least("key", "h").alias("a"), F.greatest("key", "h").alias("b")).distinct())
        met = dealt.filter("stays").select("band", "key", "x")
        if found is None or pairs.head(1):
            links = saved(verify(pairs))
            found = links if found is None else found.unionAll(links)
            part = components(found)
    if not last:
        return part
    named = _named(met, part)
    first = named.groupBy(F.col("band").alias("_b")).agg(F.min("root").alias("_m"), F.max("root").alias("_x")).filter("_m != _x").select("_b", "_m")
    open_ = named.join(first, F.col("band") == F.col("_b")).select("band", "key", "x", "root", (F.col("root") != F.col("_m")).alias("apart"))
    pairs = saved((rest or _joined(fits))(open_))
    links = saved(verify(pairs)) if pairs.head(1) else pairs
    return components(found.unionAll(links)) if links.head(1) else part


def _named(met: DataFrame, part: DataFrame) -> DataFrame:
    of = part.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return met.join(of, F.col("key") == F.col("_node"), "left").select("band", "key", "x", F.coalesce("_root", "key").alias("root"))


def _joined(fits: Callable[[Column, Column], Column]) -> Callable[[DataFrame], DataFrame]:
    """Pairs of an open bucket by a join, each of them in one bucket and once, as far as the LISTED least buckets of both tell."""

    def pairs(open_: DataFrame) -> DataFrame:
        open_ = saved(open_)
        least = open_.groupBy(F.col("key").alias("_key")).agg(F.slice(F.sort_array(F.collect_set("band")), 1, LISTED).alias("least"))
        open_ = saved(open_.join(least, F.col("key") == F.col("_key")).drop("_key"))
        apart = open_.filter("apart").select(F.col("band").alias("_band"), F.col("key").alias("k"), F.col("x").alias("y"), F.col("root").alias("r"), F.col("least").alias("l"))
        once = ~F.col("apart") | (F.col("key") < F.col("k"))
        both = (F.col("band") == F.col("_band")) & (F.col("root") != F.col("r")) & once & fits(F.col("x"), F.col("y"))
        both &= F.coalesce(F.array_min(F.array_intersect("least", "l")) == F.col("band"), F.lit(True))
        return open_.join(apart, both).select(F.least("k", "key").alias("a"), F.greatest("k", "key").alias("b")).distinct()

    return pairs
