"""Mixing sources to target weights by a time-varying curriculum.

Each source has a weight schedule over training time from 0 to 1. Its integral, scaled to the source's target, is the
source's cumulative token demand; a document that starts at word c of its source's stream gets the time at which demand
reaches c. Documents come out range-sorted by that position.

A source's stream is its documents in the order of the MD5 of their id. A stream that is shorter than its target starts
again, at most once; a document that the second pass takes has a second time, at which demand reaches its source's size and c. The word at which the target is reached may fall inside a document: that one counts in part.

Word offsets come from sums by (source, bucket of the hash) and a running sum over those, so that a source with a third of
all rows is dealt over BUCKETS groups. Only sources pass through one task, BUCKETS rows of a source through another.

Nulls: a null text has no words, the null source is a source of its own and sorts last, null ids hash as "null".
Rows that repeat are documents of their own. Without words all targets are 0. No rows in, no rows out.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voicegrid.llm.common import WORD, md5_bits, saved, table, word_count

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
BUCKETS = 4096
#: Knots (time, weight) of the schedules, given to sources in turn: falling, flat, rising.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)))


def inverse_demand(share: str, schedule) -> str:
    """SQL for the time at which the integral of a piecewise linear schedule reaches `share` of its whole."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:])]
    total, done, out = sum(areas), 0.0, "CASE"
    for i, ((t0, w0), (t1, w1)) in enumerate(zip(schedule, schedule[1:])):
        slope, y = (w1 - w0) / (t1 - t0), f"({share} * {total!r}::DOUBLE - {done!r}::DOUBLE)"
        done += areas[i]
        when = f" WHEN {share} * {total!r}::DOUBLE <= {done!r}::DOUBLE THEN" if i < len(areas) - 1 else " ELSE"
        out += when + (f" {t0!r}::DOUBLE + (sqrt({w0 * w0!r}::DOUBLE + {2 * slope!r}::DOUBLE * {y}) - {w0!r}::DOUBLE) / {slope!r}::DOUBLE" if slope else f" {t0!r}::DOUBLE + {y} / {w0!r}::DOUBLE")
    return f"{out} END" if len(areas) > 1 else "(" + out.removeprefix("CASE ELSE ") + ")"


def positions_sql(share: str, nth: str, schedules) -> str:
    """SQL for the time of a document of the nth source."""
    return "CASE" + "".join(f" WHEN {nth} % {len(schedules)} = {i} THEN {inverse_demand(share, s)}" for i, s in enumerate(schedules)) + " END"


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Sources (source, source_size) with their place `nth` and `target`.

    Weights go round by code point. The targets share `share` of all words by weight; those above `most` times their size
    stop there, and what is above is shared again. That fills sources in the order of size by weight: a source is full if
    all targets, at the level that fills it, need no more than there is.
    """
    everything, by_level = Window.partitionBy(), Window.orderBy("_level", "nth")
    w = F.get(F.array(*map(F.lit, weights)), (F.col("nth") % len(weights)).cast("int"))
    df = sizes.withColumn("nth", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).withColumn("_w", w)
    df = df.withColumns({"_cap": most * F.col("source_size"), "_all": share * F.sum("source_size").over(everything), "_ws": F.sum("_w").over(everything)})
    df = df.withColumn("_level", F.col("_cap") / F.col("_w"))
    df = df.withColumns({"_caps": F.sum("_cap").over(by_level), "_left": F.col("_ws") - F.sum("_w").over(by_level)})
    df = df.withColumn("_full", F.col("_caps") + F.col("_level") * F.col("_left") <= F.col("_all"))
    free = F.sum(F.when(~F.col("_full"), F.col("_w"))).over(everything)
    rest = F.col("_all") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(everything), F.lit(0))
    return df.select("source", "source_size", "nth", F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(rest / free * F.col("_w")).alias("target"))


def placed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, most: int = MOST, schedules=SCHEDULES, hashed: bool = False) -> DataFrame:
    """doc_id, h, size, source, source_size, target, taken, th (the text's hash) if `hashed`, and _p0, _p1 and so on, the position in each pass (null where it takes nothing)."""
    h = md5_bits(F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    th = [F.xxhash64(text_col).alias("th")] if hashed else []
    rows = saved(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), h.alias("h"), *th).withColumn("b", F.floor(F.col("h") / (2**32 // BUCKETS)).cast("int")))
    sums = rows.groupBy("source", "b").agg(F.sum("size").alias("n"))
    goals = targets(sums.groupBy("source").agg(F.sum("n").alias("source_size")), weights, share, most)
    before = Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    places = sums.select("source", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_o"))
    goals = goals.withColumnRenamed("source", "_s")
    places = places.join(goals, places["source"].eqNullSafe(goals["_s"])).select(F.col("source").alias("_s"), F.col("b").alias("_b"), "_o", "source_size", "nth", "target")
    within = Window.partitionBy("source", "b").orderBy("h", "doc_id", "size")
    rows = rows.withColumn("_c", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    df = rows.join(places, rows["source"].eqNullSafe(places["_s"]) & (rows["b"] == places["_b"])).withColumn("_c", F.col("_c") + F.col("_o"))
    goal = F.round("target").cast("bigint")
    df = df.withColumns({f"_t{j}": F.greatest(F.lit(0), F.least(F.col("size"), goal - j * F.col("source_size") - F.col("_c"))) for j in range(most)})
    df = df.withColumns({f"_x{j}": F.when(F.col(f"_t{j}") > 0, (j * F.col("source_size") + F.col("_c")) / F.col("target")) for j in range(most)})
    at = {f"_p{j}": F.round(F.expr(positions_sql(f"_x{j}", "nth", schedules)), 9) for j in range(most)}
    df = df.withColumns({"taken": sum((F.col(f"_t{j}") for j in range(most)), F.lit(0)).cast("bigint"), **at})
    return df.select("doc_id", "h", "size", "source", "source_size", "target", "taken", *["th"] * hashed, *at)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", most: int = MOST, **how) -> DataFrame:
    """doc_id, size, source, source_size, target, taken, and `position` and `position_again` (null where a pass takes nothing), in training order of the first pass."""
    df = placed(docs, id_col, text_col, source_col, most=most, **how)
    again = F.col("_p1") if most > 1 else F.lit(None).cast("double")
    return df.withColumns({"position": F.col("_p0"), "position_again": again}).orderBy("position", "h", "doc_id").select("doc_id", "size", "source", "source_size", "target", "taken", "position", "position_again")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", most: int = MOST, **how) -> DataFrame:
    """Rows of `docs`, whole, as often as the mix takes them, in training order, each copy at the position of its own pass.

    A row whose last copy is taken in part has that copy if the part is half of it or more. Rows without words stay as they
    are, once. Rows are matched by id, source and size; rows that share all three share what is taken of them.
    """
    taken = placed(docs, id_col, text_col, source_col, most=most, hashed=True, **how)
    at = F.array(*[F.min(f"_p{j}") for j in range(most)]).alias("at")
    # the text's hash tells the size, which isn't counted again
    per = taken.groupBy("doc_id", "source", "size").agg(F.sum("taken").alias("taken"), F.count("*").alias("rows"), at, F.collect_set("th").alias("_ths"))
    per = per.select("doc_id", "source", "size", "taken", "rows", "at", F.explode("_ths").alias("th"))
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.xxhash64(text_col).alias("_th"))
    both = rows.join(per, F.col("_id").eqNullSafe(F.col("doc_id")) & F.col("_source").eqNullSafe(F.col("source")) & (F.col("_th") == F.col("th")))
    copies = F.when(F.col("size") == 0, 1).otherwise(F.floor(F.col("taken") / F.col("rows") / F.col("size") + 0.5)).cast("int")
    again = both.select("_row", F.explode(F.slice("at", F.lit(1), copies)).alias("position"))
    return again.orderBy("position", F.xxhash64("_row")).select("_row.*")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")


SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM d GROUP BY source),
w AS (SELECT *, list_extract([5, 2, 1], nth % 3 + 1) AS w, 2 * source_size AS cap, 1.5 * sum(source_size) OVER () AS total FROM s),
f AS (SELECT *, sum(cap) OVER o + cap / w * (sum(w) OVER () - sum(w) OVER o) <= total AS filled FROM w WINDOW o AS (ORDER BY cap / w, nth)),
g AS (SELECT source, source_size, nth, CASE WHEN filled THEN cap::DOUBLE ELSE
        ((total - coalesce(sum(cap) FILTER (filled) OVER (), 0)) / sum(w) FILTER (NOT filled) OVER () * w)::DOUBLE END AS target FROM f),
p AS (SELECT doc_id, size, source_size::BIGINT AS source_size, target, nth, h,
        (sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS c FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
t AS (SELECT *, (greatest(0, least(size, round(target)::BIGINT - c)) + greatest(0, least(size, round(target)::BIGINT - source_size - c)))::BIGINT AS taken FROM p),
x AS (SELECT *, CASE WHEN least(size, round(target)::BIGINT - c) > 0 THEN c / target END AS x, CASE WHEN least(size, round(target)::BIGINT - source_size - c) > 0 THEN (source_size + c) / target END AS y FROM t)
SELECT doc_id, size, source_size, target, taken, round({positions_sql("x", "nth", SCHEDULES)}, 9) AS position, round({positions_sql("y", "nth", SCHEDULES)}, 9) AS position_again FROM x
"""
