"""Quality rules by a likelihood ratio of hashed n-grams.

Tokens (runs of letters and digits, runs of other marks) and pairs of neighbouring tokens are hashed into BINS bins. One
multinomial over the bins is counted from all documents, another from trusted ones. A document's score is the mean over its
features of the log ratio of trusted to raw probability, smoothed by one count a bin; it is kept at THRESHOLD or above.

Counts of both corpora cover every document: the raw one all, the trusted one all that are labelled good. Ids of these are
broadcast if they are SMALL or fewer, beyond that texts meet them by a shuffle. Bins are the only thing that reaches the driver. Log ratios are rounded to integers, so that sums
don't depend on order. Without trusted documents, or without tokens, the score is 0.

Base rules over words: at least LEAST_WORDS of them, and at most REPEATED percent in 3-word windows that the text has twice.
A null text has no words and fails. Repeated rows, and rows with null ids, are judged one by one. Windows are compared by
64-bit hashes.
"""

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voicegrid.llm.common import SPACE, shielded, table

BINS, PAIR, UNIT = 10_007, 65_599, 1_000_000
#: Ids that are broadcast at most: some 100 MB as a hash table.
SMALL = 1_000_000
THRESHOLD = -0.25
LEAST_WORDS, REPEATED = 50, 50
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


def features(df: DataFrame, text: str) -> DataFrame:
    """The rows with `_f`, the bins of their tokens and pairs, instead of the text."""
    df = df.withColumn("_h", F.transform(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(TOKEN), F.lit(0)), lambda t: F.crc32(t))).drop(text)
    n = F.greatest(F.size("_h") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("_h", 1, n), F.slice("_h", 2, n), lambda a, b: (a * PAIR + b) % BINS)
    return df.withColumn("_f", F.concat(F.transform("_h", lambda h: h % BINS), pairs)).drop("_h")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of all documents that are labelled good, each once."""
    return labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str) -> list[int]:
    """For each bin, the log of trusted over raw probability in millionths."""
    good = trusted.withColumn("_g", F.lit(1))
    good = F.broadcast(good) if good.limit(SMALL + 1).count() <= SMALL else good
    marked = docs.select(F.col(id_col).alias("_d"), F.col(text_col).alias("_t")).join(good, F.col("_d") == F.col("_id"), "left")
    bins = features(marked.select("_t", F.coalesce("_g", F.lit(0)).alias("_g")), "_t")
    # explode() would have the optimiser compute the array in a filter first; explode_outer() doesn't
    bins = bins.select("_g", F.explode_outer("_f").alias("bin")).filter("bin is not null").groupBy("bin").agg(F.count("*").alias("n"), F.sum("_g").alias("g"))
    n, g = [0] * BINS, [0] * BINS
    for r in bins.collect():
        n[r["bin"]], g[r["bin"]] = r["n"], r["g"]
    if not sum(g):
        return [0] * BINS
    a, b = sum(n) + BINS, sum(g) + BINS
    return [round(UNIT * math.log((y + 1) / b / ((x + 1) / a))) for x, y in zip(n, g)]


def base(df: DataFrame, text: str) -> DataFrame:
    """The rows with the base measures and base_failed; the text goes."""
    t = F.coalesce(F.col(text), F.lit(""))
    blank = lambda x: F.regexp_replace(x, SPACE, "")
    keep = [c for c in df.columns if c != text]
    df = df.select(
        *keep,
        F.filter(F.split(t, SPACE), lambda w: w != "").alias("_w"),
        F.length(blank(t)).cast("bigint").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"),
    )
    df = df.withColumns({"n_words": F.size("_w").cast("bigint"), "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint"), "_w": F.transform("_w", lambda w: F.xxhash64(w))}).drop("_l")
    n = F.greatest(F.size("_w") - 2, F.lit(0))
    windows = F.zip_with(F.zip_with(F.slice("_w", 1, n), F.slice("_w", 2, n), lambda a, b: F.xxhash64(a, b)), F.slice("_w", 3, n), lambda a, b: F.xxhash64(a, b))
    df = df.withColumn("_w", windows)
    again = F.size(F.array_distinct("_w")) < F.size("_w")
    df = df.withColumn("_w", F.when(again, F.sort_array(F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, i: F.coalesce(x["h"] == F.get("_w", i - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get("_w", i + 1)["h"], F.lit(False))
    df = df.withColumn("_w", F.sort_array(F.transform(F.filter("_w", same), lambda x: x["i"])))
    covered = F.aggregate(F.transform("_w", lambda v, i: F.least(F.lit(3), F.coalesce(F.get("_w", i + 1) - v, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("_w")
    return df.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words")))


def judge(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` with the base measures, base_failed, score and kept. Columns of those names are replaced."""
    ratios = F.expr("cast(split('" + ",".join(map(str, log_ratios(docs, trusted, id_col, text_col))) + "', ',') as array<bigint>)")
    own = ["word_chars", "n_symbols", "n_dup_lines", "n_words", "n_repeat_words", "base_failed", "score", "kept"]
    row = docs.select(F.struct(*[c for c in docs.columns if c not in own]).alias("_row"), F.col(text_col).alias("_x"), F.col(text_col).alias("_y"))
    df = features(base(row, "_x"), "_y")
    total = F.aggregate("_f", F.lit(0).cast("bigint"), lambda a, f: a + F.get(ratios, f.cast("int")))
    df = df.withColumn("score", F.round(F.when(F.size("_f") > 0, total / F.size("_f") / UNIT).otherwise(0.0), 6))
    df = df.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    return shielded(F.col("_row"), {c: F.col(c) for c in own}, df)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, trusted_ids(table(spark, sf_dir, "labels"))).drop("text")


SQL = rf"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(n))),
d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT rid, unnest(w) AS w, unnest(range(len(w))) AS i FROM (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d)),
win AS (SELECT rid, i, w || chr(32) || lead(w) OVER o || chr(32) || lead(w, 2) OVER o AS t FROM words WINDOW o AS (PARTITION BY rid ORDER BY i)),
twice AS (SELECT rid, i FROM win WHERE t IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, t) > 1),
rep AS (SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, i + k AS j FROM twice, range(3) r(k)) GROUP BY rid),
lines AS (SELECT rid, count(*) - count(DISTINCT l) AS n FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
tok AS (SELECT rid, unnest(t) AS t, unnest(range(len(t))) AS i FROM (SELECT rid, regexp_extract_all(text, '{TOKEN}') AS t FROM d)),
hashed AS MATERIALIZED (SELECT u.t, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(strlen(u.t)), lambda k: ('0x' || substr(hex(encode(u.t)), (2 * k + 1)::INT, 2))::BIGINT)),
           lambda c, x: xor(c >> 8, list_extract(crc.t, (xor(c, x) & 255) + 1)))) AS h FROM (SELECT DISTINCT t FROM tok) u, crc),
th AS (SELECT rid, i, h FROM tok JOIN hashed USING (t)),
f AS MATERIALIZED (SELECT rid, h % {BINS} AS bin FROM th UNION ALL
      SELECT rid, (h * {PAIR} + h2) % {BINS} FROM (SELECT rid, h, lead(h) OVER (PARTITION BY rid ORDER BY i) AS h2 FROM th) WHERE h2 IS NOT NULL),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL),
c AS (SELECT bin, count(*) AS n, count(*) FILTER (rid IN (SELECT rid FROM d WHERE doc_id IN (SELECT doc_id FROM good))) AS g FROM f GROUP BY bin),
z AS (SELECT sum(n) + {BINS} AS a, sum(g) + {BINS} AS b, sum(g) AS g FROM c),
r AS (SELECT bin, CASE WHEN z.g = 0 THEN 0 ELSE round({UNIT} * ln((c.g + 1) / b / ((n + 1) / a)))::BIGINT END AS r FROM c, z),
s AS (SELECT rid, round(sum(r) / count(*) / {UNIT}, 6) AS score FROM f JOIN r USING (bin) GROUP BY rid),
m AS (SELECT doc_id, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '{SYMBOLS}'))::BIGINT AS n_symbols, coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(score, 0)::DOUBLE AS score
      FROM d LEFT JOIN lines USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN s USING (rid)),
b AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND score >= {THRESHOLD} AS kept FROM b
"""
