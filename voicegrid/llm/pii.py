"""Personal data: base patterns, and terms that reveal what the patterns found.

Base kinds are e-mail addresses, IPv4 addresses, card numbers that pass Luhn's test, and phone numbers with a country code. The
values found are the protected entities. A line that holds an entity is its context. A term t (a word of LEAST letters or
more, in lower case) reveals an entity e by its pointwise mutual information with e as a share of e's information content,

    disclosure = log(n(t,e) * N / (n(t) * n(e))) / log(N / n(e)),

N being the corpus's lines with a word, n(.) the lines that hold what is in brackets. Counts cover all lines of all documents.
Terms that occur with e in SUPPORT different lines count: in one, as most personal data is in one line of the corpus only. There
all that a term discloses is how rare it is, as n(t,e) = n(e) gives 1 - log(n(t) / n(e)) / log(N / n(e)). In documents that hold
e, terms of a disclosure of GENERALISE or more become their class, those of REMOVE or more go; documents without a base span
aren't touched.

Spans are in code points, end exclusive; term spans don't overlap base spans. Everything is a column expression, a
grouping or a join by (id, hash of the text); texts aren't shuffled in finding spans, but for documents with base spans.

Null and empty texts have no spans. Rows that repeat have the same spans. Null ids are told apart by their texts.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voicegrid.llm.common import saved, table

KINDS = ("email", "ip", "card", "phone")
LEAST, SUPPORT, GENERALISE, REMOVE = 3, 1, 0.9, 0.97
SALTS = 16
TERM = r"\p{L}{" + str(LEAST) + r",}+"

# A match starts where its first run starts, or right after another match; \G says so without trying each place in a run.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Stands for one space or hyphen between two digits, so that a run of digits needs no group that Java would recurse on.
JOIN = ""
DIGITS = f"[0-9][0-9{JOIN}]++"
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
SPAN = "array<struct<s:int,e:int,m:string>>"


def matches(text: Column, pattern: str) -> Column:
    """Start, end and string of all matches of a pattern that matches no empty string."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("p"), found.alias("m"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def add(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.length(x["p"])
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.array_append(acc["out"], F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m"))).alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(both, start, add, lambda acc: acc["out"]))


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes Luhn's test."""
    r = F.reverse(number)

    def part(i: Column) -> Column:
        d = F.substring(r, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(number)), part), F.lit(0), lambda a, d: a + d) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Spans by kind, null or empty if there are none. `text` isn't null."""
    joined = F.regexp_replace(F.replace(text, F.lit(JOIN), F.lit("x")), "(?<=[0-9])[ -](?=[0-9])", JOIN)
    n = lambda x: F.length(digits(x["m"]))
    return {
        "email": F.when(F.contains(text, F.lit("@")), matches(text, EMAIL)),
        "ip": F.filter(matches(text, IP), lambda x: x["m"].rlike(f"^{BYTE}(?:\\.{BYTE}){{3}}$")),
        "card": F.when(text.rlike("[0-9](?:[ -]?[0-9]){12}"), F.filter(matches(joined, DIGITS), lambda x: n(x).between(13, 19) & luhn(digits(x["m"])))),
        "phone": F.when(F.contains(text, F.lit("+")), F.filter(matches(text, PHONE), lambda x: n(x).between(9, 15))),
    }


def _joined(kind: str, spans: Column) -> Column:
    """kind:start:end of the spans; an empty array if there are none."""
    return F.coalesce(F.transform(spans, lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string"))), F.array().cast("array<string>"))


def based(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, th, spans by kind, and the text if it has any."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.xxhash64(text_col).alias("th"))
    rows = rows.withColumns(base_spans(F.col("text")))
    some = F.greatest(*[F.coalesce(F.size(k), F.lit(0)) for k in KINDS]) > 0
    return rows.withColumn("text", F.when(some, F.col("text")))


def _all_base() -> Column:
    return F.concat(*[_spans_of(k) for k in KINDS])


def _spans_of(kind: str) -> Column:
    return F.coalesce(F.col(kind), F.array().cast(SPAN))


def mentions(found: DataFrame) -> DataFrame:
    """doc_id, th, entity and line for each line of a document that holds an entity."""
    text = F.col("text")

    def entities(kind: str) -> Column:
        def entity(x: Column) -> Column:
            value = digits(x["m"]) if kind in ("card", "phone") else F.lower(x["m"])
            before = F.substring(text, F.lit(1), x["s"])
            return F.struct(F.concat(F.lit(f"{kind}:"), value).alias("entity"), (x["s"] - F.length(F.substring_index(before, "\n", -1))).alias("at"))

        return F.transform(_spans_of(kind), entity)

    spans = F.concat(*map(entities, KINDS))
    rows = found.filter("text is not null").select("doc_id", "th", "text", F.explode_outer(F.array_distinct(spans)).alias("x"))
    return rows.select("doc_id", "th", "x.entity", F.substring_index(F.substring("text", F.col("x.at") + 1, F.length("text")), "\n", 1).alias("line"))


def terms(line: Column) -> Column:
    """The different terms of a line."""
    return F.array_distinct(F.regexp_extract_all(F.lower(line), F.lit(TERM), F.lit(0)))


def revealing(docs: DataFrame, held: DataFrame, text_col: str = "text") -> DataFrame:
    """entity, term and disclosure of the terms that reveal an entity by GENERALISE or more. `held` is what mentions() gives."""
    lines = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # the empty term stands for the line itself; explode_outer, as explode would have the words computed in a filter first
    words = F.flatten(F.transform(lines, lambda x: F.array_append(terms(x), F.lit(""))))
    counts = saved(docs.select(F.explode_outer(words).alias("t")).filter("t is not null").groupBy("t").agg(F.count("*").alias("n_t")))
    whole = counts.filter("t = ''").first()
    n = F.lit(float(whole["n_t"] if whole else 0))
    n_e = held.groupBy(F.col("entity").alias("e")).agg(F.count("*").alias("n_e"))
    pairs = held.select("entity", F.xxhash64("line").alias("h"), F.explode_outer(terms(F.col("line"))).alias("term")).filter("term is not null")
    joint = pairs.groupBy("entity", "term", "h").agg(F.count("*").alias("n")).groupBy("entity", "term").agg(F.sum("n").alias("n_te"), F.count("*").alias("lines")).filter(F.col("lines") >= SUPPORT)
    both = joint.join(counts, F.col("term") == F.col("t")).join(n_e, F.col("entity") == F.col("e"))
    share = F.when(n > F.col("n_e"), F.ln(F.col("n_te") * n / (F.col("n_t") * F.col("n_e"))) / F.ln(n / F.col("n_e")))
    return both.select("entity", "term", F.round(share, 6).alias("disclosure")).filter(F.col("disclosure") >= GENERALISE)


def term_spans(found: DataFrame, held: DataFrame, revealed: DataFrame) -> DataFrame:
    """_d, _h and `term`, the spans of revealing terms (m: null if the term goes, else its class), of documents that have any."""
    salted = held.select("doc_id", "th", "entity").distinct().withColumn("salt", F.pmod(F.xxhash64("doc_id", "th"), F.lit(SALTS)))
    each = revealed.select(F.col("entity").alias("e"), F.struct("term", "disclosure").alias("t"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    wanted = salted.join(each, (F.col("entity") == F.col("e")) & (F.col("salt") == F.col("s"))).groupBy(F.col("doc_id").alias("_d"), F.col("th").alias("_h"))
    wanted = wanted.agg(F.collect_set("t.term").alias("terms"), F.collect_set(F.when(F.col("t.disclosure") >= REMOVE, F.col("t.term"))).alias("gone"))
    texts = found.filter("text is not null").dropDuplicates(["doc_id", "th"])
    rows = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_h"))).withColumn("base", _all_base())
    apart = lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
    picked = F.filter(matches(F.col("text"), TERM), lambda x: F.array_contains(F.col("terms"), F.lower(x["m"])) & apart(x))
    kind = lambda m: F.when(F.array_contains(F.col("gone"), F.lower(m)), F.lit(None).cast("string")).when(m.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")
    return rows.withColumn("_p", picked).select("_d", "_h", F.transform("_p", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), kind(x["m"]).alias("m"))).alias("term"))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, th (xxhash64 of the text), and the spans of each kind and of revealing terms; one row for each row of docs."""
    found = saved(based(docs, id_col, text_col))
    held = mentions(found)
    extra = term_spans(found, held, revealing(docs, held, text_col))
    return found.drop("text").join(extra, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("th").eqNullSafe(F.col("_h")), "left").drop("_d", "_h")


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with base spans as [EMAIL] and so on, revealing terms as their class or gone. Of overlapping spans the first and longest counts."""
    own = spans(docs, id_col, text_col)
    mark = lambda x, m: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), m.alias("m"))
    base = lambda k: F.transform(_spans_of(k), lambda x: mark(x, F.lit(f"[{k.upper()}]")))
    marks = F.array_sort(F.concat(*map(base, KINDS), F.transform(_spans_of("term"), lambda x: mark(x, F.coalesce(x["m"], F.lit(""))))))
    own = own.select(F.col("doc_id").alias("_d"), F.col("th").alias("_h"), marks.alias("_m")).filter(F.size("_m") > 0).dropDuplicates(["_d", "_h"])
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_th"))
    rows = rows.join(own, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_th") == F.col("_h")), "left")
    text = F.col(f"_row.{text_col}")

    def step(acc: Column, x: Column) -> Column:
        out = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), x["m"])
        return F.when(x["s"] >= acc["at"], F.struct((-x["e"]).alias("at"), out.alias("out"))).otherwise(acc)

    clean = F.aggregate("_m", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return rows.select(*[(F.when(F.col("_m").isNotNull(), clean).otherwise(text) if c == text_col else F.col(f"_row.{c}")).alias(c) for c in docs.columns])


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.coalesce(F.size(k), F.lit(0)).cast("bigint").alias(f"n_{k}") for k in KINDS]
    base = F.concat(*[_joined(k, F.col(k)) for k in KINDS])
    return found.select("doc_id", *counts, F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(F.concat(base, _joined("term", F.col("term"))), ",").alias("spans"))
