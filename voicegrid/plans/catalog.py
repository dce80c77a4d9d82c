"""The query catalogue. Each query runs an operator over whole tables; SQL holds the equivalent for DuckDB.

The driver's tables stand in for posts: `documents` for originals with (source, lang) as keys, `pages` for crawled text,
`conversations` for short posts, `events` for API calls with user_id % 9 as key.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voicegrid import rules
from voicegrid.functions import jsonfix
from voicegrid.functions import text as X
from voicegrid.operators import clean, generate, grid, profile, schedule
from voicegrid.schemas import AUGMENTED
from voicegrid.sources import files, json_arrays

LANGS = ["de", "en", "es", "fr"]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _calls(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").withColumn("key_id", F.col("user_id") % 9)


def _broken(props: F.Column, i: F.Column) -> F.Column:
    """Props as a model might have returned them: fenced, with a trailing comma, or with prose around."""
    return F.when(i % 3 == 0, F.concat(F.lit("```json\n"), props, F.lit("\n```"))).when(i % 3 == 1, F.regexp_replace(props, "\\}$", ", }")).otherwise(F.concat(F.lit("Sure: "), props, F.lit(" done")))


def _cut(props: F.Column, i: F.Column) -> F.Column:
    """Props within a longer answer that ends too soon, or has comments, bare keys, single quotes or brackets closed in the wrong order."""
    note, k = F.concat(F.lit('"note": "so, {so}'), i, F.lit(",] ")), F.concat(F.lit('{"event": '), i, F.lit(', "in": {"props": '), props)
    return (
        F.when(i % 6 == 0, F.concat(F.lit("Here [you] are:\n```json\n"), k, F.lit(", "), note))
        .when(i % 6 == 1, F.concat(k, F.lit('}, "rest": [1, {"half": 12')))
        .when(i % 6 == 2, F.concat(F.lit("{'event': "), i, F.lit(", in: {props: "), props, F.lit(", /* more */ 'note': 'it\\'s \"so\",]'}}")))
        .when(i % 6 == 3, F.regexp_replace(F.concat(k, F.lit("}}")), r"\d+\}+$", ""))
        .when(i % 6 == 4, F.concat(F.lit("["), k, F.lit(",,"), note, F.lit('" ] }, {"event": -1}]')))
        .otherwise(F.concat(k, F.lit("}}")))
    )


def _admitted(s, d):
    return schedule.admitted(_calls(s, d), "ts", "key_id", "event_id", "hour", 2).select("event_id", "key_id", "admitted")


def _round_trip(s, d):
    """Originals written as JSONL to the shared folder and read back."""
    to = f"{files.shared_dir(s)}/jsonl-{uuid.uuid4()}"
    files.write_jsonl(table(s, d, "documents").select(F.col("text").alias("content")), to)
    return files.split_corrupt(files.read_originals(s, to))[0]


def _augmented(s, d):
    """Posts in all voices written as JSONL and read back by the schema of augmented records."""
    to = f"{files.shared_dir(s)}/jsonl-{uuid.uuid4()}"
    rows = generate.transform(table(s, d, "conversations").select(F.concat_ws("|", "conv_id", "turn").alias("id"), F.col("text").alias("content")), "id")
    files.write_jsonl(rows.select(*AUGMENTED.names), to)
    return files.split_corrupt(files.read_augmented(s, to))[0]


def _array(s, d):
    """Documents written as JSON arrays and read by ranges of bytes."""
    to = f"{files.shared_dir(s)}/array-{uuid.uuid4()}"
    docs = table(s, d, "documents").select("doc_id", "text", F.struct("lang", "source").alias("of"))
    json_arrays.write_arrays(docs, to)
    return json_arrays.read_array(s, to, docs.schema).select("doc_id", "text", "of.lang", "of.source")


QUERIES = {
    "q01_counts": lambda s, d: profile.counts(table(s, d, "documents"), ["lang"], "text"),
    "q02_mean_length": lambda s, d: profile.counts(table(s, d, "documents"), [], "text"),
    "q01b_counts_by_file": lambda s, d: profile.counts_by_file(table(s, d, "documents"), "text"),
    "q02b_visible_length": lambda s, d: profile.counts(generate.transform(table(s, d, "documents").select("doc_id", F.col("text").alias("content")), "doc_id"), ["post_type", "emotion"], "transformed_content", visible=True),
    "q03_shares": lambda s, d: profile.shares(table(s, d, "documents"), ["source"]),
    "q04_two_keys": lambda s, d: profile.counts(table(s, d, "documents"), ["source", "lang"]),
    "q05_pivot": lambda s, d: profile.cross_table(table(s, d, "documents"), "source", "lang", LANGS),
    "q06_rollup": lambda s, d: profile.with_totals(table(s, d, "documents"), ["lang", "source"]),
    "q07_balance": lambda s, d: profile.balance(table(s, d, "documents"), "lang"),
    "q08_length_histogram": lambda s, d: profile.length_histogram(table(s, d, "documents"), "text"),
    "q08b_length_summary": lambda s, d: profile.length_summary(table(s, d, "documents"), "text", ["lang"]),
    "q09_strip": lambda s, d: table(s, d, "documents").select("doc_id", X.strip(F.col("text")).alias("content")),
    "q10_html": lambda s, d: table(s, d, "pages").select("page_id", X.html_to_text(F.col("html")).alias("content")),
    "q11_quality": lambda s, d: clean.quality(table(s, d, "documents"), "text", 5, 2000, symbols=0.2).select("doc_id", "n_chars"),
    "q12_keep_first": lambda s, d: clean.keep_first(table(s, d, "documents"), "text", "doc_id", ["doc_id", "n_chars"]),
    "q12b_newest": lambda s, d: clean.newest(table(s, d, "documents").select("doc_id", "source", "lang", "n_chars"), ["source", "lang"], "doc_id"),
    "q13_semi": lambda s, d: table(s, d, "documents").join(table(s, d, "labels").select("doc_id"), "doc_id", "left_semi").select("doc_id", "lang"),
    "q14_anti": lambda s, d: table(s, d, "documents").join(table(s, d, "labels").select("doc_id"), "doc_id", "left_anti").select("doc_id", "lang"),
    "q15_merge": lambda s, d: clean.merge([table(s, d, "documents").select(F.col("text").alias("content")), table(s, d, "conversations").filter("role = 'user'").select(F.col("text").alias("content"))]),
    "q15b_merge_distinct": lambda s, d: clean.merge([table(s, d, "documents").select(F.col("text").alias("content")), table(s, d, "conversations").select(F.col("text").alias("content"))], ["content"]),
    "q16_grid": lambda s, d: grid.fan_out(table(s, d, "documents").select("doc_id")).select("doc_id", "post_type", "emotion", "tone"),
    "q17_two_emotions": lambda s, d: grid.n_emotions(table(s, d, "documents").select("doc_id"), "doc_id", 2),
    "q18_balanced_quota": lambda s, d: grid.balanced(table(s, d, "documents").select("doc_id", "lang"), ["lang"], "doc_id", 50),
    "q19_target_count": lambda s, d: grid.target_count(table(s, d, "documents").select("doc_id"), "doc_id", 100),
    "q19b_large_target": lambda s, d: grid.target_count(generate.transform(table(s, d, "conversations").select(F.concat_ws("|", "conv_id", "turn").alias("id"), F.col("text").alias("content")), "id").withColumn("_k", F.concat_ws("|", "id", "post_type", "emotion")), "_k", 2000, small=1000).select("id", "post_type", "emotion"),
    "q20_topics": lambda s, d: grid.topics_by_emotion(s, table(s, d, "documents").select("source")),
    "q21_pick_ending": lambda s, d: table(s, d, "documents").select("doc_id", X.pick(F.array(*map(F.lit, rules.ENDINGS["cat"])), F.col("doc_id").cast("string")).alias("ending")),
    "q22_ending": lambda s, d: table(s, d, "conversations").select("conv_id", "turn", X.with_ending(F.col("text"), F.lit("냥"), rules.POLITE).alias("spoken")),
    "q23_transform": lambda s, d: generate.transform(table(s, d, "documents").select("doc_id", F.col("text").alias("content")), "doc_id"),
    "q23b_prompt": lambda s, d: generate.with_prompt(grid.fan_out(table(s, d, "conversations").select("conv_id", "turn", F.col("text").alias("content")))).select("conv_id", "turn", "post_type", "emotion", "prompt"),
    "q24_round_robin": lambda s, d: schedule.round_robin(table(s, d, "events").select("event_id", "ts"), "ts", "event_id").select("event_id", "pos", "key_id", "minute"),
    "q24b_start_times": lambda s, d: schedule.start_times(table(s, d, "events").select("event_id", "ts"), "ts", "event_id", 9, 2, 43200, 16).select("event_id", "key_id", F.col("starts").cast("timestamp_ntz").alias("starts")),
    "q25_usage": lambda s, d: schedule.usage(_calls(s, d), F.col("ts").cast("timestamp"), "key_id", "1 hour"),
    "q26_rolling_usage": lambda s, d: schedule.rolling_usage(_calls(s, d).select("event_id", "ts", "key_id"), "ts", "key_id", 3600).select("event_id", "n_recent"),
    "q27_admitted": _admitted,
    "q28_least_used": lambda s, d: schedule.least_used(_calls(s, d).withColumn("one", F.lit(1)), "key_id", "one"),
    "q29_json_field": lambda s, d: table(s, d, "events").select("event_id", jsonfix.parse(F.col("props"), "k bigint")["k"].alias("k")),
    "q30_json_repair": lambda s, d: table(s, d, "events").select("event_id", jsonfix.parse(_broken(F.col("props"), F.col("event_id")), "k bigint")["k"].alias("k")),
    "q30b_json_cut": lambda s, d: table(s, d, "events").select("event_id", jsonfix.parse(_cut(F.col("props"), F.col("event_id")), "event bigint, in struct<props: struct<k: bigint>, note: string>").alias("p")).select("event_id", F.col("p.event").alias("event"), F.col("p.in.props.k").alias("k"), F.col("p.in.note").alias("note")),
    "q31_ratio": lambda s, d: profile.ratio(table(s, d, "documents").select("doc_id"), grid.fan_out(table(s, d, "documents").select("doc_id"))),
    "q33_jsonl": _round_trip,
    "q33b_augmented": _augmented,
    "q35_json_array": _array,
    "q36_compose": lambda s, d: generate.transform(table(s, d, "conversations").select("conv_id", "turn", F.concat_ws("|", "conv_id", "turn").alias("id"), F.col("text").alias("content")), "id").select("conv_id", "turn", "post_type", "emotion", X.compose(X.decompose(F.col("transformed_content"))).alias("spoken"), F.length(X.decompose(F.col("transformed_content"))).alias("jamo_chars")),
    "q34_domain_check": lambda s, d: clean.domain_check(table(s, d, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, " Happy").when(F.col("doc_id") % 3 == 1, "SAD ").otherwise("odd").alias("emotion"), F.lit("Cat").alias("post_type"), F.col("text").alias("transformed_content")))[0].select("doc_id", "emotion"),
    "q32_hangul_emoji": lambda s, d: generate.voice_profile(table(s, d, "documents").select("doc_id", F.col("text").alias("content")), "doc_id"),
}

_H = "('0x' || substr(md5({}), 1, 8))::BIGINT"
_CELLS = "(VALUES " + ", ".join(f"('{p}', '{e}', '{t}')" for (p, e), t in sorted(rules.TONES.items())) + ") c(post_type, emotion, tone)"
_EMOTIONS = "(VALUES " + ", ".join(f"('{e}')" for e in sorted(rules.EMOJIS)) + ") e(emotion)"
_LIST = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]::VARCHAR[]"
_ENDINGS = "CASE post_type " + " ".join(f"WHEN '{p}' THEN {_LIST(x)}" for p, x in rules.ENDINGS.items()) + " END"
_EMOJIS = "CASE emotion " + " ".join(f"WHEN '{e}' THEN {_LIST(x)}" for e, x in rules.EMOJIS.items()) + " END"
_STRIP = r"trim(regexp_replace(regexp_replace({}, '[\x00-\x08\x0e-\x1f\x7f]', '', 'g'), '[ \t\n\r\x0b\x0c\x{{a0}}\x{{3000}}]+', ' ', 'g'), ' ')"
_SPOKEN = "regexp_replace(regexp_replace({0}, '[.!?]+$', ''), '" + rules.POLITE + "', '') || {1} || CASE WHEN regexp_matches({0}, '[.!?]$') THEN right({0}, 1) ELSE '.' END"
_PICK = "list_extract({0}, CASE WHEN len({0}) > 0 THEN (" + _H.format("{1}") + " % len({0}) + 1) END)"
_SEED = "concat_ws('|', doc_id::VARCHAR, post_type, emotion)"
_TRANSFORM = f"""SELECT doc_id, text AS content, post_type, emotion, CASE WHEN text IS NOT NULL THEN concat_ws(' ', {_SPOKEN.format('text', _PICK.format(_ENDINGS, _SEED))}, {_PICK.format(_EMOJIS, _SEED)}) END AS transformed_content FROM documents, {_CELLS}"""
_SPEAK = _TRANSFORM.replace("SELECT doc_id, text AS content", "SELECT conv_id, turn, text AS content").replace("FROM documents", "FROM conversations").replace("doc_id::VARCHAR", "concat_ws('|', conv_id, turn)")
_HTML = r"regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"
for _a, _b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
    _HTML = f"replace({_HTML}, '{_a}', '{_b}')"
_PROMPT = "'" + rules.PROMPT + "'"
for _name, _value in {"post_type": "post_type", "emotion": "emotion", "tone": "tone", "endings": f"array_to_string({_ENDINGS}, ', ')", "emojis": f"coalesce(array_to_string({_EMOJIS}, ' '), '')", "content": "coalesce(text, '')"}.items():
    _PROMPT = f"replace({_PROMPT}, '{{{_name}}}', {_value})"

SQL = {
    "q01_counts": "SELECT lang, count(*) AS n, round(avg(length(text)), 1) AS mean_chars FROM documents GROUP BY lang",
    "q02_mean_length": "SELECT count(*) AS n, round(avg(length(text)), 1) AS mean_chars FROM documents",
    "q01b_counts_by_file": "SELECT 'documents.parquet' AS file, count(*) AS n, round(avg(length(text)), 1) AS mean_chars FROM documents",
    "q02b_visible_length": f"SELECT post_type, emotion, count(*) AS n, round(avg(length(transformed_content)), 1) AS mean_chars, round(avg(length_grapheme(transformed_content)), 1) AS mean_visible FROM ({_TRANSFORM}) GROUP BY 1, 2",
    "q03_shares": "SELECT source, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM documents GROUP BY source",
    "q04_two_keys": "SELECT source, lang, count(*) AS n FROM documents GROUP BY source, lang",
    "q05_pivot": "SELECT source, " + ", ".join(f"count(*) FILTER (lang = '{x}') AS {x}" for x in LANGS) + " FROM documents GROUP BY source",
    "q06_rollup": "SELECT lang, source, count(*) AS n, grouping(lang, source)::BIGINT AS level FROM documents GROUP BY ROLLUP (lang, source)",
    "q07_balance": "WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), p AS (SELECT n, n / sum(n) OVER () AS p FROM c) SELECT count(*) AS groups, max(n) - min(n) AS spread, round(max(n) / min(n), 4) AS ratio, round(CASE WHEN count(*) > 1 THEN -sum(p * ln(p)) / ln(count(*)) ELSE 1.0 END, 4) AS entropy, round((sum(n * n) - avg(n) * sum(n)) / avg(n), 4) AS chi2 FROM p",
    "q08_length_histogram": "SELECT (length(text) // 500 * 500)::BIGINT AS chars_from, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "q08b_length_summary": "SELECT lang, count(*) AS n, min(length(text)) AS min_chars, round(avg(length(text)), 1) AS mean_chars, max(length(text)) AS max_chars, " + ", ".join(f"round(quantile_cont(length(text), {p / 100}), 2) AS p{p}" for p in (25, 50, 75)) + " FROM documents WHERE text IS NOT NULL GROUP BY lang",
    "q09_strip": f"SELECT doc_id, {_STRIP.format('text')} AS content FROM documents",
    "q10_html": f"SELECT page_id, {_STRIP.format(_HTML)} AS content FROM pages",
    "q11_quality": r"SELECT doc_id, n_chars FROM documents WHERE length(text) BETWEEN 5 AND 2000 AND trim(text, ' ') <> '' AND length(regexp_replace(text, '[\p{L}\p{N}\s]', '', 'g')) / length(text) <= 0.2",
    "q12_keep_first": "SELECT min(doc_id) AS doc_id, min(n_chars) AS n_chars FROM documents GROUP BY text",
    "q12b_newest": "SELECT doc_id, source, lang, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY doc_id DESC) = 1",
    "q33_jsonl": "SELECT text AS content FROM documents",
    "q33b_augmented": f"SELECT content, emotion, post_type, transformed_content FROM ({_SPEAK})",
    "q35_json_array": "SELECT doc_id, text, lang, source FROM documents",
    "q36_compose": f"SELECT conv_id, turn, post_type, emotion, transformed_content AS spoken, length(transformed_content) + length(regexp_replace(transformed_content, '[^가-힣]', '', 'g')) + list_sum(list_transform(string_split(regexp_replace(transformed_content, '[^가-힣]', '', 'g'), ''), lambda c: CASE WHEN c <> '' AND (unicode(c) - 44032) % 28 > 0 THEN 1 ELSE 0 END))::INT AS jamo_chars FROM ({_SPEAK})",
    "q34_domain_check": "SELECT doc_id, trim(lower(CASE WHEN doc_id % 3 = 0 THEN ' Happy' WHEN doc_id % 3 = 1 THEN 'SAD ' ELSE 'odd' END), ' ') AS emotion FROM documents WHERE doc_id % 3 < 2 AND text IS NOT NULL",
    "q13_semi": "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "q14_anti": "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "q15_merge": "SELECT text AS content FROM documents UNION ALL SELECT text FROM conversations WHERE role = 'user'",
    "q15b_merge_distinct": "SELECT text AS content FROM documents UNION SELECT text FROM conversations",
    "q16_grid": f"SELECT doc_id, post_type, emotion, tone FROM documents, {_CELLS}",
    "q17_two_emotions": f"SELECT doc_id, emotion FROM documents, {_EMOTIONS} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY {_H.format('doc_id::VARCHAR || chr(124) || emotion')}, emotion) <= 2",
    "q18_balanced_quota": f"SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {_H.format('doc_id::VARCHAR')}, doc_id) <= 50",
    "q19_target_count": f"SELECT doc_id FROM documents ORDER BY {_H.format('doc_id::VARCHAR')}, doc_id LIMIT 100",
    "q19b_large_target": f"SELECT id, post_type, emotion FROM (SELECT concat_ws('|', conv_id, turn) AS id, post_type, emotion FROM conversations, {_CELLS}) ORDER BY {_H.format("concat_ws('|', id, post_type, emotion)")}, concat_ws('|', id, post_type, emotion) LIMIT 2000",
    "q20_topics": f"SELECT topic, emotion FROM (SELECT DISTINCT source AS topic FROM documents), {_EMOTIONS}",
    "q21_pick_ending": f"SELECT doc_id, {_PICK.format(_LIST(rules.ENDINGS['cat']), 'doc_id::VARCHAR')} AS ending FROM documents",
    "q22_ending": f"SELECT conv_id, turn, {_SPOKEN.format('text', chr(39) + '냥' + chr(39))} AS spoken FROM conversations",
    "q23_transform": _TRANSFORM,
    "q23b_prompt": f"SELECT conv_id, turn, post_type, emotion, {_PROMPT} AS prompt FROM conversations, {_CELLS}",
    "q24_round_robin": "SELECT event_id, pos, pos % 9 AS key_id, pos // 135 AS minute FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events)",
    "q24b_start_times": """WITH RECURSIVE e AS (SELECT event_id, ts, pos, pos % 18 AS lane, pos // 18 AS j FROM (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events)),
        r AS (SELECT event_id, pos, lane, j, ts AS starts FROM e WHERE j = 0 UNION ALL SELECT e.event_id, e.pos, e.lane, e.j, greatest(e.ts, r.starts + INTERVAL 43200 SECOND) FROM r JOIN e ON e.lane = r.lane AND e.j = r.j + 1)
        SELECT event_id, pos % 9 AS key_id, starts FROM r""",
    "q25_usage": "SELECT date_trunc('hour', ts) AS window_start, user_id % 9 AS key_id, count(*) AS n_calls FROM events GROUP BY 1, 2",
    "q26_rolling_usage": "SELECT event_id, count(*) OVER (PARTITION BY user_id % 9 ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS n_recent FROM events",
    "q27_admitted": "SELECT event_id, user_id % 9 AS key_id, row_number() OVER (PARTITION BY user_id % 9, date_trunc('hour', ts) ORDER BY ts, event_id) <= 2 AS admitted FROM events",
    "q28_least_used": "SELECT user_id % 9 AS key_id, count(*) AS used FROM events GROUP BY 1 ORDER BY 2, 1 LIMIT 1",
    "q29_json_field": "SELECT event_id, (props ->> 'k')::BIGINT AS k FROM events",
    "q30_json_repair": "SELECT event_id, (props ->> 'k')::BIGINT AS k FROM events",
    "q30b_json_cut": """SELECT event_id, event_id AS event, CASE WHEN event_id % 6 <> 3 THEN (props ->> 'k')::BIGINT END AS k,
        CASE event_id % 6 WHEN 2 THEN 'it''s "so",]' WHEN 4 THEN 'so, {so}' || event_id || ',] ' END AS note FROM events""",
    "q31_ratio": "SELECT count(*) AS originals, 12 * count(*) AS augmented, round(12.0, 1) AS ratio FROM documents",
    "q32_hangul_emoji": f"SELECT doc_id, post_type, emotion, length(regexp_replace(t, '[^\\x{{1F300}}-\\x{{1FAFF}}\\x{{2600}}-\\x{{27BF}}]', '', 'g')) AS emojis, round(length(regexp_replace(t, '[^가-힣]', '', 'g')) / length(t), 6) AS hangul FROM (SELECT *, transformed_content AS t FROM ({_TRANSFORM}))",
}
