"""The twelve cells of the voice grid: tone, emojis and sentence endings by animal and emotion."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Sentence endings by animal.
ENDINGS = {
    "cat": ["냥", "냐옹", "다옹"],
    "dog": ["멍", "냐왈", "다왈"],
}

# Emojis by emotion.
EMOJIS = {
    "happy": ["❤️", "💛", "✨"],
    "curious": ["🫨", "❓"],
    "sad": ["😢"],
    "grumpy": [],
    "angry": ["😾", "💢", "🔥"],
    "normal": ["🐾"],
}

# Tone by animal and emotion.
TONES = {
    ("cat", "happy"): "bright, excited",
    ("cat", "curious"): "wondering, sniffing",
    ("cat", "sad"): "drooping, lonely",
    ("cat", "grumpy"): "haughty, refined",
    ("cat", "angry"): "prickly, angry",
    ("cat", "normal"): "plain, calm",
    ("dog", "happy"): "bright, lively",
    ("dog", "curious"): "full of curiosity",
    ("dog", "sad"): "dejected",
    ("dog", "grumpy"): "complaining",
    ("dog", "angry"): "aggressive",
    ("dog", "normal"): "cheerful, everyday",
}

#: Polite endings that the rule generator takes off before it adds an animal's ending.
POLITE = "(습니다|네요|이에요|예요|어요|아요|해요|요)$"

#: How many topics seed generated originals. Their names are configuration; these are placeholders.
TOPICS = [f"topic_{i:02d}" for i in range(1, 24)]

TOPIC_PROMPT = "Write one short social media post about {topic} in a {emotion} mood."

PROMPT = "Rewrite the post as a {post_type} in a {emotion} mood ({tone}). Endings: {endings}. Emojis: {emojis}. Post: {content}"


def cells(rows: dict | None = None, sounds: dict[str, list[str]] | None = None, expressions: dict[tuple[str, str], list[str]] | None = None) -> Column:
    """The grid as a literal array of structs. Exploding it fans a post out without any join.

    `sounds` are onomatopoeia by animal, `expressions` phrases by animal and emotion; no lists of them are published, so there are none by default.
    """
    tones = rows or TONES
    return F.array(
        *[
            F.struct(
                F.lit(p).alias("post_type"),
                F.lit(e).alias("emotion"),
                F.lit(tone).alias("tone"),
                F.array(*map(F.lit, ENDINGS[p])).alias("endings"),
                F.array(*map(F.lit, EMOJIS[e])).cast("array<string>").alias("emojis"),
                F.array(*map(F.lit, (sounds or {}).get(p, []))).cast("array<string>").alias("sounds"),
                F.array(*map(F.lit, (expressions or {}).get((p, e), []))).cast("array<string>").alias("expressions"),
            )
            for (p, e), tone in sorted(tones.items())
        ]
    )


def rules(spark: SparkSession) -> DataFrame:
    """The rule dimension: twelve rows."""
    return spark.range(1).select(F.explode(cells()).alias("c")).select("c.*")
