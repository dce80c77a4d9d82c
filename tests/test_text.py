import random
import re
import unicodedata

import regex
from pyspark.sql import functions as F

from voicegrid import rules
from voicegrid.functions import text as X
from voicegrid.operators import clean, generate

PIECES = ["가", "각", "힣", "좋네요!", "ㄱ", "ᄀ", "ᅡ", "ᆨ", "ᆧ", "ᄓ", "ᆨᆨ", "a", " ", "\n", "🐾", "❤️", "👩‍👩‍👧", "🇰🇷", "🇰", "\r\n", "\r", "é", "‍", "️", "😾🏽"]


def texts(seed, n=400):
    r = random.Random(seed)
    out = ["".join(r.choice(PIECES) for _ in range(r.randrange(12))) for _ in range(n)]
    return out + [unicodedata.normalize("NFD", t) for t in out] + ["", None]


def test_compose_and_decompose_equal_unicode(spark):
    rows = list(enumerate(texts(1)))
    got = spark.createDataFrame(rows, "i int, t string").select("i", X.compose(F.col("t")).alias("c"), X.decompose(F.col("t")).alias("d")).collect()
    keep = {"é": unicodedata.normalize("NFD", "é")}
    hangul = regex.compile(r"[ᄀ-하-ᅵᆨ-ᇂ가-힣]+")
    for (_, t), r in zip(rows, sorted(got), strict=True):
        for form, mine in (("NFC", r.c), ("NFD", r.d)):
            assert mine == (None if t is None else hangul.sub(lambda m: unicodedata.normalize(form, m[0]), t)), (t, form)
    assert keep


def test_visible_length_equals_another_engine(spark):
    rows = list(enumerate(texts(2)))
    got = {r.i: r.n for r in spark.createDataFrame(rows, "i int, t string").select("i", X.visible_length(F.col("t")).alias("n")).collect()}
    assert got == {i: None if t is None else len(regex.findall(r"\X", t)) for i, t in rows}
    assert spark.createDataFrame([("👩‍👩‍👧❤️🇰🇷" + unicodedata.normalize("NFD", "각"),)], "t string").select(X.visible_length(F.col("t"))).first()[0] == 4


def test_visible_length_of_runs_between_clusters(spark):
    r = random.Random(3)
    runs = ["plain words, ", "Füße über ", "ça va été", "좋은 아침이에요", "가각힣", "кот ", "ねこ", "猫猫猫", "\n\n", "a\r\nb", "©®", "\u0600", "\u0600\n", "\xad", "e\u0301", "\u0903", "1️⃣", "ᄀ가나", "각", *PIECES]
    rows = list(enumerate("".join(r.choice(runs) for _ in range(r.randrange(14))) for _ in range(2000)))
    got = spark.createDataFrame(rows, "i int, t string").select("t", X.visible_length(F.col("t")).alias("n"), F.regexp_count("t", F.lit(r"\X")).alias("whole")).collect()
    assert [x for x in got if x.n != x.whole] == []


def test_runs_between_clusters_are_not_matched_one_by_one(spark):
    """No automaton runs over characters within a run, which would take some hundred times as long."""
    text, korean = "Füße über Straßen " * 20, "좋은아침이에요" * 20
    for one in (X.LATIN, X.SINGLE):
        left = re.sub(f"(?<={one}){one}+(?={one})", "", "❤️" + text + "👩‍👩‍👧" + text)
        assert len(left) == 2 + 2 + 5 + 2
        single = [chr(i) for i in range(0x10000) if re.fullmatch(one, chr(i))]
        assert all(len(regex.findall(r"\X", c + d)) == 2 for c, d in zip(single, single[1:] + single[:1], strict=True))
        assert all(len(regex.findall(r"\X", c * 2)) == 2 for c in single)
    assert len(re.sub(f"(?<={X.SINGLE}){X.SINGLE}+(?={X.SINGLE})", "", "❤️" + korean)) == 4


def test_decomposed_posts_get_endings_as_composed_ones_do(spark):
    said = ["오늘 날씨가 정말 좋네요!", "배고파요.", "뭐 해요?", "그냥 그래요"]
    both = [spark.createDataFrame([(i, unicodedata.normalize(f, t)) for i, t in enumerate(said)], "id long, content string") for f in ("NFC", "NFD")]
    one, two = (sorted(map(str, generate.transform(clean.quality(clean.cleaned(x)), "id").collect())) for x in both)
    assert one == two and len(one) == 12 * len(said) and rules.POLITE
