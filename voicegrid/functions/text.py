"""Text functions on columns.

Nulls stay null in all of them. Length is in code points, but for `visible_length`.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

WORDS = r"[^\x20\x09-\x0D]+"
SPACES = "[ \t\n\r\x0b\x0c 　]+"
CONTROLS = "[\x00-\x08\x0e-\x1f\x7f]"
#: Characters at the end of a post among which its ending is looked for; no polite ending is longer.
TAIL = 32
#: Characters no two of which, one after the other, are one visible character: up to U+02FF, written so that Java tells them fast, and Greek, Cyrillic, kana, Han and Hangul too.
LATIN = "[^\r\xa9\xae\u0300-\U0010ffff]"
SINGLE = "[\x00-\x0c\x0e-\xa8\xaa-\xad\xaf-\u02ff\u0370-\u0482\u048a-\u052f\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff\uac00-\ud7a3]"
EMOJI = "[\U0001f300-\U0001faff☀-➿]"


def stable_hash(x: Column) -> Column:
    """32 bits of MD5 as a long: the same number in any SQL engine."""
    return F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("bigint")


def pick(items: Column, x: Column) -> Column:
    """One of an array by hash; null if the array is empty."""
    return F.get(items, F.when(F.size(items) > 0, (stable_hash(x) % F.size(items)).cast("int")))


def strip(x: Column, controls: str = CONTROLS, spaces: str = SPACES) -> Column:
    """Control characters go, runs of white space become one space, the ends are trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(x, controls, ""), spaces, " "))


# The first syllable and the first jamo of Unicode's Hangul arithmetic, and how many vowels and tails there are.
SYLLABLE, LEAD, VOWEL, TAIL_JAMO = 0xAC00, 0x1100, 0x1161, 0x11A7
VOWELS, TAILS = 21, 28
_LEADS, _VOWELS, _TAILS = "[\u1100-\u1112]", "[\u1161-\u1175]", "[\u11a8-\u11c2]"


def character(code: Column) -> Column:
    """The character of a code point below 65,536."""
    return F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 4, "0")), "UTF-16BE")


def compose(x: Column) -> Column:
    """Decomposed Hangul as syllables: lead and vowel, with a tail if one follows, and a syllable without a tail with the one that follows.

    The text falls into such sequences and all between them, so that each is looked at by itself. Texts without jamo stay as they are.
    """

    def one(s: Column) -> Column:
        first, last = F.ascii(s), F.ascii(F.right(s, F.lit(1)))
        block = SYLLABLE + ((first - LEAD) * VOWELS + F.ascii(F.substring(s, 2, 1)) - VOWEL) * TAILS
        of_jamo = F.when(F.length(s) == 3, block + last - TAIL_JAMO).otherwise(block)
        open_block = (first - SYLLABLE) % TAILS == 0
        return F.when(s.rlike(f"^{_LEADS}{_VOWELS}"), character(of_jamo)).when(s.rlike(f"^[가-힣]{_TAILS}$") & open_block, character(first + last - TAIL_JAMO)).otherwise(s)

    parts = F.regexp_extract_all(x, F.lit(f"(?s)({_LEADS}{_VOWELS}{_TAILS}?|[가-힣]{_TAILS}|[^\u1100-\u1112가-힣]+|.)"), F.lit(1))
    return F.when(x.rlike(f"{_LEADS}{_VOWELS}|[가-힣]{_TAILS}"), F.array_join(F.transform(parts, one), "")).otherwise(x)


def decompose(x: Column) -> Column:
    """Hangul syllables as jamo, the opposite of `compose`."""

    def one(s: Column) -> Column:
        n = F.ascii(s) - SYLLABLE
        tail = n % TAILS
        pair = F.concat(character(LEAD + F.floor(n / (VOWELS * TAILS))), character(VOWEL + F.floor(n / TAILS) % VOWELS))
        return F.when(s.rlike("^[가-힣]"), F.when(tail == 0, pair).otherwise(F.concat(pair, character(TAIL_JAMO + tail)))).otherwise(s)

    parts = F.regexp_extract_all(x, F.lit("(?s)([가-힣]|[^가-힣]+)"), F.lit(1))
    return F.when(x.rlike("[가-힣]"), F.array_join(F.transform(parts, one), "")).otherwise(x)


def visible_length(x: Column) -> Column:
    """Characters as one sees them: extended grapheme clusters, so that joined emoji, flags, variation selectors and decomposed syllables count once.

    ASCII without carriage returns has one character a code point. In other texts runs of characters that are one each, among themselves, are
    counted by length, but for their first and last ones, which may belong to a neighbour. Only these and the rest go through Java's cluster
    automaton.
    """
    plain = F.octet_length(x) == F.length(x)
    left = x
    for one in (LATIN, SINGLE):
        left = F.regexp_replace(left, f"(?<={one}){one}+(?={one})", "")
    left = F.array(left)  # an array, so that it is made once
    less = F.get(F.transform(left, lambda y: F.length(y) - F.regexp_count(y, F.lit(r"\X"))), F.lit(0))
    return F.when(plain & ~F.contains(x, F.lit("\r")), F.length(x)).otherwise(F.length(x) - less).cast("bigint")


def html_to_text(x: Column) -> Column:
    """Visible text of HTML: scripts, styles and tags go, common entities are decoded."""
    x = F.regexp_replace(x, "(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    x = F.regexp_replace(x, "(?s)<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        x = F.replace(x, F.lit(entity), F.lit(char))
    return strip(x)


def emoji_count(x: Column) -> Column:
    return F.regexp_count(x, F.lit(EMOJI)).cast("bigint")


def hangul_count(x: Column) -> Column:
    return F.regexp_count(x, F.lit("[가-힣]")).cast("bigint")


def hangul_share(x: Column) -> Column:
    """Share of Hangul syllables among all code points; 0 for the empty text."""
    return F.when(F.length(x) > 0, hangul_count(x) / F.length(x)).otherwise(F.when(x.isNotNull(), F.lit(0.0)))


def symbol_share(x: Column) -> Column:
    """Share of characters that are neither letters, digits nor white space; 0 for the empty text."""
    return F.when(F.length(x) > 0, F.regexp_count(x, F.lit(r"[^\p{L}\p{N}\s]")) / F.length(x)).otherwise(F.when(x.isNotNull(), F.lit(0.0)))


def good_length(x: Column, least: int = 5, most: int = 500) -> Column:
    """Whether a post has at least `least` and at most `most` code points and isn't blank."""
    return F.coalesce(F.length(x).between(least, most) & (F.trim(x) != ""), F.lit(False))


def stem_and_mark(x: Column, polite: str = "") -> tuple[Column, Column]:
    """A sentence without its last punctuation marks (and a polite ending), and the last mark, '.' if there is none.

    Only the last TAIL characters go through regular expressions, the whole text only if all of those are marks.
    """
    tail = F.right(x, F.lit(TAIL))
    short = F.regexp_replace(tail, "[.!?]+$", "")
    stem = F.when(short == "", F.regexp_replace(x, "[.!?]+$", "")).otherwise(F.concat(F.left(x, F.greatest(F.length(x) - TAIL, F.lit(0))), short))
    if polite:
        kept = F.right(stem, F.lit(TAIL))
        stem = F.concat(F.left(stem, F.greatest(F.length(stem) - TAIL, F.lit(0))), F.regexp_replace(kept, polite, ""))
    last = F.right(x, F.lit(1))
    return stem, F.when(last.isin(".", "!", "?"), last).otherwise(F.lit("."))


def with_ending(x: Column, ending: Column, polite: str = "") -> Column:
    """The sentence end gives way to an animal's ending; the last punctuation mark stays, '.' if there is none."""
    stem, mark = stem_and_mark(x, polite)
    return F.concat(stem, ending, mark)
