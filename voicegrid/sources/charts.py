"""Bar charts of small aggregates as PNG or SVG files, named by a prefix."""

from pathlib import Path
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voicegrid.operators import profile
from voicegrid.sources import png

MOST_BARS = 1000


def bars(rows: list[tuple[str, float]], title: str) -> str:
    """SVG of a horizontal bar chart."""
    top, h = max([v for _, v in rows] or [1]) or 1, 24
    body = "".join(f'<text x="5" y="{40 + i * h + 15}" font-size="12">{escape(str(k))}</text><rect x="160" y="{40 + i * h + 3}" width="{400 * v / top:.1f}" height="16" fill="#4477aa"/><text x="{165 + 400 * v / top:.1f}" y="{40 + i * h + 15}" font-size="12">{v:g}</text>' for i, (k, v) in enumerate(rows))
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="640" height="{50 + h * len(rows)}"><text x="5" y="22" font-size="16">{escape(title)}</text>{body}</svg>'


def write_charts(df: DataFrame, prefix: str, length_of: str | None = None, kind: str = "svg") -> dict[str, str]:
    """Charts by post type, by emotion and by both, and of lengths if asked, as `svg` or `png`. Only aggregates reach the driver, the MOST_BARS first
    bars of a chart and one for the sum of all others."""
    out = {}
    for name, by in (("post_type_distribution", ["post_type"]), ("emotion_distribution", ["emotion"]), ("post_type_emotion_distribution", ["post_type", "emotion"])):
        if set(by) <= set(df.columns):
            out[name] = profile.counts(df, by).select(F.concat_ws(" / ", *by).alias("k"), "n").orderBy("k")
    if length_of:
        out["analysis"] = profile.length_histogram(df, length_of, 10).orderBy("chars_from").select(F.col("chars_from").cast("string").alias("k"), "n")
    paths = {}
    for name, table in out.items():
        paths[name] = f"{prefix}_{name}.{kind}"
        rows = [(r["k"], r["n"]) for r in table.limit(MOST_BARS).collect()]
        others = table.agg(F.sum("n")).first()[0] if len(rows) == MOST_BARS else 0
        others = (others or 0) - sum(n for _, n in rows) if others else 0
        rows += [("all others", others)] * bool(others)
        if kind == "png":
            png.write_bars(rows, name, paths[name])
        else:
            Path(paths[name]).write_text(bars(rows, name), encoding="utf-8")
    return paths
