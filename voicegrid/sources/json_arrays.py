"""Large JSON documents, an array of objects or one object, read by ranges of bytes.

Spark's text source splits a file at a separator, and here that is the closing brace: each task gets the pieces of its ranges, whatever
store holds them. Whether a brace is one of JSON's or a character in a string depends on all text before it, so two passes are made. The
first reads each range for both states that it may start in (outside or inside a string; an escape can't be open, as a brace has
just gone by) and keeps the state and the change of depth at its end: a row a range. Composed in order these give the state in which
each range starts. The second one cuts objects out, once whole ones and once the parts, one for each range, of those that go on over a border;
parts are joined by the range that the object began in, and only those are shuffled.

Objects within nested arrays count, numbers and other values between objects don't.
"""

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voicegrid.schemas import CORRUPT, with_corrupt

_MARK = re.compile(r'\\.?|["{]', re.DOTALL)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text between closing braces, with file and start of its range, in order within a range. The last one of a file has no brace."""
    return spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), "value")


def read_piece(text: str, quoted: bool) -> tuple[bool, list[int]]:
    """Whether a string is open at its end, and the places of the opening braces that aren't in strings."""
    opened = []
    for m in _MARK.finditer(text):
        if m[0] == '"':
            quoted = not quoted
        elif m[0] == "{" and not quoted:
            opened.append(m.start())
    return quoted, opened


def summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each range and each state at its start: the state at its end, the change of depth, and the least depth on the way."""
    at, now = None, []
    columns = ["file", "range", *(f"{x}_{y}" for y in ("out", "in") for x in ("end", "depth", "least"))]

    def row() -> pd.DataFrame:
        return pd.DataFrame([(*at, *(x for state in now for x in state))], columns=columns)

    for batch in batches:
        for file, begin, value in zip(batch["file"], batch["range"], batch["value"], strict=True):
            if (file, begin) != at:
                if at:
                    yield row()
                at, now = (file, begin), [(False, 0, 0), (True, 0, 0)]
            for i, (quoted, depth, least) in enumerate(now):
                quoted, opened = read_piece(value, quoted)
                depth += len(opened) - (not quoted)
                now[i] = quoted, depth, min(least, depth)
    if at:
        yield row()


def composed(ranges: pd.DataFrame) -> pd.DataFrame:
    """The state in which each range of a file starts: in a string or not, how many braces are open, and in which range the outermost of them is."""
    quoted, depth, began, out = False, 0, 0, []
    for r in ranges.sort_values("range").itertuples(index=False):
        out.append((r.file, r.range, quoted, depth, began))
        end, change, least = (r.end_in, r.depth_in, r.least_in) if quoted else (r.end_out, r.depth_out, r.least_out)
        if depth + least <= 0:
            # closing braces that belong to none don't count
            began, change = r.range, change - min(depth + least, 0)
        quoted, depth = end, max(depth + change, 0)
    return pd.DataFrame(out, columns=["file", "range", "quoted", "depth", "began"])


def cut_out(whole: bool):
    """Whole objects, or the parts of those that go on over a border of their range, with the range that they began in."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, quoted, depth, began, text = None, False, 0, 0, []
        columns = ["file", "range", "began", "text"]
        for batch in batches:
            out = []
            for file, begin, value, *start in zip(*(batch[c] for c in ("file", "range", "value", "quoted", "depth", "began")), strict=True):
                if (file, begin) != at:
                    if text and not whole:
                        out.append((*at, began, "".join(text)))
                    at, (quoted, depth, began), text, inside = (file, begin), start, [], bool(start[1])
                quoted, opened = read_piece(value, quoted)
                if not depth and opened:
                    began, inside, value = begin, False, value[opened[0] :]
                if depth or opened:
                    text.append(value + "}")
                depth += len(opened)
                if depth and not quoted:
                    depth -= 1
                    if not depth:
                        if inside != whole:
                            out.append((*at, began, "".join(text)))
                        text = []
            yield pd.DataFrame(out, columns=columns)
        if text and not whole:
            yield pd.DataFrame([(*at, began, "".join(text))], columns=columns)

    return run


def objects(spark: SparkSession, path: str) -> DataFrame:
    """file and text of each object. The end of a file closes one brace."""
    read = pieces(spark, path)
    names = ", ".join(f"end_{x} boolean, depth_{x} long, least_{x} long" for x in ("out", "in"))
    states = read.mapInPandas(summaries, f"file string, range long, {names}").groupBy("file").applyInPandas(composed, "file string, range long, quoted boolean, depth long, began long")
    # a row a range of the files; a join by broadcast leaves the pieces in their order
    known = read.join(F.broadcast(states), ["file", "range"]).select("file", "range", "value", "quoted", "depth", "began")
    whole, some = (known.mapInPandas(cut_out(x), "file string, range long, began long, text string") for x in (True, False))
    joined = some.groupBy("file", "began").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("range", "text"))), lambda x: x["text"]), "").alias("text"))
    return whole.select("file", "text").unionAll(joined.select("file", "text"))


def read_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows by a fixed schema, one for each object; those that don't parse have nulls and their text in `_corrupt`."""
    row = F.from_json("text", with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return objects(spark, path).select(row.alias("_row")).select("_row.*")


def write_arrays(df: DataFrame, path: str) -> None:
    """A JSON array a file, one for each partition that has rows."""

    def brackets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = "["
        for b in batches:
            if len(b):
                yield pd.DataFrame({"value": [(before if i == 0 else ",") + x for i, x in enumerate(b["value"])]})
                before = ","
        if before == ",":
            yield pd.DataFrame({"value": ["]"]})

    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).mapInPandas(brackets, "value string").write.mode("overwrite").text(path)
