"""Repair and parsing of JSON that a generator returned."""

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

#: What ends a stretch of plain characters inside a string, by its quote.
_STOP = {'"': re.compile(r'["\\\x00-\x1f]'), "'": re.compile(r"['\"\\\x00-\x1f]")}
_SPACE = re.compile(r"[\s﻿]+|//[^\n]*|/\*.*?\*/", re.DOTALL)
_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?")
_UNENDED = re.compile(r"[.eE+-]*\Z")
_WORD = re.compile(r"[^\W\d][\w$-]*")
_HEX = re.compile(r"[0-9a-fA-F]{4}")
_LITERALS = {"true": "true", "false": "false", "null": "null", "True": "true", "False": "false", "None": "null"}
_CLOSER = {"{": "}", "[": "]"}
_ESCAPES = {"\n": "\\n", "\r": "\\r", "\t": "\\t"}


class _Cut(Exception):
    """The text ends here."""


class _Hopeless(Exception):
    """No reading of the text as JSON."""


class _Machine:
    """A pushdown automaton over one text. `out` is valid JSON once what is on the stack is closed, but for what follows `safe`."""

    def __init__(self, text: str, at: int):
        self.text, self.at, self.out, self.stack, self.safe = text, at, [], [], 0

    def run(self) -> str:
        try:
            self.open(self.text[self.at])
            while self.stack:
                self.step()
        except _Cut:
            del self.out[self.safe :]
            self.out += [_CLOSER[x] for x in reversed(self.stack)]
        return "".join(self.out)

    def peek(self) -> str:
        while m := _SPACE.match(self.text, self.at):
            self.at = m.end()
        if self.at >= len(self.text):
            raise _Cut
        return self.text[self.at]

    def open(self, c: str) -> None:
        self.out.append(c)
        self.stack.append(c)
        self.at += 1
        self.done(False)

    def done(self, member: bool = True) -> None:
        """All written so far is whole; member: the next one needs a comma before it."""
        self.safe, self.comma = len(self.out), member

    def close(self, c: str) -> None:
        """Closes up to the bracket that c belongs to; a closing bracket that belongs to none is skipped."""
        self.at += 1
        if c in (_CLOSER[x] for x in self.stack):
            while True:
                last = _CLOSER[self.stack.pop()]
                self.out.append(last)
                if last == c:
                    break
            self.done()

    def step(self) -> None:
        """One member of the innermost bracket, or its end. Commas are written before a member alone, so that spare ones go and missing ones come."""
        c = self.peek()
        if c == ",":
            self.at += 1
        elif c in "}]":
            self.close(c)
        else:
            if self.comma:
                self.out.append(",")
            if self.stack[-1] == "{":
                self.key(c)
                c = self.peek()
            self.value(c)

    def key(self, c: str) -> None:
        if c in "\"'":
            self.string(c)
        elif m := _WORD.match(self.text, self.at):
            self.out.append(f'"{m[0]}"')
            self.at = m.end()
        else:
            raise _Hopeless
        if self.peek() != ":":
            raise _Hopeless
        self.out.append(":")
        self.at += 1

    def value(self, c: str) -> None:
        if c in "{[":
            self.open(c)
        elif c in "\"'":
            self.string(c)
            self.done()
        elif m := _NUMBER.match(self.text, self.at):
            if _UNENDED.match(self.text, m.end()):  # more digits may be missing
                raise _Cut
            self.out.append(m[0])
            self.at = m.end()
            self.done()
        elif m := _WORD.match(self.text, self.at):
            if m[0] not in _LITERALS:
                raise _Cut if m.end() == len(self.text) else _Hopeless
            self.out.append(_LITERALS[m[0]])
            self.at = m.end()
            self.done()
        elif c in "-+." and self.at + 1 >= len(self.text):
            raise _Cut
        else:
            raise _Hopeless

    def string(self, quote: str) -> None:
        parts, at, text = ['"'], self.at + 1, self.text
        while m := _STOP[quote].search(text, at):
            parts.append(text[at : m.start()])
            c, at = m[0], m.end()
            if c == quote:
                parts.append('"')
                self.out.append("".join(parts))
                self.at = at
                return
            if c == '"':
                parts.append('\\"')
            elif c != "\\":
                parts.append(_ESCAPES.get(c, f"\\u{ord(c):04x}"))
            elif at >= len(text):
                break
            elif text[at] in '"\\/bfnrt' or text[at] == "u" and _HEX.match(text, at + 1):
                parts.append("\\" + text[at])
                at += 1
            else:  # an escape that JSON doesn't have: the character itself
                at += text[at] == "'"
                parts.append("'" if text[at - 1] == "'" else "\\\\")
        raise _Cut


def _starts(text: str) -> Iterator[int]:
    """Places where the outermost value may begin: brackets in order, as prose in front may hold some, too."""
    at = min((i for i in (text.find("{"), text.find("[")) if i >= 0), default=-1)
    while at >= 0:
        yield at
        at = min((i for i in (text.find("{", at + 1), text.find("[", at + 1)) if i >= 0), default=-1)


def mended(text: str | None, tries: int = 8) -> str | None:
    """The first object or array of a text as valid JSON; None if there is none.

    Prose and code fences around it go. Strings in single quotes, bare keys, comments, line feeds in strings, Python's literals,
    spare and missing commas, and brackets closed in the wrong order are put right; what stands inside strings stays as it is. Where the
    text ends too soon, the member that was being written goes and the brackets are closed. Of the brackets that prose in
    front may hold, the first `tries` are tried. An array of anything but objects counts as prose if an object follows.
    """
    second = None
    for n, at in enumerate(_starts(text or "")):
        if n >= tries:
            break
        try:
            found = _Machine(text, at).run()
        except _Hopeless:
            continue
        if found[0] == "{" or found.startswith("[{"):
            return found
        second = second or found
    return second


def repair(x: Column) -> Column:
    """JSON text mended (see `mended`). Null stays null, as does text without any object or array. Null rows cost next to nothing in Python."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(mended, na_action="ignore").astype(object).where(lambda s: s.notna(), None)

    return run(x)


def parse(x: Column, schema: str, fix: bool = True) -> Column:
    """A struct by `schema`; valid text is parsed as it is in the JVM, only the rest is mended. An array gives its first object. Null if all fails."""
    fields = StructType.fromDDL(schema)
    whole = StructType([*fields, StructField("_bad", StringType())])
    options = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_bad"}

    def plain(row: Column) -> Column:
        return F.struct(*[row[f.name].alias(f.name) for f in fields])

    def good(text: Column) -> Column:
        out = F.from_json(text, whole, options)
        return F.when(out["_bad"].isNull() & out.isNotNull(), plain(out))

    if not fix:
        return good(x)
    rest = repair(F.when(good(x).isNull(), x))
    items = F.from_json(F.when(F.startswith(rest, F.lit("[")), rest), ArrayType(fields), {"mode": "PERMISSIVE"})
    return F.coalesce(good(x), good(F.when(F.startswith(rest, F.lit("{")), rest)), F.when(F.size(items) > 0, plain(F.get(items, F.lit(0)))))
