"""Byte-level BPE by the tokenizers library, each distinct chunk of a block of texts encoded once.

The vocabulary's pattern never matches a character that isn't white space together with white space after it, nor letters
together with an ASCII character after them that is none, so that a text falls into chunks whose encodings side by side are the text's
own: a space with letters up to such a character, or white space with all else up to the next. That holds where Python and
the library agree on white space: texts with any but spaces, tabs and line ends, and such as hold an added token's string, are
encoded whole.
"""

import os
import re
import struct
from itertools import chain

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share their executor's cores already

CHUNK = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+(?![^\s!-@\[-`{-~])|\s*\S+|\s+")
#: White space but for spaces, tabs and line ends.
RARE = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \t\r\n")
CACHE, LONG = 600_000, 64
LINE = re.compile(r" ?\S+")
SPACED = re.compile(r"(?<=\S) ")


def spaced(text: str) -> list[str]:
    """Parts of a text, cut at each space that follows anything but white space. The space itself goes."""
    if text.startswith(" ") or any(x in text for x in ("  ", "\t ", "\n ", "\r ")):
        return SPACED.split(text)
    return text.split(" ")


def letters() -> dict[str, int]:
    """The byte of each character that a byte-level vocabulary writes for it: printable ones of Latin-1 stand for themselves, others follow 255 in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(own))}


class ByteVocabulary:
    """A tokenizers file; `plain` makes strings of special tokens ordinary text."""

    def __init__(self, data: bytes, plain: bool):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_buffer(data)
        self.lib.encode_special_tokens = plain
        added = {i: t.content for i, t in self.lib.get_added_tokens_decoder().items()}
        self.odd = [*RARE, *added.values()]
        byte = letters()
        #: The bytes of each id.
        self.text = [b""] * self.lib.get_vocab_size(with_added_tokens=True)
        for piece, i in self.lib.get_vocab(with_added_tokens=True).items():
            self.text[i] = added[i].encode() if i in added else bytes(byte[c] for c in piece)
        self.sizes = np.array([len(x) for x in self.text], np.int64)
        feed = self.lib.encode("\n", add_special_tokens=False).ids
        #: The id of a line feed, -1 if it isn't one id.
        self.feed = feed[0] if len(feed) == 1 else -1
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, text: str) -> bool:
        """Whether the text mustn't be cut."""
        return any(x in text for x in self.odd)

    def packed(self, texts: list[str]) -> list[bytes]:
        """The library's encodings, as bytes of little-endian 32-bit integers."""
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def short(self, chunks: list[str]) -> list[bytes]:
        """The same for chunks, most of them as lines of one text, which the vocabulary's pattern cuts before and after each line feed."""
        lines = [c for c in chunks if LINE.fullmatch(c)]
        if self.whole("\n".join(lines)):
            lines = [c for c in lines if not self.whole(c)]
        (data,) = self.packed(["\n".join(lines)])
        feeds = 4 * np.flatnonzero(np.frombuffer(data, "<u4") == self.feed)
        if not lines or len(feeds) != len(lines) - 1:
            return self.packed(chunks)
        found = dict(zip(lines, (data[i:j] for i, j in zip([0, *(feeds + 4).tolist()], [*feeds.tolist(), len(data)], strict=True)), strict=True))
        others = [c for c in chunks if c not in found]
        found.update(zip(others, self.packed(others), strict=True))
        return [found[c] for c in chunks]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes of little-endian 32-bit integers. Chunks in use lately are kept, long ones aren't."""
        if len(self.known) > CACHE:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        split = [[t] if self.whole(t) else CHUNK.findall(t) for t in texts]
        new = [c for c in dict.fromkeys(chain.from_iterable(split)) if c not in known]
        known.update((c, older[c]) for c in new if c in older)
        new = [c for c in new if c not in known]
        known.update(zip(new, self.short(new), strict=True))
        out = [b"".join(map(known.__getitem__, s)) for s in split]
        for c in new:
            if len(c) > LONG:
                del known[c]
        return out


_known: dict[tuple[bytes, bool], ByteVocabulary] = {}


def byte_vocabulary(data: bytes, plain: bool) -> ByteVocabulary:
    if (data, plain) not in _known:
        _known.clear()
        _known[data, plain] = ByteVocabulary(data, plain)
    return _known[data, plain]
