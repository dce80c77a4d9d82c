import hashlib
import random
from collections import Counter

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from voicegrid.llm import alignment
from voicegrid.llm.chunks import letters

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
SF = "/root/testdata/sf0.001"
OWN = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
BYTE = letters()


def piece_bytes(i):
    p = B.id_to_piece(i)
    return bytes([int(p[1:-1], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode()


def plain(texts):
    """The same by walking over bytes."""
    rows, count = [], Counter()
    for t in texts:
        a, b = A.encode(" " + (t or ""), add_special_tokens=False).ids, B.encode(t or "")
        x, y = [bytes(BYTE[c] for c in A.id_to_token(i)) for i in a], [piece_bytes(i) for i in b]
        if not t or not b"".join(x) == b"".join(y) == (" " + t).encode():
            rows.append((0, 0, [], []))
            continue
        at_a, at_b = [k for k, p in enumerate(x) for _ in p], [k for k, p in enumerate(y) for _ in p]
        links = sorted(set(zip(at_a, at_b, strict=True)))
        ends = lambda at: {k for k in range(1, len(at) + 1) if k == len(at) or at[k] != at[k - 1]}
        groups, last = [], 0
        for e in sorted(ends(at_a) & ends(at_b)):
            groups.append(",".join(str(a[k]) for k in sorted(set(at_a[last:e]))) + "|" + ",".join(str(b[k]) for k in sorted(set(at_b[last:e]))))
            last = e
        pairs = [(a[i], b[j]) for i, j in links]
        count.update(pairs)
        rows.append((len(a), len(b), groups, pairs))
    best = {}
    for (_, j), n in count.items():
        best[j] = max(n, best.get(j, 0))
    return [(n, m, len(g), len(p), sum(count[x] == best[x[1]] for x in p), sum(count[x] for x in p), ";".join(g)) for n, m, g, p in rows]


ODD = [None, "", " ", "  a  b", "a", "a▁b", "가나다라마 🐾😾", "<|endoftext|> <s> </s>", "line\n\nfeeds\t\ttabs", "x" * 500, "<0x41>", "naïve é", "antidisestablishmentarianism!!??...", "the the the the", "the the the the", "  ", "0123456789 12,345.67"]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {d.doc_id: w for d, w in zip(docs, plain([d.text for d in docs]), strict=True)}
    got = {r.doc_id: r for r in alignment.op12(spark, SF).collect()}
    assert got.keys() == want.keys() and sum(w[5] for w in want.values()) > 0
    for i, w in want.items():
        assert tuple(got[i][c] for c in OWN[:6]) == w[:6] and got[i].groups_sha256 == (hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "")


def test_odd_rows_and_both_joins(spark):
    r = random.Random(5)
    texts = ODD + ["".join(r.choice("abAB eé가1 \n.,▂") for _ in range(r.randrange(60))) for _ in range(60)] + ["".join(r.choice(["in", "ter", "nation", " al", "iz", "ation", " "]) for _ in range(2000))]
    df = spark.createDataFrame([(i % 7 or None, t, str(i)) for i, t in enumerate(texts)], "doc_id long, text string, groups string").withColumn("links", F.lit("kept"))
    want = plain(texts)
    for small in (1_000_000, 0):
        got = {r.i: r for r in alignment.align(df.withColumn("i", F.col("groups").cast("int")), small=small).collect()}
        assert [tuple(got[i][c] for c in OWN) for i in range(len(texts))] == want and got[3].links == "kept"
    assert alignment.align(df.limit(0)).count() == 0


def test_a_long_text_is_no_square(spark):
    df = spark.createDataFrame([(1, "unbelievablyinternationalized " * 40_000)], "doc_id long, text string")
    row = alignment.align(df).first()
    assert row.n_links == row.n_a + row.n_b - row.n_groups and row.n_groups >= 40_000


def test_chunks_are_linked_once_and_side_by_side(monkeypatch):
    """Texts of known chunks cost no tokenising or linking, whichever chunks the cache has let go."""
    known = alignment.chunks_of((open(alignment.VOCABULARY, "rb").read(), open(alignment.MODEL, "rb").read()))
    monkeypatch.setattr(alignment, "CACHE", 40)
    r, width = random.Random(9), len(known.right.text)
    words = ["nation", "ality", "éa,", "x\ny", "\n\n", "\tq ", "", "가나", "12.5", "▁", "<s>", "\x85", "a" * 70, "the", "\n z"]
    texts = [t or "" for t in ODD] + [" ".join(r.choices(words, k=r.randrange(1, 12))) for _ in range(400)]
    made = []
    monkeypatch.setattr(known, "made", lambda c, make=known.made: made.extend(c) or make(c))
    for some in (texts[i : i + 20] for i in range(0, len(texts), 20)):
        for t, got in zip(some, known.encode(some), strict=True):
            n_a, _, n_groups, n_links, *_, groups = plain([t])[0]
            assert got is None and n_a == 0 or (got[0].decode(), got[2], len(got[1])) == (groups, n_a, 8 * n_links)
    known.encode(texts[:5])
    made.clear()
    known.encode(texts[:5])
    assert not made and known.encode(["nation " * 5])[0][1][:8] == (A.encode(" nation").ids[0] * width + B.encode("nation")[0]).to_bytes(8, "little")
