import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from voicegrid.llm import chunks, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
SF = "/root/testdata/sf0.001"
ODD = ["", " ", "a", "  a  b ", "x\x1c!\x1d\x0b y", "a  b   c", "x   y", "<|endoftext|> a <|endoftext|>", "it's  they'LL\r\n\r\n x", "가나다 라😀‍🔥 é́", "\n\n a\t\tb \n", "a" * 3000, "!? ...\x1f.. \x85 z", " . . .  .", "end  "]


@pytest.mark.parametrize("plain", [False, True])
def test_chunks_encode_as_the_library(plain):
    lib = Tokenizer.from_file(PATH)
    lib.encode_special_tokens = plain
    known = chunks.ByteVocabulary(open(PATH, "rb").read(), plain)

    @settings(max_examples=300, deadline=None)
    @given(st.text(st.sampled_from(" \t\n\r\x0b\x1c  ab'sé가1!?."), max_size=30))
    def check(t):
        assert np.frombuffer(known.encode([t])[0], "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids

    check()
    for t in ODD:
        ids = np.frombuffer(known.encode([t])[0], "<u4").tolist()
        assert ids == lib.encode(t, add_special_tokens=False).ids and b"".join(known.text[i] for i in ids) == t.encode()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), min_size=1, max_size=300), st.sampled_from([0, 50, 97, 100]))
def test_blocks_round_trip(ids, percentile):
    assert token_files.unpack(token_files.pack(np.array(ids, np.uint32), percentile)).tolist() == ids


def test_block_has_few_bits_and_exceptions():
    ids = np.array([1000 + i % 8 for i in range(4000)] + [70_000] * 40, np.uint32)
    data = token_files.pack(ids)
    low, width, exceptions, n = token_files.HEAD.unpack_from(data)
    assert (low, width, exceptions, n) == (1000, 3, 40, 4040) and len(data) < 4040 * 3 / 8 + 40 * 6 + 20


def test_any_ids_of_a_file(tmp_path):
    ids = np.random.default_rng(1).integers(0, 50_000, 3 * token_files.BLOCK + 77).astype(np.uint32)
    store = fs.LocalFileSystem()
    w = token_files.Writer(store.open_output_stream(str(tmp_path / "x")))
    for part in np.array_split(ids, 7):
        w.add(part)
    w.close()
    r = token_files.Reader(store.open_input_file(str(tmp_path / "x")))
    assert r.n == len(ids) and len(r.starts) == 5
    for first, n in ((0, 1), (4095, 2), (5000, 6000), (len(ids) - 1, 1), (0, len(ids))):
        assert r.ids(first, n).tolist() == ids[first : first + n].tolist()


def plain(rows):
    out, start = [], 0
    for i, t in rows:
        ids = np.array([*LIB.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_equals_brute_force(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert sorted(map(tuple, token_files.op13(spark, SF).collect())) == plain(rows)


def test_odd_rows(spark, tmp_path):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(100, None, None), (100, "b", None), (100, "b", None), (None, "c c", "y"), (-5, "first", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string")
    at = f"file://{tmp_path}/x"
    token_files.write(df, at)
    got = sorted(((r.start, r.doc_id, r.n_tokens, bytes(r.ids)) for r in token_files.read(spark, at).collect()))
    assert [x[1] for x in got] == [-5, *range(len(ODD)), 100, 100, 100, None]
    end = 0
    for start, i, n, ids in got:
        assert start == end and len(ids) == 4 * n and ids[-4:] == b"\0\0\0\0"
        end += n
        if i in range(len(ODD)):
            assert np.frombuffer(ids, "<u4").tolist() == [*LIB.encode(ODD[i], add_special_tokens=False).ids, 0]
    some = token_files.index(spark, at).filter("doc_id = 3")
    assert [r.doc_id for r in token_files.read(spark, at, some).collect()] == [3]
    token_files.write(df.limit(0), f"{at}0")
    assert token_files.read(spark, f"{at}0").count() == 0


def test_a_third_of_rows_with_one_id(spark, tmp_path):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("a b").alias("text"))
    at = f"file://{tmp_path}/x"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write(df, at)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = token_files.read(spark, at)
    assert got.agg(F.sum("n_tokens")).first()[0] == 27_000 and got.select("start").distinct().count() == 9000
    parts = spark.read.parquet(f"{at}/index").groupBy("part").count().collect()
    assert len(parts) > 1 and max(p["count"] for p in parts) < 4500


def test_new_chunks_of_a_block_are_few_texts(monkeypatch):
    """New chunks go to the library as lines of one text, but for those that aren't one line or hold an added token."""
    known, sent = chunks.ByteVocabulary(open(PATH, "rb").read(), False), []
    monkeypatch.setattr(known, "packed", lambda texts, packed=known.packed: sent.extend(texts) or packed(texts))
    texts = [f" w{i}, 'll x{i}y\n" for i in range(500)] + ODD + ["<|endoftext|>", "\n"]
    for some in (texts, texts[::-1], [], [""]):
        assert [np.frombuffer(x, "<u4").tolist() for x in known.encode(some)] == [LIB.encode(t, add_special_tokens=False).ids for t in some]
    assert len(sent) < 50
