import base64
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from voicegrid.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"first": F.lit("x"), "payload": F.lit(1), "digest": F.lit(2)})


ROWS = [(5, "http://a/\r\nX: y", "same"), (3, "b", "same"), (9, None, "same"), (1, "é", None), (2, "", ""), (7, "u", "\r\n\r\nWARC/1.1\r\n"), (8, "u", "é" * 400_000), (4, "u", "tail"), (4, "u", "tail"), (6, "u", "tail"), (None, "u", "same"), (None, "u", "alone")]


def test_archive_round_trip(spark, tmp_path):
    at = f"file://{tmp_path}/a"
    warc.write(pages(spark, ROWS), at)
    got = warc.read(spark, at).collect()
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    ids = {}
    for i, _, t in ROWS:
        if i is not None:
            ids[t or ""] = min(i, ids.get(t or "", i))
    want = []
    for i, _, t in ROWS:
        first = ids.get(t or "")
        kind = "revisit" if first is not None and first != i else "response"
        want.append((str(i), len((t or "").encode()), digest(t), kind, first if kind == "revisit" else None))
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == sorted(want, key=lambda x: x)
    assert {r.page_id: r.payload.decode() for r in got if r.record_type == "response" and r.page_id} == {1: "", 3: "same", 7: ROWS[5][2], 8: ROWS[6][2], 4: "tail"}
    some = warc.read(spark, at, warc.index(spark, at).filter("page_id = 7")).collect()
    assert [(r.page_id, r.payload.decode()) for r in some] == [(7, ROWS[5][2])]


def test_least_and_empty(spark, tmp_path):
    warc.write(pages(spark, ROWS), f"file://{tmp_path}/b", least=10_000)
    assert {r.record_type for r in warc.read(spark, f"file://{tmp_path}/b").collect()} == {"response"}
    warc.write(pages(spark, ROWS).filter("page_id > 99"), f"file://{tmp_path}/c")
    assert warc.read(spark, f"file://{tmp_path}/c").count() == 0


class Sink(io.BytesIO):
    def close(self):
        pass


@pytest.mark.parametrize("frame", [1, 500, 1 << 20])
def test_frames_are_independent(frame):
    rng, sink = random.Random(frame), Sink()
    w = warc.BundleWriter(sink, frame=frame)
    made = [warc.record(i, "u", rng.randbytes(rng.choice([0, 10, 3000])), "D", None) for i in range(50)]
    at = [w.add(m) for m in made]
    w.close()
    r = warc.BundleReader(io.BytesIO(sink.getvalue()))
    for (f, o), m in rng.sample(list(zip(at, made)), 50):
        assert r.frame(f)[o : o + len(m)] == m
    import zstandard

    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(sink.getvalue()), read_across_frames=True).read()
    assert whole.endswith(made[-1]) and sum(n for _, n in r.sizes) == len(whole)
