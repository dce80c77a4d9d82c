"""The whole classifier query against dictionaries and loops."""

import hashlib
import math
import re
import zlib
from collections import Counter

from voicegrid.llm import quality_classifier as q

SF = "/root/testdata/sf0.001"
BINS = 1 << 18


def features(text):
    tokens = re.findall(r"\w+|[^\w\s]+", text or "")
    h = [zlib.crc32(t.encode()) for t in tokens]
    n = Counter(2 + x % (BINS - 2) for x in h)
    n.update(1 if x == y else 2 + (x * 65_599 + y) % (BINS - 2) for x, y in zip(h, h[1:]))
    w = {b: 1 + math.log(c) for b, c in n.items()}
    norm = max(math.sqrt(sum(v * v for v in w.values())), 1)
    return {0: 1.0} | {b: v / norm for b, v in w.items()}


def weight(z, n):
    return 0.0 if abs(z) <= q.L1 else -(z - math.copysign(q.L1, z)) / ((q.BETA + math.sqrt(n)) / q.ALPHA + q.L2)


def score(x, z, n):
    return 1 / (1 + math.exp(-sum(v * weight(z.get(b, 0), n.get(b, 0)) for b, v in x.items())))


def test_query_equals_plain_ftrl(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality in (0, 1)}
    train = sorted((int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16), str(i), y, features(texts[i])) for i, y in labels.items() if zlib.crc32(str(i).encode()) % 5 and i in texts)
    z, n = {}, {}
    for _ in range(q.EPOCHS):
        for _, _, y, x in train:
            p = score(x, z, n)
            for b, v in x.items():
                g, old = (p - y) * v, n.get(b, 0.0)
                more = old + g * g
                z[b], n[b] = z.get(b, 0.0) + g - (math.sqrt(more) - math.sqrt(old)) / q.ALPHA * weight(z.get(b, 0.0), old), more
    got = {r.doc_id: r for r in q.op4(spark, SF).collect()}
    assert got.keys() == texts.keys() and len(train) > 50
    for i, t in texts.items():
        assert abs(got[i].score - score(features(t), z, n)) < 1e-4
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and got[i].predicted == (got[i].score >= 0.3)
