import numpy as np
import pytest
from pyspark.sql import functions as F

from voicegrid.llm import neighbours as nn


def brute(rows, k=5):
    """(query, rank, id, score) by double precision over all pairs."""
    good = {i: v for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for q, a in good.items():
        if q % 50:
            continue
        found = []
        for i, b in good.items():
            if i != q and len(a) == len(b):
                dot = aa = bb = 0.0
                for x, y in zip(a, b):
                    dot, aa, bb = dot + x * y, aa + x * x, bb + y * y
                found.append((-max(-1.0, min(1.0, dot / (aa * bb) ** 0.5)), i))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def near(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"rank": F.lit("x"), "c": F.lit(1), "dim": F.lit(2)})
    return sorted(map(tuple, nn.nearest(df, F.col("vec_id") % 50 == 0).collect()))


def f32(x):
    return [float(v) for v in np.asarray(x, np.float32)]


@pytest.mark.parametrize("blocks", [(8192, 4096), (64, 2)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(nn, "CANDIDATES", blocks[0])
    monkeypatch.setattr(nn, "QUERIES", blocks[1])
    rng = np.random.default_rng(1)
    rows = [(i, f32(rng.normal(size=8))) for i in range(400)]
    rows += [(1000 + i, rows[50][1]) for i in range(40)] + [(2000 + i, f32(np.array(rows[100][1]) * (1 + i))) for i in range(20)]
    rows += [(3000, f32([1e30] * 8)), (3050, f32([1e-30] * 8)), (3001, f32(rng.normal(size=3))), (3100, f32(rng.normal(size=3))), (3150, f32([1, 2]))]
    assert near(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, None), (100, []), (150, [0.0, 0.0]), (200, [nan, 1.0]), (250, [inf, 1.0]), (300, [None, 1.0]), (None, [1.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [2.0, 2.0]), (3, [-1.0, 0.0])]
    assert near(spark, rows) == brute([r for i, r in enumerate(rows) if i != 9])
    assert near(spark, []) == [] and near(spark, [(0, [1.0])]) == []


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 64)) * rng.choice([1e-3, 1, 1e3], (200, 1))
    q, s, e = nn._rounded(x)
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    assert np.abs(q).max() <= 127
    assert (np.abs(unit @ unit.T - (q @ q.T) * s[:, None] * s) <= e[:, None] + (1 + e[:, None]) * e + 1e-5).all()
