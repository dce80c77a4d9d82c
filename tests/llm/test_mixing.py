from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voicegrid.llm import mixing


def plain_targets(sizes):
    """Targets by sharing again and again what is above the limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, open_, out = mixing.SHARE * sum(sizes.values()), set(names), {}
    while open_:
        w = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / w > 2 * sizes[s] - 1e-9}
        if not full:
            return out | {s: left * weight[s] / w for s in open_}
        out |= {s: float(2 * sizes[s]) for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return out


def test_targets_equal_repeated_sharing(spark):
    @settings(max_examples=12, deadline=None)
    @given(st.dictionaries(st.one_of(st.none(), st.text("abé", min_size=1, max_size=3)), st.integers(0, 10_000), min_size=1, max_size=8))
    def check(sizes):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        want = plain_targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)

    check()


def test_inverse_demand(spark):
    for s in mixing.SCHEDULES:
        total = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(s, s[1:]))
        times = [i / 50 for i in range(51)]

        def area(t):
            return sum((min(t, b[0]) - a[0]) * (2 * a[1] + (b[1] - a[1]) * (min(t, b[0]) - a[0]) / (b[0] - a[0])) / 2 for a, b in zip(s, s[1:]) if t > a[0]) / total

        df = spark.createDataFrame([(t, area(t)) for t in times], "t double, x double")
        assert all(abs(r.t - r.y) < 1e-9 for r in df.withColumn("y", F.expr(mixing.inverse_demand("x", s))).collect())


def rows(spark, n=300):
    data = [(i, " ".join("w" * (1 + i * 7 % 40)), f"s{i % 5 if i % 3 else 0}" if i % 11 else None) for i in range(n)]
    return spark.createDataFrame(data + [(None, None, "s1"), (None, "", None), (5, "a b", "s1"), (5, "a b", "s1")], "doc_id long, text string, source string")


def test_taken_meets_targets(spark):
    out = mixing.mix(rows(spark)).collect()
    assert len(out) == 304
    total, goal = Counter(), {}
    for r in out:
        total[r.source] += r.taken
        goal[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size and (r.position is None) == (r.taken == 0)
    assert all(abs(total[s] - goal[s]) <= 1 for s in goal)
    assert [r.position for r in out if r.position is not None] == sorted(r.position for r in out if r.position is not None)
    again = mixing.mix(rows(spark).repartition(7)).collect()
    assert Counter(again) == Counter(out)


def test_mixed_rows_are_whole(spark):
    df = rows(spark).withColumns({"position": F.lit("x"), "taken": F.lit(1), "h": F.lit(2)})
    out = mixing.mixed(df)
    assert out.columns == df.columns
    seen = Counter(tuple(r) for r in out.collect())
    known = {tuple(r) for r in df.collect()}
    assert set(seen) <= known and max(seen[r] for r in seen if r[0] not in (5, None)) == 2
    assert mixing.mixed(df.filter("doc_id > 9999")).count() == 0 and mixing.mix(df.filter("doc_id > 9999")).count() == 0
