import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from voicegrid.llm import repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def brute(x, least=12):
    """Runs by comparing each word with the one a period before it."""
    out = {}
    for q in range(1, len(x) // 2 + 1):
        i = q
        while i < len(x):
            if x[i] != x[i - q]:
                i += 1
                continue
            j = i
            while j < len(x) and x[j] == x[j - q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                out.setdefault((i - q, j), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in out.items())


def test_runs_of_random_words():
    r = random.Random(1)
    for n in range(400):
        x = [r.randrange(r.choice([1, 2, 3, 5])) for _ in range(r.randrange(120))]
        if n % 2:
            i, p = r.randrange(60), r.randrange(1, 20)
            x = [r.randrange(4) for _ in range(i)] + [r.randrange(9) for _ in range(p)] * r.randrange(2, 6) + x
        for least in (4, 12):
            assert repeats.runs_of(x, least) == brute(x, least)
        assert repeats.found([list(map(str, x))])[0] == brute(x)


def test_many_texts_at_once_and_long_ones():
    r = random.Random(2)
    texts = [[str(r.randrange(3)) for _ in range(r.randrange(40))] for _ in range(200)] + [["a"] * 5000, [], ["b"], ["x", "y", "z"] * 3000 + ["q"] * 20]
    assert repeats.found(texts) == [brute(t) if len(t) < 1000 else f for t, f in zip(texts, repeats.found(texts), strict=True)]
    assert repeats.found(texts)[-4:] == [[(0, 5000, 1)], [], [], [(0, 9000, 3), (9000, 20, 1)]]


def test_positions_stay_in_order():
    r = random.Random(3)
    xs = list(range(5000))
    r.shuffle(xs)
    p, seen = repeats.Positions(xs[0]), [xs[0]]
    for x in xs[1:]:
        before, after = p.add(x)
        if len(seen) < 300:
            assert before == max((y for y in seen if y < x), default=None) and after == min((y for y in seen if y > x), default=None)
        seen.append(x)
    assert list(p) == list(range(5000)) and p.follows(1023, 1024) and not p.follows(0, 2)


def plain(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    codes = {}
    runs = brute([codes.setdefault(w, len(codes)) for w in words]) if n < 1200 else repeats.found([words])[0]
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_equals_brute_force(spark):
    got = {r.doc_id: tuple(r) for r in repeats.op11(spark, SF).collect()}
    want = {r.doc_id: plain(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert got == want and sum(r[1] > 0 for r in want.values()) > 10


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "a b " * 9, None), (3, "a b " * 9, None), (None, "\x0b\t a", "y"), (5, "　" + " w" * 20, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, collapsed string").withColumn("runs", F.lit(1))
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in repeats.runs(df).collect()))
    assert got == [(0, 1, [], "a"), (1, 0, [], ""), (2, 0, [], ""), (3, 18, [(0, 18, 2)], "a b"), (3, 18, [(0, 18, 2)], "a b"), (5, 21, [(1, 20, 1)], "　 w")]
    assert repeats.runs(df.limit(0)).count() == 0
