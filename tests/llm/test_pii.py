import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from voicegrid.llm import pii

SF = "/root/testdata/sf0.01"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    x = [int(c) for c in d[::-1]]
    return (sum(x[::2]) + sum(2 * c - 9 * (c > 4) for c in x[1::2])) % 10 == 0


def fine(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": all(int(x) <= 255 for x in m.split(".")) if kind == "ip" else False, "card": 13 <= len(d) <= 19 and luhn(d or "0"), "phone": 9 <= len(d) <= 15}[kind]


def brute_base(text):
    return [(k, m.start(), m.end(), m[0]) for k, p in BASE.items() for m in re.finditer(p, text or "") if fine(k, m[0])]


def brute(texts):
    """Spans of each text by the definition."""
    word = re.compile(r"[^\W\d_]{3,}")
    found = [brute_base(t) for t in texts]
    n, n_t, n_e, n_te, at = 0, Counter(), Counter(), Counter(), {}
    for text, base in zip(texts, found):
        start = 0
        for line in (text or "").split("\n"):
            terms = set(word.findall(line.lower()))
            if line.strip(" \t\n\r\v\f"):
                n += 1
                n_t.update(terms)
            inside = {f"{k}:{re.sub('[^0-9]', '', m) if k in ('card', 'phone') else m.lower()}" for k, s, _, m in base if start <= s <= start + len(line)}
            for e in inside:
                n_e[e] += 1
                for t in terms:
                    n_te[e, t] += 1
                    at.setdefault((e, t), set()).add(line)
            start += len(line) + 1
    bad = {}
    for (e, t), k in n_te.items():
        if len(at[e, t]) >= pii.SUPPORT and n > n_e[e] and round(math.log(k * n / (n_t[t] * n_e[e])) / math.log(n / n_e[e]), 6) >= pii.GENERALISE:
            bad.setdefault(e, set()).add(t)
    out = []
    for text, base in zip(texts, found):
        mine = set().union(*(bad.get(f"{k}:{re.sub('[^0-9]', '', m) if k in ('card', 'phone') else m.lower()}", set()) for k, _, _, m in base)) if base else set()
        extra = [("term", m.start(), m.end(), m[0]) for m in word.finditer(text or "") if m[0].lower() in mine and not any(b[1] < m.end() and m.start() < b[2] for b in base)]
        out.append(base + extra)
    return out


def check(spark, df):
    rows = df.collect()
    want = Counter((r.doc_id, ",".join(f"{k}:{s}:{e}" for k, s, e, _ in x)) for r, x in zip(rows, brute([r.text for r in rows])))
    return Counter((r.doc_id, r.spans) for r in got(spark, df)), want


def got(spark, df):
    found = pii.spans(df)
    base = F.concat(*[pii._joined(k, F.col(k)) for k in (*pii.KINDS, "term")])
    return found.select("doc_id", F.array_join(base, ",").alias("spans")).collect()


def test_documents_equal_brute_force(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    ours, want = check(spark, df)
    assert ours == want and sum(1 for _, s in want if s) >= 40
    one = pii.op10(spark, SF).collect()
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in one:
        base = brute_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e, _ in base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[0] == k for b in base) for k in pii.KINDS]


ODD = [
    None, "", " \n ", "a@b.c+x@d.e a@b..c @x.y a@b a@b.c@d.e x.@y-.z.", "1.2.3.4.5.6.7.8 999.1.1.1 0255.00.1.2 1.2.3 256.1.1.1 1.1.1.1a",
    "4111 1111 1111 1111 4111-1111-1111-1111x 4111  1111 1111 1111 12 4111111111111111", "+1 (555) 123-4567) +49.30.1234567-- +1+2 +123456789 +1 +12345678901234567 +44 20 7946 0958 1",
    "😀 é a@b.co 😀\n+1 555 123 4567 😀 1.2.3.4", "9" * 30_000, "a" * 50_000 + "@", "1 " * 20_000, "+" + "1-" * 20_000, "1." * 20_000, "4111111111111111",
]


def test_odd_texts(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)] + [(None, "x@y.z"), (7, ODD[7]), (7, ODD[7])], "doc_id long, text string").withColumns({"th": F.lit(0), "term": F.lit("x"), "email": F.lit(1)})
    ours, want = check(spark, df)
    assert ours == want
    assert pii.spans(df.filter("doc_id > 99")).count() == 0 and pii.sanitised(df).columns == df.columns


def test_terms_that_reveal_are_generalised_or_removed(spark):
    rows = [(i, f"Plain words number {'abcdefghij'[i % 10]} here and there\nnothing else") for i in range(200)]
    rows += [(1000 + i, f"Zorblatt of {x} writes from zed@corp.org about {x}\nand so on, plain words") for i, x in enumerate(("alpha", "beta", "gamma", "delta"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ours, want = check(spark, df)
    assert ours == want
    out = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert all(out[i] == t for i, t in rows[:200])
    assert all("zed@" not in out[1000 + i] and "Zorblatt" not in out[1000 + i] and "[EMAIL]" in out[1000 + i] and "plain words" in out[1000 + i] for i in range(4))


@pytest.mark.parametrize("number,ok", [("4111111111111111", True), ("4111111111111112", False), ("0", True)])
def test_luhn(spark, number, ok):
    assert spark.range(1).select(pii.luhn(F.lit(number)).alias("x")).first().x is ok
