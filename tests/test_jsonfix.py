import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voicegrid.functions import jsonfix

CASES = [
    ('{"a": 1}', {"a": 1}),
    ('```json\n{"a": "x, }"}\n```', {"a": "x, }"}),
    ('{"a": 1, "b": [1, 2,], }', {"a": 1, "b": [1, 2]}),
    ("{'a': 'it\\'s \"b\"', 'c': True, d: None}", {"a": 'it\'s "b"', "c": True, "d": None}),
    ('{"a": "x", "b": "half', {"a": "x"}),
    ('{"a": "x", "b": ', {"a": "x"}),
    ('{"a": "x", "b', {"a": "x"}),
    ('{"a": "x", "b": 12', {"a": "x"}),
    ('{"a": "x", "b": tru', {"a": "x"}),
    ('{"a": "x", "b": {"c": [1, 2', {"a": "x", "b": {"c": [1]}}),
    ('{"a": "x\\', {}),
    ('{"a": "x\\u00', {}),
    ('[{"a": 1}, {"b": 2', [{"a": 1}, {}]),
    ('{"x": {"a": [1, 2}, "b": 3}', {"x": {"a": [1, 2]}, "b": 3}),
    ('{"a": 1 "b": 2}', {"a": 1, "b": 2}),
    ('{"a": "line\nfeed\tand \\q"}', {"a": "line\nfeed\tand \\q"}),
    ('Sure [as asked]: {"a": 1} and {"b": 2}', {"a": 1}),
    ('{"a": 1, // so\n "b": /* and */ 2}', {"a": 1, "b": 2}),
    ("{", {}),
]


@pytest.mark.parametrize("text,want", CASES)
def test_mended(text, want):
    assert json.loads(jsonfix.mended(text)) == want


@pytest.mark.parametrize("text", [None, "", "prose only", "so [sic] it {is}", "}]"])
def test_nothing_to_mend(text):
    assert jsonfix.mended(text) in (None,) or json.loads(jsonfix.mended(text)) is not None


VALUES = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=8), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=4), x, max_size=3), max_leaves=12)


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.text(max_size=4), VALUES, max_size=4), st.booleans(), st.data())
def test_valid_json_stays_and_prefixes_lose_only_their_end(value, ascii_only, data):
    text = json.dumps(value, ensure_ascii=ascii_only)
    assert json.loads(jsonfix.mended(text)) == value
    cut = data.draw(st.integers(1, len(text)))
    part = json.loads(jsonfix.mended(text[:cut]))

    def inside(a, b, last=True):
        """Whether a is b but for what is missing at its end."""
        if type(a) is not type(b):
            return False
        if isinstance(a, dict):
            keys = list(a)
            return keys == list(b)[: len(keys)] and all(inside(a[k], b[k]) for k in keys)
        if isinstance(a, list):
            return len(a) <= len(b) and all(inside(x, y) for x, y in zip(a, b, strict=False))
        return a == b

    assert inside(part, value)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("{}[]\"':,\\ \nab1-tn"), max_size=40))
def test_any_text_ends_in_json_or_nothing(text):
    found = jsonfix.mended(text)
    assert found is None or json.loads(found) is not None


def test_parse_and_quarantine(spark):
    rows = [(i, t) for i, (t, _) in enumerate(CASES)] + [(100, None), (101, ""), (102, "prose only"), (103, '[{"a": "first"}, {"a": "second"}]'), (104, '{"a": "x", "more": [1]}'), (105, "[1, 2]")]
    got = {r.i: r.p for r in spark.createDataFrame(rows, "i int, t string").select("i", jsonfix.parse(F.col("t"), "a string").alias("p")).collect()}
    assert got[4].a == "x" and got[3].a == 'it\'s "b"' and got[103].a == "first" and got[104].a == "x"
    assert got[100] is None and got[101] is None and got[102] is None


def test_good_rows_stay_in_the_jvm(spark):
    df = spark.createDataFrame([(1, '{"a": "x, }"}')], "i int, t string")
    assert df.select(jsonfix.parse(F.col("t"), "a string", fix=False)["a"].alias("a")).first().a == "x, }"
