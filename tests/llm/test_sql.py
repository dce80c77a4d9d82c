"""Queries against their SQL, at a size where brute force is cheap."""

import pytest

from tests.compare import compare
from voicegrid.llm import registry


@pytest.mark.parametrize("name", registry.SQL)
def test_query_equals_sql(spark, name):
    assert compare(spark, name, "/root/testdata/sf0.001") == ""


def test_each_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, len(registry.QUERIES) + 1))
