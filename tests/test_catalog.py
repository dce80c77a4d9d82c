import pytest

from tests.compare import compare
from voicegrid.plans import catalog


def test_each_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query_equals_sql(spark, name):
    assert compare(spark, name, "/root/testdata/sf0.001") == ""
