"""Every query against its SQL."""

import pytest

from checks import oracle, registry
from checks.compare import difference

QUERIES = registry.queries()
EXPECTED = oracle.oracle_sql()


def test_every_query_has_expected_results():
    assert sorted(QUERIES) == sorted(EXPECTED)


@pytest.mark.parametrize("name", QUERIES)
def test_query(name, spark, sf_dir, duck):
    assert difference(QUERIES[name](spark, sf_dir), duck, EXPECTED[name]) is None


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns[0] == "fiscal_year"
    assert df.count() > 0
