import pytest

import __spark_entry__ as entry
from quire.plans import catalogue
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    df = catalogue.QUERIES[name](spark, SF)
    if name in catalogue.ORACLE_SQL:
        assert difference(df, con, catalogue.ORACLE_SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 20 and [r["rank"] for r in rows] == list(range(1, len(rows) + 1))


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
