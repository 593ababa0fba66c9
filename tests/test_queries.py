"""Every registered query beside its SQL."""

import os

import compare
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ALL = entry.queries()
SQL = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ALL))
def test_query(spark, con, name):
    df = ALL[name](spark, SF_DIR)
    if name in SQL:
        assert compare.difference(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["yr", "c_mktsegment", "n", "priorities"]
