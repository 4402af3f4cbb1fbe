"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from florametrics_queries import ORACLES, QUERIES
from tests.compare import connect, difference, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    got = spark_rows(QUERIES[name](spark, SF))
    if name in ORACLES:
        assert difference(got, duck_rows(con, ORACLES[name])) is None
    else:
        assert got[1]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["seq_id", "sseqid", "mappedReads", "cpm", "rpkm", "slen"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
