"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01); queries without an oracle
must return rows under distinct column names."""

import os

import pytest

import __spark_entry__ as E
from check_oracles import digest, duck

from conftest import SF001

pytestmark = pytest.mark.skipif(not os.path.isdir(SF001), reason="test data not present")

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF001)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert rows and len(cols) == len(set(cols))
        return
    cur = con.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(cols, rows) == digest(dcols, drows)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "debut_tier" in df.columns
