"""Every catalogued query against its DuckDB oracle at sf0.01 (row count,
column names, order-insensitive value hash) - the driver's gate, locally."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import digest, duck

SF = "/root/testdata/sf0.01"
NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]


def test_every_query_without_an_oracle_has_rows(spark):
    for name, fn in E.queries().items():
        if name not in E.oracle_sql():
            assert fn(spark, SF).count() > 0, name


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "latest_value" in df.columns
