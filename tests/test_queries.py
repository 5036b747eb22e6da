"""Every registered query against its SQL, on the given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from checks.fixtures import TABLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def comparable(row):
    return tuple((value is None, repr(float(value)) if isinstance(value, (int, float)) else str(value))
                 for value in row)


@pytest.mark.filterwarnings("ignore:unknown policy")
@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    frame = driver.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    got = [comparable(r) for r in frame.select(*[f"`{c}`" for c in columns]).collect()]
    result = duck.execute(driver.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = [comparable([r[i] for i in order]) for r in result.fetchall()]
    assert sorted(got) == sorted(expected)


def test_every_query_is_checked():
    assert set(driver.registry.queries()) == set(driver.oracle.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    frame = driver.entry(spark)
    assert frame.count() == 200 and frame.columns[0] == "is_document"
