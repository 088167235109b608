"""Every query gives what its SQL gives on the same tables."""

import datetime
import decimal
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from demo_oracles import ORACLES
from demo_queries import QUERIES

duckdb = pytest.importorskip("duckdb")
DATA = Path("/root/testdata/sf0.001")
NEVER = ("Python", "CartesianProduct", "NestedLoopJoin", "ExistingRDD")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.sql(f"create view {file.stem} as select * from '{file}'")
    yield connection
    connection.close()


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (decimal.Decimal, datetime.datetime)):
        return str(value)
    return tuple(_plain(v) for v in value) if isinstance(value, list) else value


def _sorted(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in records]
    return sorted(columns), sorted(plain, key=repr)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name, plan):
    df = QUERIES[name](spark, str(DATA))
    assert not [word for word in NEVER if word in plan(df)]
    expected = sql.sql(ORACLES[name])
    assert _sorted(df.columns, df.collect()) == _sorted(expected.columns, expected.fetchall())


def test_entry(spark):
    report = entry_points.entry(spark)
    assert {r.is_success for r in report.collect()} == {"Y"}
