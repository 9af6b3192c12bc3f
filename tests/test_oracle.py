"""Every registered query against its SQL twin in DuckDB."""

import datetime
import decimal
from pathlib import Path

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry_module
from tidemark.plans import catalog, oracles

QUERIES = catalog.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, decimal.Decimal):
        return f"{value:.6f}"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()]
    assert ordered(got) == ordered(expected)


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    rows = df.collect()
    assert rows and [r.timepoint for r in rows] == sorted(r.timepoint for r in rows)
