"""Every query of the loader that is registered, against its DuckDB statement."""

import datetime as dt
import decimal
from pathlib import Path

import duckdb
import pytest

from conftest import SMALL_SF
from tidemark.plans.oracles import ORACLES
from tidemark.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    for table in Path(SMALL_SF).glob("*.parquet"):
        made.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return made


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 6)
    return value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_statement(spark, con, name):
    df = QUERIES[name](spark, SMALL_SF)
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_by_name(df.columns, df.collect()) == rows_by_name(names, want.fetchall())
