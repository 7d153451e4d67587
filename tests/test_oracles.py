"""Every library query against its SQL on the smallest tables."""

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from priorwise.plans.catalog import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return repr(float(v))
    if isinstance(v, (int, float, Decimal)):
        return repr(float(f"{float(v):.9g}") + 0.0)
    return str(v)


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    got = rows(df.columns, df.collect())
    cur = duck.execute(ORACLES[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows(columns, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, DATA).limit(1).count() == 1
