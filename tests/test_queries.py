from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@needs_data
@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query_agrees_with_its_sql(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, SF)
    cur = duck.execute(__spark_entry__.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(plain(v) for v in row) for row in cur.fetchall()), key=repr)
    got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
    assert got == want


@needs_data
def test_every_sql_has_a_query_and_the_entry_runs(spark):
    assert __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()
    assert __spark_entry__.entry(spark).count() > 0
