"""Registered queries of the engine against the same in SQL, on the smallest tables."""

import datetime
import math

import duckdb
import pytest

from tablelift.plans import control, workload

SF = "/root/testdata/sf0.001"
ORACLE = workload.oracle_sql() | control.oracle_sql()
QUERIES = workload.queries() | control.queries()


@pytest.fixture(scope="module")
def tables():
    db = duckdb.connect()
    for t in [*workload.TABLES, "supplier", "part"]:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return db


def plain(x):
    if isinstance(x, float) and x == 0:
        return 0.0  # without its sign
    if isinstance(x, datetime.datetime) and x.time() == datetime.time():
        return x.date()
    return None if isinstance(x, float) and math.isnan(x) else x


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    got = QUERIES[name](spark, SF)
    found = tables.execute(ORACLE[name])
    names = [d[0] for d in found.description]
    assert sorted(got.columns) == sorted(names)
    rows = lambda data: sorted(repr(tuple(map(plain, r))) for r in data)
    assert rows(got.select(*sorted(names)).collect()) == rows([r[names.index(c)] for c in sorted(names)] for r in found.fetchall())
