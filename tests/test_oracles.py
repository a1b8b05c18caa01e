"""Every query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from lectern.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.8g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = sorted([plain(r[i]) for i in at] for r in found.fetchall())
    assert sorted([plain(r[c]) for c in columns] for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_others_run(spark, name):
    catalog.QUERIES[name](spark, SF).count()
