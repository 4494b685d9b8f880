"""Every registered query against its DuckDB oracle (rows, columns, values)."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from candlewick.plans import registry

SF = os.environ.get("CANDLEWICK_TEST_SF", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


TYPES = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "array<double>": "DOUBLE[]", "array<string>": "VARCHAR[]"}


@pytest.mark.parametrize("key", sorted(registry.ORACLE))
def test_matches_oracle(spark, con, key):
    df = registry.QUERIES[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(registry.ORACLE[key])
    assert {f.name: TYPES.get(f.dataType.simpleString()) for f in df.schema} == \
        {n: str(t) for n, t in zip(rel.columns, rel.types)}
    res = con.execute(registry.ORACLE[key])
    ocols = [c[0] for c in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert canon(rows, df.columns) == canon(orows, ocols)


def test_every_query_has_an_oracle(spark):
    assert set(registry.ORACLE) == set(registry.QUERIES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "industry" in df.columns
