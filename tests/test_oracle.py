"""Every registered query against its DuckDB twin on the smallest driver tables."""
import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tollgate.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


_DUCK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
         "DATE": "date", "TIMESTAMP": "timestamp_ntz"}


def _duck_type(t):
    t = str(t)
    return t.lower().replace(" ", "") if t.startswith("DECIMAL") else _DUCK.get(t, t)


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "reconciliation_status" in df.columns


@pytest.mark.parametrize("key", sorted(registry.ORACLE))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    cur = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    dtypes = {d[0]: _duck_type(d[1]) for d in cur.description}
    assert {c: t for c, t in df.dtypes} == dtypes
    assert _canon([tuple(r) for r in df.collect()], df.columns) == _canon(cur.fetchall(), dcols)


def test_every_query_has_an_oracle_but_file_listing():
    assert set(registry.QUERIES) - set(registry.ORACLE) == {"discover_assets"}
    assert set(registry.QUERIES) <= set(E.queries()) and set(registry.ORACLE) <= set(E.oracle_sql())
