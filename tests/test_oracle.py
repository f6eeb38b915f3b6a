"""Every query with SQL agrees with DuckDB on the same tables; every other query runs."""

import math

import duckdb
import pytest

from conftest import SMALL
from kestrel.plans import catalog
from kestrel.tables import TABLES

catalog.load_all()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.6g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("key", sorted(catalog.QUERIES))
def test_query(spark, con, key):
    df = catalog.QUERIES[key](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    if key not in catalog.ORACLE_SQL:
        assert len(df.columns) > 0
        return
    res = con.execute(catalog.ORACLE_SQL[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, got) == _rows(ocols, res.fetchall())
