"""Queries with SQL agree with DuckDB; every query runs and has its contract's columns."""

import math

import duckdb
import pytest

from llm_cases import SMALL
from kestrel.llm import catalog
from kestrel.tables import TABLES

catalog.load_all()

COLUMNS = {
    "op1": "query_id rank doc_id score", "op2": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op3": "doc_id keep_id group_size kept text_sha256", "op4": "doc_id ids n_tokens exact",
    "op5": "page_id text", "op6": "doc_id size text_crc32 law shard slot grown_shard",
    "op7": "doc_id size source_size target taken", "op8": "doc_id held_out score predicted",
    "op9": "doc_id class_id class_size kept", "op10": "page_id warc_file offset digest root status",
    "op11": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op12": "query_id rank vec_id score", "op13": "item_id rank doc_id score"}


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.6g}")
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def test_one_query_per_operator():
    assert sorted(k.split("_")[0] for k in catalog.QUERIES) == sorted(COLUMNS)


@pytest.mark.parametrize("key", sorted(catalog.QUERIES))
def test_query(spark, key):
    df = catalog.QUERIES[key](spark, SMALL)
    assert set(COLUMNS[key.split("_")[0]].split()) <= set(df.columns)
    got = df.collect()
    if key not in catalog.ORACLE_SQL:
        table = "pages" if key.startswith("op5") else "documents"
        rows = duckdb.connect().execute(f"SELECT count(*) FROM '{SMALL}/{table}.parquet'").fetchall()[0][0]
        assert len(got) == rows
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    res = con.execute(catalog.ORACLE_SQL[key])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in got]) == rows_of(names, res.fetchall())
