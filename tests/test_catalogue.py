"""Every core query against DuckDB on the smallest tables."""

import datetime
import os

import duckdb
import pytest

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(v):
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, (list, tuple)):
        return repr([plain(x) for x in v])
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    try:
        return f"{float(v):.5f}" if not isinstance(v, str) else v
    except (TypeError, ValueError):
        return str(v)


def agree(spark, query, sql):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    df = query(spark, DATA)
    cols = sorted(df.columns)
    got = sorted([plain(r[c]) for c in cols] for r in df.collect())
    rel = con.sql(sql)
    at = [rel.columns.index(c) for c in cols]
    assert len(rel.columns) == len(cols)
    assert got == sorted([plain(r[i]) for i in at] for r in rel.fetchall())


def names():
    from curatrix.plans import catalogue

    return sorted(catalogue.ORACLES)


@pytest.mark.parametrize("name", names())
def test_query(spark, name):
    from curatrix.plans import catalogue

    agree(spark, catalogue.QUERIES[name], catalogue.ORACLES[name])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["reason", "n"] and e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_rest_stands_without_llm():
    import re

    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "curatrix")
    for folder, _, files in os.walk(root):
        if os.path.basename(folder) == "llm":
            continue
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(folder, f), encoding="utf-8") as h:
                    assert not re.search(r"(?m)^\s*(?:from|import) curatrix\.llm", h.read()), f
