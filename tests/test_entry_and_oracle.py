"""The driver contract, and every named query against its DuckDB oracle (sf0.001)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from cartwheel.plans.queries import QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest


def test_entry_runs_and_has_the_funnel_schema(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["total_events", "total_sessions", "total_products"]
    assert df.count() == 1


def test_every_query_has_an_oracle():
    # the hash-sampled replay included: its oracle spells out XXH64 in SQL
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(QUERIES) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    hs, ls = digest(s_cols, s_rows)
    hd, ld = digest(d_cols, d_rows)
    assert hs == hd, (sorted(set(ls) - set(ld))[:3], sorted(set(ld) - set(ls))[:3])
