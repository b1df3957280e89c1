"""The driver contract, and every oracle query at sf0.001 against DuckDB."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
from check_oracle import TABLES, frame_hash  # noqa: E402


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["c_mktsegment", "order_month", "n_orders", "revenue", "n_priority", "revenue_running"]


def test_oracle_keys_subset_of_queries():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 150


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle_sf0001(spark, con, name):
    sp = entry.queries()[name](spark, SF_SMALL).toPandas()
    dk = con.sql(entry.oracle_sql()[name]).df()
    assert len(sp) == len(dk)
    assert sorted(sp.columns) == sorted(dk.columns)
    assert frame_hash(sp) == frame_hash(dk)
