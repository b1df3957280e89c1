"""A query's rows against its DuckDB SQL on the same tables."""

import duckdb

from scripts.check_oracle import TABLES, frame_hash
from tessera.llm.queries import ORACLE, QUERIES


def agrees(spark, name, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    ours, theirs = QUERIES[name](spark, sf_dir).toPandas(), con.sql(ORACLE[name]).df()
    assert len(ours) == len(theirs) and sorted(ours.columns) == sorted(theirs.columns)
    assert frame_hash(ours) == frame_hash(theirs)
