"""Steps over very many small groups: no Python call of its own for each of them."""

import time

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import window as W
from tessera.plans import custom as UX


def test_small_groups_share_a_call(spark):
    """Groups of at most a batch go many to a call, whole and in order; the large one streams."""
    small = spark.range(4000).select((F.col("id") % 900).alias("g"), (5000 - F.col("id")).alias("x"))
    hot = spark.range(2500).select(F.lit(-1).cast("long").alias("g"), F.col("id").alias("x"))
    none = spark.range(7).select(F.lit(None).cast("long").alias("g"), F.col("id").alias("x"))
    df = small.union(hot).union(none)

    def one(batches):
        n, first, key = 0, None, None
        for b in batches:
            assert len(b) <= 1000
            first = int(b["x"].iloc[0]) if first is None else first
            n, key = n + len(b), b["g"].iloc[0]
        yield pd.DataFrame({"g": [key], "n": [n], "first": [first], "how": ["stream"]})

    def many(t):
        g = t.group_by("g", use_threads=False).aggregate([([], "count_all"), ("x", "first"), ("x", "min")])
        assert g["x_first"].equals(g["x_min"])  # a group's rows come in order
        return pa.table({"n": g["count_all"], "g": g["g"], "first": g["x_first"], "how": pa.array(["many"] * len(g))})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        got = UX.grouped_stream(df, "g", one, "g long, n long, first long, how string", order_by=["x"], many=many).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = df.groupBy("g").agg(F.count("*").alias("n"), F.min("x").alias("first")).collect()
    assert sorted(((r["g"], r["n"], r["first"]) for r in got), key=str) == sorted(map(tuple, want), key=str)
    assert {r["g"] for r in got if r["how"] == "stream"} == {-1}
    with pytest.raises(ValueError):
        UX.grouped_stream(df, "g", one, "g long", salts=2, many=many)


@pytest.mark.parametrize("blocks", [1, 8])
def test_recurrences_of_many_small_groups(spark, blocks):
    """20,000 groups and a large one: no Python call for each (before, 20,000 groups in up to 8 blocks)."""
    small = spark.range(60000).select((F.col("id") % 20000).alias("g"), "id")
    hot = spark.range(60000, 80000).select(F.lit(None).cast("long").alias("g"), "id")
    df = small.union(hot).select("g", "id", F.lit(0.9).alias("a"), F.when(F.col("id") != 70000, F.col("id") % 13 - 6.0).alias("b"))
    rows = df.orderBy("id").collect()
    start = time.monotonic()
    linear = {r["id"]: r["x"] for r in W.linear_recurrence(df, "id", "a", "b", "x", "g", x0=2.0, blocks=blocks).collect()}
    clamped = {r["id"]: r["x"] for r in W.clamped_recurrence(df, "id", "a", "b", "x", 0.0, 9.0, "g", x0=2.0, blocks=blocks).collect()}
    assert time.monotonic() - start < 60
    assert len(linear) == len(clamped) == len(rows)
    x, y = {}, {}
    for g, i, a, b in rows:
        before = x.get(g, 2.0)
        x[g] = None if before is None or b is None else a * before + b
        y[g] = y.get(g, 2.0) if b is None else min(9.0, max(0.0, a * y.get(g, 2.0) + b))
        assert linear[i] is x[g] is None or abs(linear[i] - x[g]) < 1e-9, i
        assert abs(clamped[i] - y[g]) < 1e-9, i
