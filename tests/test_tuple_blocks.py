"""Blocks cut by whole order tuples, and the recurrence with bounds."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import window as W


def frame(spark, n=4000):
    r = random.Random(4)
    rows = [(r.choice(["a", "b"]), "same", r.choice([None, 1, 2]), i * 3 % n, r.choice([None, r.random()]), i % 4 == 0) for i in range(n)]
    return spark.createDataFrame(rows, "g string, day string, part int, id long, x double, flag boolean").repartition(5)


AGGS = {"s": ("sum", "x"), "n": ("count", "x"), "rn": ("row_number", None), "r": ("rank", None), "d": ("dense_rank", None), "l": ("last", "x"), "hi": ("max", "x")}


@pytest.mark.parametrize("order", [["day", "part", "id"], [("day", False), ("part", False), ("id", False)], ["flag", "id"], ["day", ("id", False)], ["part", "id"]])
def test_a_hot_first_value_is_cut_by_the_next_columns(spark, order):
    df = frame(spark)
    got = W.running(df, order, AGGS, "g", blocks=8).select("id", *AGGS)
    want = W.running(df, order, AGGS, "g", blocks=1).select("id", *AGGS)
    key = lambda x: x["id"]
    for a, b in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key)):
        assert a["id"] == b["id"] and all(x == y or abs(x - y) < 1e-6 for x, y in zip(a[1:], b[1:]))


@pytest.mark.parametrize("order", [["day", "id"], [("day", False), ("part", False), ("id", False)], ["part", "id"]])
def test_the_largest_block_is_small(spark, order):
    cut = W._cut(frame(spark), W._order_spec(order), 8)
    sizes = [r["count"] for r in cut.groupBy("__blk").count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * 4000 / 8


def test_equal_tuples_stay_together(spark):
    df = spark.range(3000).select(F.lit(1).alias("a"), (F.col("id") % 3).alias("b"), "id")
    got = W.rank(df, ["a", "b"], blocks=8).groupBy("b", "rank").count().collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1000), (1, 1001, 1000), (2, 2001, 1000)]




@pytest.mark.parametrize("blocks", [1, 7])
def test_clamped_recurrence(spark, blocks):
    r = random.Random(blocks)
    rows = []
    for i in range(1500):
        g = "hot" if i % 3 else r.choice(["x", None])
        lo, hi = r.choice([(0.0, 10.0), (None, 8.0), (-2.0, None), (3.0, 1.0), (None, 20.0)])
        rows.append((g, 1, i, r.choice([None, 1.0, 0.5, -0.7, 0.0, 1.9]), r.choice([None, 3.0, -4.0, 0.25]), lo, hi))
    df = spark.createDataFrame(rows, "g string, day int, id long, a double, b double, lo double, hi double").repartition(4)
    got = {x["id"]: x["y"] for x in W.clamped_recurrence(df, ["day", "id"], "a", "b", "y", "lo", "hi", "g", x0=5.0, blocks=blocks).collect()}
    state = {}
    for g, _, i, a, b, lo, hi in rows:
        x = state.get(g, 5.0)
        if a is not None and b is not None:
            x = a * x + b
            x = x if lo is None else max(lo, x)
            x = x if hi is None else min(hi, x)
        state[g] = x
        assert abs(got[i] - x) < 1e-6, i


def test_growing_steps_between_bounds(spark):
    df = spark.range(3000).select("id", F.lit(3.0).alias("a"), F.when(F.col("id") % 2 == 0, -5.0).otherwise(4.0).alias("b"))
    got = {r["id"]: r["y"] for r in W.clamped_recurrence(df, "id", "a", "b", "y", 0.0, 100, x0=2.0, blocks=3).collect()}
    x = 2.0
    for i in range(3000):
        x = min(100.0, max(0.0, 3.0 * x + (-5.0 if i % 2 == 0 else 4.0)))
        assert got[i] == x
    assert W.clamped_recurrence(df.limit(0), "id", "a", "b", "y").count() == 0
