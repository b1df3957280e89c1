"""Match-merge by position against a row-by-row program data vector, and metrics of folds."""

import random

from pyspark.sql import functions as F

from tessera.operators import joins as J
from tessera.operators import models as M


def pdv(tables, order):
    """The data step, one by value after another."""
    out = []
    columns = list(dict.fromkeys(c for rows in tables for r in rows for c in r if c not in ("k", order)))
    for k in {r["k"] for rows in tables for r in rows}:
        mine = [sorted((r for r in rows if r["k"] == k), key=lambda r: r[order]) for rows in tables]
        vector = dict.fromkeys(columns)
        for i in range(max(map(len, mine))):
            for rows in mine:
                if i < len(rows):
                    vector.update({c: v for c, v in rows[i].items() if c not in ("k", order)})
            out.append((k, *[vector[c] for c in columns], *[bool(rows) for rows in mine]))
    return columns, out


def test_three_tables_with_repeats(spark):
    r = random.Random(2)
    names = (["a", "s"], ["b", "s", "t"], ["t", "c"])
    tables = []
    for own in names:
        rows = []
        for i in range(400):
            k = "hot" if r.random() < 0.5 else r.choice([None, "x", "y", f"{own[0]}only", f"r{r.randint(0, 40)}"])
            rows.append({"k": k, "o": i, **{c: r.choice([None, i * 10 + j]) for j, c in enumerate(own)}})
        tables.append(rows)
    frames = [(spark.createDataFrame([tuple(x.values()) for x in rows], "k string, o long, " + ", ".join(f"{c} long" for c in own)).repartition(3)
               .withColumnRenamed("o", f"o{i}"), [f"o{i}"]) for i, (own, rows) in enumerate(zip(names, tables))]
    got = J.match_merge_by_position(frames, "k", ["in0", "in1", "in2"])
    columns, want = pdv(tables, "o")
    flat = [tuple(x) for x in got.select("k", *columns, "in0", "in1", "in2").collect()]
    assert sorted(flat, key=str) == sorted(want, key=str)
    empty = [(frames[0][0].limit(0), ["o0"]), frames[2]]
    assert J.match_merge_by_position(empty, "k", ["in0", "in1"]).where("in0 OR NOT in1").count() == 0


def test_metrics_by_group_equal_single_ones(spark):
    r = random.Random(3)
    rows = [(i % 3, round(r.random(), 1), float(r.random() < 0.4)) for i in range(300)]
    df = spark.createDataFrame(rows, "f int, s double, y double")
    by = {x["f"]: x for x in M.binary_metrics_by(df, "s", "y", "f").collect()}
    for f in range(3):
        one = M.binary_metrics(df.where(F.col("f") == f), "s", "y").first()
        assert all(abs(by[f][m] - one[m]) < 1e-9 for m in ("auc", "average_precision", "log_loss", "precision", "recall", "f1"))


def test_cross_test_has_every_metric(spark):
    r = random.Random(5)
    rows = [(r.random(), r.choice("ab"), 0.0) for _ in range(120)]
    rows = [(x, g, float(x + (g == "a") > 0.9)) for x, g, _ in rows]
    df = spark.createDataFrame(rows, "x double, g string, y double")
    got = {x["metric"]: x for x in M.cross_test(df, "y", "BINARY_CLASSIFICATION", ["x", "g"], "logistic", folds=3).collect()}
    assert set(got) == {"auc", "average_precision", "log_loss", "precision", "recall", "f1"} and all(x["folds"] == 3 and x["std"] is not None for x in got.values())
    assert got["auc"]["mean"] > 0.8
    got = {x["metric"]: x for x in M.cross_test(df, "x", "REGRESSION", ["y"], "least_squares", folds=2).collect()}
    assert set(got) == {"rmse", "mae", "r2"} and got["rmse"]["mean"] < 0.5
