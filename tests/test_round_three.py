"""Meanings, rank correlation, streamed groups, variants and keyword search."""

import random
import unicodedata

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import prepare as P
from tessera.operators import quality as Q
from tessera.operators import search as S
from tessera.operators import stats as T
from tessera.plans import custom as UX


def test_patterns_match_the_whole_value(spark):
    df = spark.createDataFrame([("12",), ("12abc",), ("12\n",), ("x12",), (None,)], "s string")
    for pattern in (r"\d+", r"^\d+", r"\d+$", r"^\d+$", r"^(\d+)|x$"):
        got = [r["ok"] for r in df.select(Q.pattern_meaning("s", pattern).alias("ok")).collect()]
        assert got == [True, False, False, False, None], pattern


def test_normalized_over_all_latin(spark):
    letters = [chr(c) for c in range(0xC0, 0x1F00) if "LATIN" in unicodedata.name(chr(c), "") and len(unicodedata.normalize("NFD", chr(c))) > 1]
    plain = [next(x for x in unicodedata.normalize("NFD", c)) for c in letters]
    pairs = [(c, p) for c, p in zip(letters, plain) if p.isascii()]
    assert len(pairs) > 400
    df = spark.createDataFrame(pairs + [("ł", "l"), ("Ő š", "os"), ("e\u0301", "e"), ("Đ", "d"), ("ø", "o")], "a string, b string")
    wrong = [r for r in df.select("a", "b", Q.normalize("a", "NORMALIZED").alias("n")).collect() if r["n"] != r["b"].lower()]
    assert not wrong
    got = df.where("a = 'Ő š'").select(Q.values_meaning("a", ["OŠ"], "NORMALIZED").alias("x")).first()
    assert got["x"] is True


def test_detect_meaning_samples_rows(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, "same").otherwise(F.col("id").cast("string")).alias("s"))
    for key in (None, "id"):
        got = Q.detect_meaning(df, "s", {"word": Q.pattern_meaning("s", "[a-z]+")}, sample_fraction=0.3, key=key).first()
        assert 0.4 < got["ratio"] < 0.6


def test_spearman_ties_and_gaps(spark):
    r = random.Random(1)
    rows = [(r.choice([None, 0.0, -0.0, 1.0, 2.5, float("nan")]), float(r.randint(0, 9)), r.random()) for _ in range(400)]
    got = {x["column"]: x for x in T.correlation_matrix(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"], "spearman").collect()}
    ranks = pd.DataFrame(rows, columns=list("abc")).dropna().rank()
    want = ranks.corr()
    assert all(abs(got[i][j] - want.loc[i, j]) < 1e-9 for i in "abc" for j in "abc")
    with pytest.raises(ValueError):
        T.correlation_matrix(spark.range(1), ["id"], "kendall")


def test_streamed_groups(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"), (30000 - F.col("id")).alias("x"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        def count(batches):
            sizes, total, key = [], 0, None
            for b in batches:
                key = b["g"].iloc[0]
                sizes.append(len(b))
                total += int(b["x"].sum())
            yield pd.DataFrame({"g": [key], "n": [sum(sizes)], "most": [max(sizes)], "total": [total]})

        def add(batches):
            every = pd.concat(list(batches))
            yield pd.DataFrame({"g": [every["g"].iloc[0]], "n": [every["n"].sum()], "most": [every["most"].max()], "total": [every["total"].sum()]})

        kind = "g string, n long, most long, total long"
        want = {r["g"]: (r["n"], r["t"]) for r in df.groupBy("g").agg(F.count("*").alias("n"), F.sum("x").alias("t")).collect()}
        for options in ({}, {"salts": 4, "merge": add}):
            got = UX.grouped_stream(df, "g", count, kind, **options).collect()
            assert {r["g"]: (r["n"], r["total"]) for r in got} == want
            assert max(r["most"] for r in got) <= 1000  # never a whole group at once

        def first_of(batches):
            yield next(iter(batches)).head(1)

        ordered = UX.grouped_stream(df, "g", first_of, "g string, x long", order_by=["x"]).collect()
        assert {r["g"]: r["x"] for r in ordered} == {r["g"]: r["m"] for r in df.groupBy("g").agg(F.min("x").alias("m")).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    with pytest.raises(ValueError):
        UX.grouped_stream(df, "g", count, kind, salts=2)


def test_flatten_variant(spark):
    df = spark.createDataFrame([(1, '{"a": {"k": 1}, "b": [1, "x", null]}'), (2, "[1.5, {}]"), (3, "oops"), (4, None), (5, "7"), (6, "{}")], "id int, j string")
    got = sorted((r["id"], r["pos"], r["key"], r["v"], r["type"]) for r in P.flatten_variant(df, "j").withColumn("v", P.variant_field("value", "$")).collect())
    assert [x[:3] for x in got] == [(1, 0, "a"), (1, 1, "b"), (2, 0, None), (2, 1, None)]
    assert got[0][3] == '{"k":1}' and got[2][3] == "1.5" and got[0][4] == "OBJECT<k: BIGINT>"
    inner = P.flatten_variant(df, "j", "$.b", prefix="e_").collect()
    assert [(r["id"], r["e_pos"]) for r in sorted(inner, key=lambda r: r["e_pos"])] == [(1, 0), (1, 1), (1, 2)]
    assert P.flatten_variant(df, "j", outer=True).count() == 8


def test_bm25_against_brute_force(spark):
    r = random.Random(8)
    texts = [" ".join(r.choice(["Alpha", "beta", "gamma", "x1y", "é"]) for _ in range(r.randint(0, 12))) for _ in range(40)] + [None, "", "123"]
    docs = spark.createDataFrame(list(enumerate(texts)), "d int, t string")
    queries = spark.createDataFrame([(1, "beta beta unknown"), (2, "Y é"), (3, None), (4, "zzz")], "q int, t string")
    import math
    import re

    words = [re.findall(r"[^\W\d_]+", (t or "").lower()) for t in texts]
    have = [w for w in words if w]
    n, avg = len(have), sum(map(len, have)) / len(have)
    want = {}
    for q, terms in ((1, {"beta", "unknown"}), (2, {"y", "é"})):
        scores = {}
        for i, w in enumerate(words):
            s = 0.0
            for t in terms & set(w):
                df = sum(t in x for x in words)
                s += math.log(1 + (n - df + 0.5) / (df + 0.5)) * w.count(t) * 2.2 / (w.count(t) + 1.2 * (0.25 + 0.75 * len(w) / avg))
            if terms & set(w):
                scores[i] = s
        for rank, (i, s) in enumerate(sorted(scores.items(), key=lambda x: (-round(x[1], 9), x[0]))[:5], 1):
            want[q, i] = (round(s, 9), rank)
    got = {(x["q"], x["d"]): (round(x["score"], 9), x["rank"]) for x in S.bm25_search(queries, docs, "q", "t", "d", "t", k=5).collect()}
    assert got == want
