import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import patterns as X
from tessera.operators import prepare as P
from tessera.operators import rule_match as R
from tests.conftest import SF_SMALL

#: (characters of an automaton, characters of all): one automaton, many, the join on substrings
PATHS = [(1_000_000, 16_000_000), (9_000, 16_000_000), (1_000_000, 10)]


def _first(text, rules):
    return min((r for r in rules if r[0] and text and r[0] in text), key=lambda r: (r[2], r[0], r[1] or ""), default=None)


@pytest.mark.parametrize("shard,most", PATHS)
def test_paths_equal_brute_force(spark, monkeypatch, shard, most):
    monkeypatch.setattr(R, "SHARD_CHARS", 40 if shard == 9_000 else shard)
    monkeypatch.setattr(R, "MAX_CHARS", most)
    r = random.Random(1)
    letters = ["a", "b", "é", "😀", " "]
    rules = [("".join(r.choices(letters, k=r.randint(1, 5))), f"v{i}", r.randint(0, 30)) for i in range(150)]
    rules += [("", "blank", 0), (None, "null", 0), ("zz", None, 1), ("zz", "second", 2), ("bab", "low", 0), ("bab", "also", 0)]
    texts = [None, "", "zz", "xyz", "bab", "no hit"] + ["".join(r.choices(letters + list("xyz"), k=r.randint(1, 12))) for _ in range(200)]
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts + texts[:20])], "id int, t string, __find string")
    rl = spark.createDataFrame(rules, "__find string, __value string, __order int")
    got = {x["id"]: (x["__hit"] and tuple(x["__hit"]), x["__find"]) for x in R.with_first_rule(df, F.col("t"), rl).collect()}
    assert len(got) == df.count()
    for i, t in enumerate(texts + texts[:20]):
        want = _first(t, rules)
        assert got[i] == (want and want[:2], "kept"), (i, t)


@pytest.mark.parametrize("shard,most", PATHS[:2])
def test_five_thousand_rules_over_documents(spark, monkeypatch, shard, most):
    monkeypatch.setattr(R, "SHARD_CHARS", shard)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows, r = docs.collect(), random.Random(7)
    rules = []
    while len(rules) < 5000:
        t = r.choice(rows)["text"] or ""
        at = r.randrange(max(1, len(t)))
        rules.append((t[at : at + r.randint(5, 14)].lower() or "x", f"c{len(rules) % 40}", r.randint(0, 2000)))
    rl = spark.createDataFrame(rules, "kw string, cat string, p int")
    got = X.classify(docs, "doc_id", "text", rl, "kw", "cat", "p", match="substring", default="none")
    assert len(R._shards([(0, x[0], "") for x in rules], shard)) == (1 if shard > 9_000 else 6)
    want = []
    for d in rows:
        best = _first((d["text"] or "").lower(), rules)
        want.append((d["doc_id"], best[1] if best else "none"))
    assert sorted((x["doc_id"], x["category"]) for x in got.select("doc_id", "category").collect()) == sorted(want)


def test_one_automaton_needs_no_shuffle_and_long_texts_pass(spark):
    df = spark.createDataFrame([(1, "ab" * 1_000_000 + "needle"), (2, "ab" * 1_000_000)], "id int, t string")
    rules = spark.createDataFrame([("needle", "N", 1), *((f"q{i}q", "x", 2) for i in range(400))], "f string, r string, o int")
    out = P.find_replace(df, "t", rules, "f", "r", "o", mode="substring", out="n")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert [(x["id"], x["n"][-3:]) for x in out.orderBy("id").collect()] == [(1, "abN"), (2, "bab")]


def test_no_rules_and_no_rows(spark):
    none = spark.createDataFrame([], "f string, r string, o int")
    some = spark.createDataFrame([("a", "b", 1)], "f string, r string, o int")
    df = spark.createDataFrame([(1, "a")], "id int, t string")
    go = lambda d, r: [tuple(x) for x in P.find_replace(d, "t", r, "f", "r", "o", mode="substring", inline_max=-1).collect()]
    assert go(df, none) == [(1, "a")] and go(df, some) == [(1, "b")] and go(df.limit(0), some) == []
