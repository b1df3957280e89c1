import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.operators import search as S


def _brute(queries, docs, k, k1=1.2, b=0.75):
    words = defaultdict(list)
    for i, t in docs:
        words[i] += re.findall(r"[a-z]+", (t or "").lower())
    words = {i: w for i, w in words.items() if w}
    n, avg = len(words), sum(map(len, words.values())) / max(len(words), 1)
    tf = {i: Counter(w) for i, w in words.items()}
    df = Counter(t for c in tf.values() for t in c)
    out = []
    for q, text in queries:
        scores = defaultdict(float)
        for t in sorted(set(re.findall(r"[a-z]+", (text or "").lower()))):
            for i, c in tf.items():
                if c[t]:
                    idf = math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5))
                    scores[i] += idf * c[t] * (k1 + 1) / (c[t] + k1 * (1 - b + b * len(words[i]) / avg))
        best = sorted(scores.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k]
        out += [(q, i, round(s, 6), r) for r, (i, s) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("probe", [1, 20])
def test_pruned_scores_equal_brute_force(spark, monkeypatch, probe):
    monkeypatch.setattr(S, "PROBE", probe)
    r = random.Random(3)
    vocab = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(r.choices(vocab, weights, k=r.randint(1, 60)))) for i in range(600)]
    docs += [(700, None), (701, ""), (702, "aa " * 5000), (5, "aa ab repeated id"), (703, docs[0][1]), (704, docs[0][1])]
    queries = [(i, " ".join(r.choices(vocab, weights, k=r.randint(1, 12)))) for i in range(40)]
    queries += [(50, None), (51, ""), (52, "zz9 nosuchword"), (53, "aa"), (54, docs[0][1])]
    got = S.bm25_search(spark.createDataFrame(queries, "q long, text string"), spark.createDataFrame(docs, "d long, text string"),
                        "q", "text", "d", "text", k=4)
    assert sorted((x[0], x[1], round(x[2], 6), x[3]) for x in got.collect()) == _brute(queries, docs, 4)


def test_common_terms_are_not_scored_everywhere(spark):
    docs = [(i, "the common words of all " + (f"rare{'x' * (i % 9)} " if i % 50 == 0 else "")) for i in range(2000)]
    dd = spark.createDataFrame([(i, t + "pad " * (i % 7)) for i, t in docs], "d long, text string")
    qq = spark.createDataFrame([(0, "the rarexx of all"), (1, "the common rarexxx")], "q long, text string")
    qt = S.tokens(qq, "q", "text").distinct().withColumnRenamed("__id", "__qid")
    plan = S.term_plan(qt, S.postings(qt, dd, "d", "text", 1.2, 0.75), 2)
    all_rows, kept = plan.agg(F.sum("df"), F.sum(F.when(F.col("essential"), F.col("df")))).first()
    assert all_rows > 10_000 and kept < all_rows / 100


def test_empty_tables(spark):
    none = spark.createDataFrame([], "i long, text string")
    some = spark.createDataFrame([(1, "a b")], "i long, text string")
    for q, d in ((none, some), (some, none), (none, none)):
        assert S.bm25_search(q.withColumnRenamed("i", "q"), d, "q", "text", "i", "text").count() == 0


def test_words_counted_where_they_are_read(spark):
    """Ids without repeats, so that no count travels."""
    r = random.Random(8)
    vocab = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(200)]
    docs = [(i, " ".join(r.choices(vocab, k=r.randint(0, 30)))) for i in range(300)] + [(900, None), (901, "ab, AC. ad " * 20000), (902, " 1 ab")]
    queries = [(i, " ".join(r.choices(vocab, k=r.randint(1, 6)))) for i in range(20)]
    dd = spark.createDataFrame(docs, "d long, text string")
    got = S.bm25_search(spark.createDataFrame(queries, "q long, text string"), dd, "q", "text", "d", "text", k=5)
    assert sorted((x[0], x[1], round(x[2], 6), x[3]) for x in got.collect()) == _brute(queries, docs, 5)
    counted = S.document_terms(dd, "d", "text")
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    want = Counter()
    for i, t in docs:
        words = re.findall("[a-z]+", (t or "").lower())
        want.update((i, w, len(words)) for w in words)
        want.update({(i, None, len(words)): len(words)} if words else {})
    assert {(x["__id"], x["term"], x["dl"]): x["tf"] for x in counted.collect()} == dict(want)
