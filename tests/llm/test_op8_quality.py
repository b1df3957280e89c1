import random
import re
from collections import Counter

import numpy as np

from tessera.llm.op8_quality import COUNTS, FEATURES, boost, fit, judge
from tessera.llm.queries import QUERIES
from tests.conftest import SF_MID, SF_SMALL


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_counts_of_odd_rows(spark):
    r = random.Random(1)
    texts = [None, "", " \n\t", "a a a a a", "\x1c\x85\xa0 é\x1fé", "x\n\nx\n y\nx", "ab " * 4000]
    texts += ["".join(r.choice(["a", "b", "é", " ", "\n", "#", "\x0b", "漢", "\x1d"]) for _ in range(r.randint(0, 90))) for _ in range(200)]
    rows = [(i % 50 if i else None, t, "clash", "more") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, more string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    got = judge(docs, fit(docs, labels)).collect()
    assert sorted((r["text"] or "", r["more"]) for r in got) == sorted((t or "", "more") for t in texts)
    for row in got:
        n, *_, repeat = want = brute(row["text"])
        assert tuple(row[c] for c in COUNTS) == want, row
        assert row["base_failed"] == (n < 50 or 100 * repeat > 50 * n) and row["kept"] == (not row["base_failed"])


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert judge(docs, fit(docs, labels)).count() == 0


def test_trees_are_monotone_and_flat_scoring_equals_a_walk():
    r = np.random.default_rng(3)
    x = r.random((800, len(FEATURES)))
    y = (x[:, 2] + 0.5 * np.sin(9 * x[:, 4]) + 0.3 * r.standard_normal(800) < 0.6).astype(float)
    trees = boost(x, y, trees=25)
    probe = r.random((50, len(FEATURES)))
    for j, direction in enumerate(FEATURES.values()):
        if direction:
            line = np.repeat(probe[:, None], 21, axis=1)
            line[:, :, j] = np.linspace(0, 1, 21)
            scores = trees.score(line.reshape(-1, len(FEATURES))).reshape(50, 21)
            assert (direction * np.diff(scores, axis=1) >= -1e-12).all()

    def walk(row):
        total = trees.base
        for at in trees.roots:
            while trees.child[at][0] != at:
                at = trees.child[at][int(row[trees.feature[at]] > trees.threshold[at])]
            total += trees.value[at]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.score(probe), [walk(p) for p in probe])


def test_query_counts_and_held_out_accuracy(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for row in QUERIES["op8_quality"](spark, SF_SMALL).collect():
        assert tuple(row[c] for c in COUNTS) == brute(docs[row["doc_id"]])
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    trees = fit(docs, labels.where("doc_id % 2 = 0"))
    held = judge(docs, trees).join(labels.where("doc_id % 2 = 1"), "doc_id").select("score", "quality").toPandas()
    assert ((held["score"] >= 0.5) == (held["quality"] == 1)).mean() > 0.9
