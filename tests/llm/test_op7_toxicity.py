import numpy as np
from pyspark.sql import functions as F

from tessera.llm.op7_toxicity import fit, score, train
from tessera.llm.queries import QUERIES
from tests.conftest import SF_MID, SF_SMALL

SF_BENCH = "/root/testdata/sf0.1"


def test_training_recovers_the_prior_from_unlabelled_texts():
    r = np.random.default_rng(5)
    toxic = lambda n: (r.random((n, 20)) < np.r_[np.full(4, 0.7), np.full(16, 0.3)]).astype(float)
    clean = lambda n: (r.random((n, 20)) < np.r_[np.full(4, 0.02), np.full(16, 0.3)]).astype(float)
    w, b = train(toxic(300), np.vstack([toxic(200), clean(1800)]), 0.1)
    p = lambda x: 1 / (1 + np.exp(-(x @ w + b)))
    assert (p(toxic(500)) > 0.3).mean() > 0.9 and (p(clean(500)) > 0.3).mean() < 0.08


def test_odd_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = fit(docs, labels, F.lit(True))
    rows = [(1, None, "x"), (2, "", "x"), (None, "you idiot " * 9, "x"), (3, "a b", "x"), (3, "a b", "x")]
    got = score(spark.createDataFrame(rows, "doc_id long, text string, predicted string"), model).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    none = docs.limit(0)
    assert score(none, model).count() == 0
    assert all(0 < r["score"] < 1 for r in score(docs.limit(3), fit(none, labels.limit(0), F.lit(True))).collect())


def test_held_out_accuracy(spark):
    got = QUERIES["op7_toxicity"](spark, SF_BENCH)
    labels = spark.read.parquet(f"{SF_BENCH}/labels.parquet")
    held = got.where("held_out").join(labels, "doc_id").toPandas()
    # about one labelled toxic document in eight has no word that tells
    assert ((held["predicted"] == 1) & (held["toxic"] == 1)).sum() / (held["toxic"] == 1).sum() > 0.8
    assert ((held["predicted"] == 1) & (held["toxic"] == 0)).sum() / (held["toxic"] == 0).sum() < 0.02


def test_query_covers_every_row(spark):
    assert QUERIES["op7_toxicity"](spark, SF_MID).count() == spark.read.parquet(f"{SF_MID}/documents.parquet").count()


def test_the_fit_does_not_depend_on_repeated_rows_or_their_order(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    once = fit(docs, labels, F.lit(True))
    again = fit(docs.union(docs).repartition(7), labels, F.lit(True), unlabelled=6000)
    assert len(once.words) and np.array_equal(once.words, again.words)
    assert np.array_equal(once.weights, again.weights) and once.bias == again.bias
    # one key with many texts: the sample is bounded and the same in whatever order
    hot = docs.select(F.lit(1).cast("long").alias("doc_id"), "text")
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    a, b = (fit(docs.select("doc_id", "text").union(x), one, F.lit(True), positives=20, unlabelled=50) for x in (hot, hot.repartition(5)))
    assert np.array_equal(a.words, b.words) and np.array_equal(a.weights, b.weights) and a.bias == b.bias
