"""Texts of a megabyte through the operators that read whole texts, against brute force."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
from pyspark.sql import functions as F

from tessera.llm import op2_langid, op7_toxicity
from tessera.llm.op3_decontaminate import mark
from tessera.llm.op8_quality import COUNTS, fit, judge
from tessera.llm.op9_bpe import encode_decode, spelled
from tessera.llm.op10_ngram_join import groups
from tessera.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm import test_op3_decontaminate as op3
from tests.llm import test_op8_quality as op8
from tests.llm import test_op9_bpe as op9
from tests.llm.test_op10_ngram_join import shingles

model = op9.model


@pytest.fixture(scope="module")
def texts():
    r = random.Random(11)
    vocab = ["".join(r.choice("abcdefghijklé") for _ in range(r.randint(1, 8))) for _ in range(3000)]
    words = [r.choice(vocab) for _ in range(220_000)]
    long = "".join(w + r.choice([" ", " ", " ", ". ", "\n"]) for w in words)
    other = list(words)
    for at in range(0, len(other), 400):
        other[at] = "changed"
    assert len(long.encode()) > 1_000_000
    return [long, " ".join(words), " ".join(other), " ".join(r.choices(vocab, k=150_000)), "x" * 60_000, " " * 1_000_000, "short one"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def language_twin(known, text):
    """(lang_pred, score) of one text, by Python sets."""
    low = (text or "").encode().translate(op2_langid.LETTERS)
    place = {int(g): i for i, g in enumerate(known.grams)}
    codes = {int.from_bytes(low[i : i + n], "big") + (0, 0, 256, 256 + 65536)[n] for n in (1, 2, 3) for i in range(len(low) - n + 1)}
    own = sorted(place[c] for c in codes & place.keys())
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    k = known.landmarks[own].sum(axis=0) / np.sqrt(max(len(own), 1) * np.maximum(known.landmarks.sum(axis=0), 1))
    odds = np.exp(4 * (k @ known.weights).astype(float))
    return known.languages[int(odds.argmax())], odds.max() / odds.sum()


def toxicity_twin(known, text):
    low = (text or "").encode().translate(op7_toxicity.WORD_BYTES)
    weight = dict(zip(known.words.tolist(), known.weights.astype(float).tolist()))
    z = known.bias + sum(weight.get(op7_toxicity.xxhash.xxh3_64_intdigest(w) >> 1, 0.0) for w in set(low.split()))
    return 1 / (1 + np.exp(-z))


def in_part(key, mod):
    return zlib.crc32(str(key).encode()) % mod


def test_language(spark, docs, texts):
    known = op2_langid.fit(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), F.lit(True), rows=60)
    for row in op2_langid.predict(docs, known).collect():
        name, score = language_twin(known, texts[row["doc_id"]])
        assert row["lang_pred"] == name and abs(row["score"] - score) < 1e-4


def test_language_query_equals_a_twin(spark):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    # what the operator learns when it sees the training documents only
    learnt = table.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    known = op2_langid.fit(learnt, F.lit(True))
    plain = {r["doc_id"]: r["text"] for r in table.collect()}
    got = QUERIES["op2_langid"](spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(plain)
    for row in got:
        name, score = language_twin(known, plain[row["doc_id"]])
        assert row["lang_pred"] == name and abs(row["score"] - score) < 1e-4
        assert row["held_out"] == (in_part(row["doc_id"], 5) == 0)


def test_toxicity(spark, docs, texts):
    known = op7_toxicity.fit(*(spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels")), F.lit(True))
    for row in op7_toxicity.score(docs, known).collect():
        assert abs(row["score"] - toxicity_twin(known, texts[row["doc_id"]])) < 1e-9


def test_toxicity_query_equals_a_twin(spark):
    table, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    # labels of held-out documents are not even there
    known = op7_toxicity.fit(table, labels.where(part), part)
    plain = {r["doc_id"]: r["text"] for r in table.collect()}
    got = QUERIES["op7_toxicity"](spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(plain)
    for row in got:
        want = toxicity_twin(known, plain[row["doc_id"]])
        assert abs(row["score"] - want) < 1e-6
        assert row["predicted"] == int(row["score"] >= 0.3) and row["held_out"] == (in_part(row["doc_id"], 4) == 2)


def test_benchmark_words(spark, docs, texts):
    words = op3.words(texts[1])
    items = [(1, " ".join(words[100_000:100_030])), (2, " ".join(words[-12:])), (3, "not in any of the texts at all that are here"), (4, "short one")]
    got = mark(docs, spark.createDataFrame(items, "item_id long, text string"), 10).collect()
    assert sum(row["n_hit"] > 0 for row in got) >= 3
    for row in got:
        assert (row["n_words"], row["n_hit"], row["hit_items"]) == op3.brute(texts[row["doc_id"]], items, 10)[:3]


def test_quality_counts(spark, docs, texts):
    labels = spark.createDataFrame([(0, 1), (6, 0)], "doc_id long, quality int")
    for row in judge(docs, fit(docs, labels)).collect():
        assert tuple(row[c] for c in COUNTS) == op8.brute(texts[row["doc_id"]])


def test_tokens(docs, texts, model):
    for row in encode_decode(docs, op9.PATH, P.PATTERN, ("token_ids", "n_tokens", "decoded")).collect():
        s = texts[row["doc_id"]]
        # the library's own pattern search gives up on a megabyte of spaces: there, piece by piece
        pieces = regex.findall(spelled(P.PATTERN), s) if s.isspace() else None
        want = model.encode_ordinary(s) if pieces is None else [i for w in pieces for i in model._encode_single_piece(w)]
        assert row["token_ids"] == want and bytes(row["decoded"]) == s.encode()


def test_near_copies(docs, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in groups(docs).collect()}
    sets = [shingles(t, 4) for t in texts]
    assert {i: n for i, (n, _) in got.items()} == {i: len(s) for i, s in enumerate(sets)}
    near = lambda a, b: sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    assert near(1, 2) and not near(1, 3)
    # links are transitive here: a component's documents are all near each other
    for i in range(len(texts)):
        assert got[i][1] == next(j for j in range(len(texts)) if j == i or near(i, j))
