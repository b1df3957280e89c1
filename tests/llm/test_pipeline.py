"""Each stage of the pipeline against brute force on what the stage before it kept."""

import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

import __spark_entry__
import corpus_pipeline
from tessera.llm.common import materialize
from tessera.llm.op8_quality import measure
from tessera.llm.stages import PASSAGE_BYTES
from tests.conftest import SF_SMALL
from tests.llm import test_op3_decontaminate as op3
from tests.llm import test_op6_suffix_dedup as op6
from tests.llm import test_op8_quality as op8
from tests.llm import test_op10_ngram_join as op10

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF_SMALL), "test"))
    return out


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_stages_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules",
        "n-gram Jaccard join",
        "suffix-array dedup",
        "benchmark decontamination",
        "bpe",
    ]
    assert all(s.columns == COLUMNS for s in steps[:-1])


def test_quality(spark, steps):
    from tessera.llm.op8_quality import fit

    trees = fit(steps[0], spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    want = set()
    for i, t in texts(steps[0]).items():
        raw = t.encode()
        n, *_, repeat = op8.brute(t)
        _, features = measure(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        if n >= 50 and 100 * repeat <= 50 * n and trees.score(features)[0] >= 0.5:
            want.add(i)
    assert set(texts(steps[1])) == want and 0 < len(want) < steps[0].count()


def test_near_duplicates(steps):
    before = sorted(texts(steps[1]).items())
    _, roots = op10.brute([t for _, t in before], 5, 80)
    first = {}
    for (i, _), k in zip(before, roots):
        first.setdefault(k, i)
    assert sorted(texts(steps[2])) == sorted(first.values())


def test_suffix_dedup(steps):
    before = sorted(texts(steps[2]).items())
    want = {i: kept.decode(errors="ignore") for (i, _), (_, _, _, kept) in zip(before, op6.brute([t for _, t in before], PASSAGE_BYTES))}
    assert texts(steps[3]) == want


def test_decontamination(spark, steps):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    after, left = texts(steps[4]), 0
    for i, t in texts(steps[3]).items():
        n, n_hit, _, at = op3.brute(t, items, 10)
        if n_hit > 0.8 * n:
            assert i not in after
        else:
            left += 1
            assert op3.words(after[i]) == [w for k, w in enumerate(op3.words(t)) if k not in at]
            assert n_hit or after[i] == t
    assert left == len(after)


def test_bpe(steps):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    model = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    before, rows = texts(steps[4]), steps[5].collect()
    assert len(rows) == len(before)
    for r in rows:
        assert r["token_ids"] == model.encode_ordinary(before[r["doc_id"]])
        assert r["decoded_sha256"] == hashlib.sha256(before[r["doc_id"]].encode()).hexdigest()


def test_registered(spark, steps):
    queries = __spark_entry__.queries()
    assert {n for n in queries if n.startswith("op")} >= {n for n in queries if n.split("_")[0] in {f"op{k}" for k in range(1, 14)}}
    assert sum(n.split("_")[0] == f"op{k}" for k in range(1, 14) for n in queries) == 13
    assert queries["pipeline"](spark, SF_SMALL).count() == steps[5].count()


def test_odd_and_empty_documents_pass_all_stages(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, good, "en", "s", 1), (4, good, "en", "s", 1), (4, good, "en", "s", 1), (5, "word " * 30000, None, "s", 2)]
    for docs in (spark.createDataFrame(rows, kind), spark.createDataFrame([], kind)):
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF_SMALL), "test")
        assert docs.count() <= 1
