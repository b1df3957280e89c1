import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from tessera.llm.op9_bpe import encode_decode, merge_word, read_ranks, spelled
from tessera.llm.queries import QUERIES
from tests.conftest import SF_SMALL

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def model():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def strings(n, seed=7):
    r = random.Random(seed)
    alphabet = list("ab cTé'\n\t.,12 ²½ 漢字🙂́\x1c\x1d\x85\xa0 ᠎ ​ 　\r\x0b\x0c'sll're") + ["the ", " and", "  "]
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(n)]


def test_words_and_merges_equal_tiktoken(model):
    import regex

    ranks, find = read_ranks(PATH), regex.compile(spelled(P.PATTERN)).findall
    for s in strings(3000) + ["a" * 5000, "x" * 777 + "é" * 300]:
        assert [i for w in find(s) for i in merge_word(w.encode(), ranks)] == model.encode_ordinary(s), repr(s)


def test_odd_rows(spark, model):
    texts = [None, "", " ", "Hello world, hello", "Hello world, hello", "é" * 3000, *strings(50, 3)]
    rows = [(i if i != 1 else None, t, f"k{i}", i) for i, t in enumerate(texts)] + [(3, texts[3], "k3", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, at int")
    got = encode_decode(docs, PATH, P.PATTERN, ("token_ids", "n_tokens", "decoded"), block_bytes=200).collect()
    assert len(got) == len(rows)
    for r in got:
        s = texts[r["at"]] or ""
        assert r["token_ids"] == model.encode_ordinary(s) and bytes(r["decoded"]) == s.encode() and r["n_tokens"] == len(r["token_ids"])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert encode_decode(docs, PATH, P.PATTERN).count() == 0


def test_query_against_tiktoken(spark, model):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = QUERIES["op9_bpe"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = model.encode_ordinary(docs[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((docs[r["doc_id"]] or "").encode()).hexdigest()
