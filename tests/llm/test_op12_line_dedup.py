import hashlib
import random
import re
from collections import Counter

import pytest

from tessera.llm.op12_line_dedup import drop_common_lines
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.sql import agrees


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def brute(texts, min_docs, min_chars):
    lines = [(t or "").split("\n") for t in texts]
    docs = Counter(k for ls in lines for k in {key(x) for x in ls})
    gone = {k for k, n in docs.items() if n >= min_docs and len(k) >= min_chars}
    return [(len(ls), sum(key(x) in gone for x in ls), "\n".join(x for x in ls if key(x) not in gone)) for ls in lines]


@pytest.mark.parametrize("min_docs,min_chars", [(2, 1), (10, 1), (3, 4), (1, 2)])
def test_against_brute_force(spark, min_docs, min_chars):
    r = random.Random(min_docs)
    pieces = ["Home", " home\t", "HOME\r", "É", "é", "", " ", "日本語", "a b", "a  b", "x\x00y", "\x1ftail", "\x85", "long line " * 30]
    texts = ["\n".join(r.choice(pieces) + (str(r.randint(0, 40)) if r.random() < 0.4 else "") for _ in range(r.randint(0, 12))) for _ in range(60)]
    texts += [None, "", "\n", "Home", "Home", "Home", "one\n" * 200_000 + "Home", texts[0], texts[0]]
    rows = [(i if i % 5 else None, t, "mine", {"n": i}) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string, extra struct<n int>").repartition(3)
    want = {i: x for i, x in enumerate(brute(texts, min_docs, min_chars))}
    got = drop_common_lines(docs, min_docs=min_docs, min_chars=min_chars, want=("n_lines", "n_dropped", "kept_text", "kept_sha256")).collect()
    assert len(got) == len(texts)
    for x in got:
        i = x["extra"]["n"]
        assert (x["n_lines"], x["n_dropped"], x["kept_text"] or "") == want[i]
        assert (x["kept_text"] is None) == (texts[i] is None)
        assert x["kept_sha256"] == hashlib.sha256(want[i][2].encode()).hexdigest()


def test_a_third_of_the_rows_are_one_text(spark):
    texts = ["top\nbody\ntop"] * 500 + [f"top\nown {i}\nend" for i in range(1000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = Counter((x["n_lines"], x["n_dropped"], x["kept_text"].split(" ")[0]) for x in drop_common_lines(docs).collect())
    assert got == {(3, 3, ""): 500, (3, 2, "own"): 1000}


def test_empty_table(spark):
    assert drop_common_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        drop_common_lines(spark.createDataFrame([], "text string"), min_chars=0)


def test_query_against_sql(spark):
    agrees(spark, "op12_line_dedup", SF_SMALL)
    agrees(spark, "op12_line_dedup", SF_MID)
