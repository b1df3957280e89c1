import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm.op6_suffix_dedup import remove_repeats, repeated
from tessera.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(hashlib.blake2b(r[i : i + length], digest_size=12).digest() for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[hashlib.blake2b(r[i : i + length], digest_size=12).digest()] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1).sum())
        out.append((len(r), int(gone.sum()), runs, bytes(np.frombuffer(r, np.uint8)[~gone[:-1]])))
    return out


def some_texts(r, n):
    passage = ["".join(r.choice("abcdé \n") for _ in range(r.choice([5, 14, 19, 22, 60, 150]))) for _ in range(6)]
    out = []
    for _ in range(n):
        out.append("".join(r.choice([r.choice(passage), "".join(r.choice("xyzé ") for _ in range(r.randint(0, 30)))]) for _ in range(r.randint(0, 7))))
    return out


@pytest.mark.parametrize("length,limit,seed", [(20, 4096, 1), (20, 3, 2), (21, 2, 3), (8, 1, 4), (5, 4096, 5), (400, 4096, 6)])
def test_against_brute_force(spark, length, limit, seed):
    r = random.Random(seed)
    texts = some_texts(r, 60) + [None, "", "a", "ab" * 300, "z" * 700, "z" * length]
    texts += [texts[3], texts[5][:-1] + "Q", "q" + texts[5], "the " * 200]
    docs = spark.createDataFrame([(i if i % 9 else None, t, "k", i) for i, t in enumerate(texts)], "doc_id long, text string, kept string, at int")
    got = remove_repeats(docs, length, want=("n_bytes", "n_kept", "n_removed", "n_spans", "kept", "kept_text"), block_contexts=limit).collect()
    assert len(got) == len(texts)
    want = brute(texts, length)
    for x in got:
        assert (x["n_bytes"], x["n_removed"], x["n_spans"], bytes(x["kept"])) == want[x["at"]], (x["at"], texts[x["at"]])
        assert x["n_kept"] == len(x["kept"])
        assert x["kept_text"] == (None if texts[x["at"]] is None else bytes(x["kept"]).decode(errors="ignore"))


def test_blocks_are_dealt_anew_after_their_join(spark):
    import tessera.llm.op6_suffix_dedup as m

    # the join's own exchange does not do: adaptive execution may read it as it was written
    rows = [(str(i).encode(), i, side, 1, -4, 0, b"abcd", b"efgh") for side in range(2) for i in range(40)]
    members = spark.createDataFrame(rows, m.MEMBER)
    sized = members.join(members.groupBy("block").count().hint("merge"), "block").where("count >= 2").drop("count")
    merged = m._merge(sized)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "REPARTITION_BY_COL" in plan
    assert all([tuple(r) for r in x["runs"]] == [(-4, 0)] for x in merged.collect())


def test_a_block_of_many_shards(monkeypatch):
    import tessera.llm.op6_suffix_dedup as m

    monkeypatch.setattr(m, "SHARD_CONTEXTS", 7)
    r = random.Random(2)
    size = 12
    left = ["".join(r.choice("ab") for _ in range(r.randint(0, size))) for _ in range(120)]
    right = ["".join(r.choice("ab") for _ in range(r.randint(0, size))) for _ in range(120)]
    members = pa.table(
        {"block": [b"x"] * 70 + [b"y"] * 50, "lo": pa.array([-size] * 120, pa.int32()), "hi": pa.array([0] * 120, pa.int32()), "copies": [1] * 120}
        | {"left": pa.array([x.encode() for x in left]), "right": pa.array([x.encode() for x in right])}
    )
    windows = [{s: (left[i][len(left[i]) + s :] if s else "") + "|" + right[i][: size + s] for s in range(-size, 1) if len(left[i]) >= -s and len(right[i]) >= size + s} for i in range(120)]
    many = Counter((i < 70, s, w) for i, x in enumerate(windows) for s, w in x.items())
    for i, runs in enumerate(repeated(members)):
        got = {s for x in runs for s in range(x["first"], x["last"] + 1)}
        assert got == {s for s, w in windows[i].items() if many[(i < 70, s, w)] > 1}


def test_long_text_in_pieces(spark, monkeypatch):
    r = random.Random(9)
    long = "".join(r.choice("abcdefgh ") for _ in range(2_300_000))
    texts = [long, long[1_048_000:1_049_500], "fresh" * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: (x["n_removed"], x["n_spans"]) for x in remove_repeats(docs).collect()}
    assert got == {0: (1500, 1), 1: (1500, 1), 2: (0, 0)}


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    want = dict(zip((d["doc_id"] for d in docs), brute([d["text"] for d in docs], 400)))
    got = QUERIES["op6_suffix_dedup"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for x in got:
        n, gone, runs, kept = want[x["doc_id"]]
        assert (x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) == (n, gone, runs, hashlib.sha256(kept).hexdigest())
