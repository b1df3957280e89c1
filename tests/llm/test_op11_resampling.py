import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm.common import materialize
from tessera.llm.op11_resampling import draw, features, radix_ranks, ranked
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.sql import agrees


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def runs_of(text, runs):
    w = words(text)
    return [" ".join(w[i : i + k]) for k in range(1, runs + 1) for i in range(len(w) - k + 1)]


def brute(rows, target, runs, buckets, seed, min_words, percent):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for x in texts for f in runs_of(x, runs)) for texts in ([x for _, x in rows], target))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (big_s + buckets) / ((s[b] + 1.0) * (big_t + buckets)))) for b in range(buckets)]
    out = []
    for key, text in rows:
        found = runs_of(text, runs)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in found)
        out.append([key, len(words(text)), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((x for x in out if x[1] >= min_words), key=lambda x: (-x[4], x[0] is not None, x[0] or 0))
    return out, [(x[4], x[0]) for x in able[: percent * len(able) // 100]]


@pytest.mark.parametrize("runs,buckets,min_words,percent", [(1, 10000, 3, 30), (2, 50, 0, 100), (3, 7, 2, 50)])
def test_against_brute_force(spark, runs, buckets, min_words, percent):
    r = random.Random(runs)
    text = lambda n: "".join(r.choice(["a", "B", "c3", "é", "x-y", "zz", "日本"]) + r.choice([" ", ",", "\n"]) for _ in range(n))
    rows = [(r.choice([-5, 0, 1, 2**62, -(2**62)]) if i % 7 == 0 else i, text(r.randint(0, 9))) for i in range(150)]
    rows += [(None, None), (None, "a b c"), (500, ""), (501, "a " * 40000), (502, "B"), (502, "B")]
    target = [text(6) for _ in range(9)] + [None, ""]
    want, drawn = brute(rows, target, runs, buckets, 9, min_words, percent)
    docs = spark.createDataFrame([(k, x, "mine", 1.5) for k, x in rows], "doc_id long, text string, score string, other double")
    bench = spark.createDataFrame([(x,) for x in target], "text string")
    got = ranked(docs, bench, runs=runs, buckets=buckets, seed=9, min_words=min_words, percent=percent).collect()
    assert sorted(([x["doc_id"], x["n_words"], x["n_features"], x["weight"], x["score"]] for x in got), key=str) == sorted(want, key=str)
    by_rank = sorted((x for x in got if x["rank"] is not None), key=lambda x: x["rank"])
    assert [x["rank"] for x in by_rank] == list(range(1, len(drawn) + 1))
    assert [(x["score"], x["doc_id"]) for x in by_rank] == drawn
    assert {x["other"] for x in got} == {1.5}
    kept = draw(docs, bench, runs=runs, buckets=buckets, seed=9, min_words=min_words, percent=percent).collect()
    assert Counter((x["doc_id"], len(words(x["text"]))) for x in kept) == Counter((x["doc_id"], x["n_words"]) for x in by_rank)


@pytest.mark.parametrize("digit_bits,block_rows", [(7, 1), (12, 64), (20, None)])
def test_radix_passes(spark, digit_bits, block_rows):
    r = random.Random(digit_bits)
    rows = [(i * 5 + 1, r.choice([0, 3, 6, 2**20 + 5]), r.choice([0, 7, 2**15] if digit_bits == 7 else [-1, 0, 7, 2**63 - 1, -(2**63)])) for i in range(300)]
    r.shuffle(rows)
    table = materialize(spark.createDataFrame(rows, "pos long, hi long, lo long").repartition(5), "radix-test")
    got = {x["pos"]: x["rank"] for x in radix_ranks(table, ["hi", "lo"], digit_bits, block_rows).collect()}
    order = sorted(rows, key=lambda x: (x[1] % 2**64, x[2] % 2**64, x[0]))
    assert got == {x[0]: i + 1 for i, x in enumerate(order)}


def test_long_texts_in_pieces():
    r = random.Random(3)
    raw = " ".join(r.choice(["ab", "c", "dé", "e5"]) for _ in range(3000)).encode()
    data, at = np.frombuffer(raw, np.uint8), np.array([0, 0, 1001, len(raw)])
    for runs in (1, 3):
        whole, parts = [Counter() for _ in range(3)], [Counter() for _ in range(3)]
        for out, piece in ((whole, 1 << 30), (parts, 64)):
            for _, row, bucket in features(data, at, runs, 100, piece):
                for i, b in zip(row.tolist(), bucket.tolist()):
                    out[i][b] += 1
        assert whole == parts and sum(whole[2].values())


def test_equal_keys_and_empty_tables(spark):
    same = spark.createDataFrame([(1, "a b", 7)] * 9, "doc_id int, text string, rank int")
    bench = spark.createDataFrame([("a",)], "text string")
    got = ranked(same, bench, min_words=1, percent=50)
    assert sorted(x["rank"] or 0 for x in got.collect()) == [0] * 5 + [1, 2, 3, 4]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert ranked(none, bench).count() == 0
    assert {x["weight"] for x in ranked(same, spark.createDataFrame([], "text string"), min_words=1).collect()} != {None}
    with pytest.raises(ValueError):
        ranked(spark.createDataFrame([("x", "a")], "doc_id string, text string"), bench)


def test_query_against_sql(spark):
    agrees(spark, "op11_resampling", SF_SMALL)
    agrees(spark, "op11_resampling", SF_MID)
