import random
import re

import numpy as np
import pytest

from tessera.llm.op10_ngram_join import bitmaps, components, groups, is_common, keep_one, signature
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.sql import agrees


def shingles(text, n):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set()


def brute(texts, n, percent):
    sets = [shingles(t, n) for t in texts]
    top = list(range(len(sets)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                top[root(i)] = root(j)
    return [len(s) for s in sets], [root(i) for i in range(len(sets))]


def near_copies(r, n_docs, edit):
    bases = [[r.choice("abcdefghijklmnop") + r.choice("xyz") for _ in range(r.choice([3, 12, 40, 90]))] for _ in range(5)]
    out = []
    for _ in range(n_docs):
        w = list(r.choice(bases))
        for _ in range(r.randint(0, edit)):
            w[r.randrange(len(w))] = r.choice(["q", "r", "s", "aX"])
        out.append((" ".join(w)).upper() if r.random() < 0.1 else " ".join(w))
    return out


@pytest.mark.parametrize("n,percent,common,crowd,edit", [(4, 85, 2, 3, 3), (5, 80, 64, 12, 4), (1, 60, 1, 2, 6), (2, 70, 1, 0, 9), (4, 51, 1, 100, 5)])
def test_against_brute_force(spark, n, percent, common, crowd, edit):
    r = random.Random(n * percent)
    texts = near_copies(r, 90, edit) + [None, "", " \n", "one", "ONE", "\x85 a", "tail\x1f"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, node string")
    sizes, roots = brute(texts, n, percent)
    least = {}
    for i, k in enumerate(roots):
        least.setdefault(k, i)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in groups(docs, n=n, percent=percent, common=common, crowd=crowd).collect()}
    assert got == {i: (sizes[i], least[roots[i]]) for i in range(len(texts))}
    kept = keep_one(docs, n=n, percent=percent, common=common, crowd=crowd).collect()
    assert sorted(x["doc_id"] for x in kept) == sorted(set(least.values()))
    assert all(texts[x["doc_id"]] == x["text"] for x in kept)


def test_null_and_repeated_keys(spark):
    rows = [(None, "a b c d e"), (None, "a b c d e"), (4, "a b c d e"), (4, "a b c d e"), (4, "other"), (None, "lonely"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(groups(docs).collect(), key=str)
    assert len(got) == len(rows)
    assert {(x["doc_id"], x["component_id"]) for x in got if x["n_shingles"] == 2} == {(None, 4), (4, 4)}
    assert sorted(x["text"] or "" for x in keep_one(docs).collect()) == ["", "a b c d e", "lonely", "other"]


@pytest.mark.parametrize("percent", [51, 60, 80, 85, 97])
def test_partners_share_a_signature(percent):
    r = np.random.default_rng(percent)
    universe = np.unique(r.integers(0, 1 << 63, 5000, dtype=np.uint64))
    for size in (2, 3, 5, 9, 31, 64, 300, 1500):
        for share in (0.0, 0.5, 1.0):
            common = np.sort(r.choice(universe, int(share * len(universe)), replace=False))
            x = np.sort(r.choice(universe, size, replace=False))
            others = np.setdiff1d(universe, x)
            for _ in range(20):
                drop = r.integers(0, size)
                y = np.sort(np.concatenate([r.choice(x, size - drop, replace=False), r.choice(others, r.integers(0, drop + 1), replace=False)]))
                same = len(np.intersect1d(x, y))
                if 100 * same >= percent * (len(x) + len(y) - same) and len(y) and not np.array_equal(x, y):
                    assert len(np.intersect1d(*(signature(v, is_common(v, common), percent) for v in (x, y))))
                    assert np.bitwise_count(np.bitwise_xor(*bitmaps(np.concatenate([x, y]), np.repeat([0, 1], [len(x), len(y)]), 2)).view(np.uint64)).sum() <= len(x) + len(y) - 2 * same


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert groups(docs).count() == 0 and keep_one(docs).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    r = random.Random(1)
    r.shuffle(edges)
    got = {x["node"]: x["comp"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(61)}) == 1 and len({got[1000 + i] for i in range(50)}) == 1 and got[0] != got[1000]


def test_query_against_sql(spark):
    agrees(spark, "op10_ngram_join", SF_SMALL)
    agrees(spark, "op10_ngram_join", SF_MID)
