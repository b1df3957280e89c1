import hashlib
import math
import random

import numpy as np
import pytest

from tessera.llm.op13_centroids import cluster, digests, encode, nearest
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.sql import agrees


def brute(rows, dims, scale, clusters, rounds, seed):
    kept = [(k, tuple(math.floor(scale * x) for x in v)) for k, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    h = lambda k: hashlib.sha256(f"{seed}:{k}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda x: (x[0] is None, h(x[0]), x[1]))[:clusters]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min((far(v, c), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        member = [near(v)[1] for _, v in kept]
        for c in range(len(centroids)):
            mine = [v for (_, v), m in zip(kept, member) if m == c]
            if mine:
                centroids[c] = tuple(sum(x) // len(mine) for x in zip(*mine))
    final = [(k, *near(v)[::-1]) for k, v in kept]
    sums = [sum(d for _, c, d in final if c == i) for i in range(len(centroids))]
    return sorted(((k, c, d, sums[c], sum(sums)) for k, c, d in final), key=str), centroids


@pytest.mark.parametrize("dims,scale,clusters,width,chunk", [(64, 64, 16, 2, 1 << 15), (5, 10, 4, 2, 7), (3, 1000, 40, 3, 1), (7, 64, 3, 1, 50)])
def test_against_brute_force(spark, dims, scale, clusters, width, chunk):
    r = random.Random(dims)
    vector = lambda: [r.choice([-1, 0, 1]) * r.random() for _ in range(dims)]
    rows = [(i, vector()) for i in range(120)]
    rows += [(i % 3, rows[0][1]) for i in range(60)] + [(None, vector()), (None, None), (7, rows[7][1])]
    odd = [[], [0.5] * (dims + 1), [0.5] * (dims - 1) + [None], [float("nan")] * dims, [0.25] * (dims - 1) + [float("-inf")], [-0.0] * dims]
    rows += [(1000 + i, v) for i, v in enumerate(odd)]
    rows = [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for k, v in rows]
    table = spark.createDataFrame([(k, v, "x") for k, v in rows], "vec_id long, embedding array<float>, cluster string").repartition(4)
    got, centroids = cluster(table, dims=dims, scale=scale, clusters=clusters, rounds=3, width=width, chunk=chunk)
    want, final = brute(rows, dims, scale, clusters, 3, 1)
    assert sorted((tuple(x) for x in got.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia").collect()), key=str) == want
    assert centroids.tolist() == [list(c) for c in final]
    assert digests(centroids) == [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in final]


@pytest.mark.parametrize("width", [1, 2, 3, 64])
def test_dictionaries_lose_nothing(width):
    r = np.random.default_rng(width)
    for high in (2, 40, 1 << 26):
        x = r.integers(-high, high, (90, 64))
        books, codes = encode(x, width)
        assert np.array_equal(np.concatenate([b[c] for b, c in zip(books, codes)], axis=1), x)
        assert all(len(np.unique(b, axis=0)) == len(b) for b in books)
        c = r.integers(-high, high, (5, 64))
        far = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        at, distance = nearest(books, codes, c)
        assert np.array_equal(at, far.argmin(axis=1)) and np.array_equal(distance, far.min(axis=1))


def test_few_vectors_and_limits(spark):
    kind = "vec_id long, embedding array<double>"
    got, centroids = cluster(spark.createDataFrame([(1, [0.5, 1.0]), (2, None)], kind), dims=2)
    assert [tuple(x) for x in got.collect()] == [(1, 0, 0, 0, 0)] and centroids.tolist() == [[32, 64]]
    got, centroids = cluster(spark.createDataFrame([], kind), dims=2)
    assert got.count() == 0 and len(digests(centroids)) == 0
    with pytest.raises(Exception, match="zero"):
        cluster(spark.createDataFrame([(1, [1e300, 0.0])], kind), dims=2)[0].count()


def test_query_against_sql(spark):
    agrees(spark, "op13_centroids", SF_SMALL)
    agrees(spark, "op13_centroids", SF_MID)
