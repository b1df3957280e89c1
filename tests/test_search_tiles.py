"""Vector search scores tile by tile; MMR picks for many queries at once."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import search as V


def units(n, dim, seed):
    m = np.random.default_rng(seed).standard_normal((n, dim))
    return m / np.linalg.norm(m, axis=1)[:, None]


@pytest.mark.parametrize("k,threshold", [(5, None), (20, 0.1), (7000, None)])
def test_tiles_equal_brute_force(k, threshold):
    """Ties over many tiles, vectors that are not finite, fewer results than ``k``."""
    q, d = units(300, 16, 1), units(6000, 16, 2)
    d[100:5000] = d[100]
    q[7], q[5], d[17] = d[100], np.nan, np.nan
    s = q @ d.T
    got = {}
    for row, doc, _ in zip(*V._best_of_tiles(q, d, k, threshold)):
        got.setdefault(row, []).append(doc)
    for i in range(0, 300, 7 if k > 20 else 1):
        some = np.flatnonzero(np.isfinite(s[i]) & (s[i] >= (-2 if threshold is None else threshold)))
        want = some[np.lexsort((some, -np.round(s[i, some], 9)))][:k]
        assert got.get(i, []) == want.tolist(), i


def test_a_task_holds_tiles_not_all_scores():
    """4,000 x 5,000 vectors: all scores are 160 MB, and sorting them took 800 MB."""
    q, d = units(4000, 8, 1), units(5000, 8, 2)
    tracemalloc.start()
    V._best_of_tiles(q, d, 20, None)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6


def test_blocks_bound_the_vectors_of_a_task():
    for n, dim in ((600_000, 64), (600_000, 1000), (10_000_000, 64)):
        bq, bd = V._blocks(n, n, 200, dim)
        assert n / bq * dim * 8 <= 1.01 * V.MAX_BLOCK_BYTES and n / bd * dim * 8 <= 1.01 * V.MAX_BLOCK_BYTES
        assert n / bq * n / bd <= 1.01 * V.MAX_BLOCK_CELLS


def test_mmr_over_pools_cut_by_batches(spark):
    """Pools that go on in the next Arrow batch, ties and a pool smaller than k."""
    m = units(60, 4, 3).round(1)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, v array<float>")
    q, d = df.withColumnRenamed("id", "q"), df.withColumnRenamed("id", "d")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        for docs, k in ((d, 5), (d.where(F.col("d") < 3), 5)):
            got = {}
            for r in V.mmr_search(q, docs, "q", "v", "d", "v", k=k, pool=20, diversity=0.4).orderBy("q", "mmr_rank").collect():
                got.setdefault(r["q"], []).append(r["d"])
            pools = {}
            for r in V.similarity_search(q, docs, "q", "v", "d", "v", k=20).collect():
                pools.setdefault(r["q"], {})[r["d"]] = r["score"]
            x = m.astype("float32").astype("float64")
            x /= np.linalg.norm(x, axis=1)[:, None]
            assert got.keys() == pools.keys() and len(got) == 60
            for i, pool in pools.items():
                want, left = [], set(pool)
                while left and len(want) < k:
                    val = {c: round(0.6 * pool[c] - 0.4 * max([x[c] @ x[w] for w in want], default=0.0), 9) for c in left}
                    want.append(min(left, key=lambda c: (-val[c], c)))
                    left.remove(want[-1])
                assert got[i] == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
