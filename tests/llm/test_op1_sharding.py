import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from tessera.llm.op1_sharding import Capacities, best_fit, equal_shards, shard_by_bytes
from tessera.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def test_tree_stays_shallow_for_bins_in_order():
    def depth(n):
        return 1 + max(depth(n[2]), depth(n[3])) if n else 0

    tree = Capacities()
    for i in range(20_000):
        tree.add(i, i)
    assert depth(tree.root) < 60


def test_tree_of_capacities_equals_a_sorted_list():
    r, tree, plain = random.Random(4), Capacities(), []
    for i in range(3000):
        if r.random() < 0.6:
            plain.append((r.randint(0, 50), i))
            tree.add(*plain[-1])
        else:
            need = r.randint(0, 55)
            want = min((x for x in plain if x[0] >= need), default=None)
            assert tree.take_tightest(need) == want
            if want:
                plain.remove(want)


def test_best_fit_equals_one_group_at_a_time():
    r = random.Random(8)
    for _ in range(60):
        sizes = [r.randint(1, 40) for _ in range(r.randint(1, 80))]
        capacity = r.randint(20, 60)
        bins = []
        for s in sorted(sizes, reverse=True):
            fits = [(left, i) for i, left in enumerate(bins) if left >= s]
            if fits:
                bins[min(fits)[1]] -= s
            else:
                bins.append(max(capacity, s) - s)
        counts = sorted({s: sizes.count(s) for s in sizes}.items(), reverse=True)
        plan = best_fit(counts, capacity)
        used = defaultdict(int)
        for s, a, b, k in plan:
            used[k] += s * (b - a + 1)
        assert len(used) == len(bins) and sum(used.values()) == sum(sizes)
        assert all(v <= max(capacity, max(sizes)) for v in used.values())


def test_shards_are_equal_beside_a_huge_group():
    counts = [(1_000_000, 1), *((s, 30) for s in range(50, 400))]
    used = defaultdict(int)
    for s, a, b, k in equal_shards(counts, 16):
        used[k] += s * (b - a + 1)
    small = sorted(used.values())[:-1]
    assert len(used) == 16 and max(small) - min(small) <= 400


def test_odd_rows(spark):
    rows = [(None, None, "x"), (1, "", "x"), (1, "", "x"), (2, "é" * 50, "y"), (3, "a" * 9000, "y"), (4, "a" * 9000, "z")]
    rows += [(10 + i, f"text {i % 40} " * (i % 7), "t") for i in range(300)]
    got = shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string, shard string"), 4).collect()
    assert len(got) == len(rows)
    assert sorted((r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == sorted((i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    text = {i: t or "" for i, t, _ in rows}
    home, slots = defaultdict(set), defaultdict(list)
    for r in got:
        home[text[r["doc_id"]]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert all(len(s) == 1 for s in home.values()) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_fixed_capacity(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 37)) for i in range(400)], "doc_id long, text string")
    used = {r["shard"]: r["n"] for r in shard_by_bytes(docs, capacity=500).groupBy("shard").agg({"size": "sum"}).withColumnRenamed("sum(size)", "n").collect()}
    assert sum(used.values()) == sum(i % 37 + 1 for i in range(400)) and set(used) == set(range(len(used))) and max(used.values()) <= 500


def test_empty_table(spark):
    assert shard_by_bytes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_shards(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = QUERIES["op1_sharding"](spark, SF_SMALL).collect()
    total, home, slots = defaultdict(int), defaultdict(set), defaultdict(list)
    for r in got:
        assert r["size"] == len(docs[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(docs[r["doc_id"]].encode())
        total[r["shard"]] += r["size"]
        home[docs[r["doc_id"]]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert len(got) == len(docs) and set(total) == set(range(16)) and all(len(s) == 1 for s in home.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all((r["law"], r["grown_shard"]) == ("bytes", None) for r in got)
    largest = max(defaultdict(int, {t: 0 for t in docs.values()}), key=len)
    assert max(total.values()) - min(total.values()) <= 2 * len(largest.encode())


def test_documents_equal_packing_one_group_at_a_time(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    total = defaultdict(int)
    for r in docs.collect():
        total[r["text"] or ""] += len((r["text"] or "").encode()) + 1
    capacity, bins = 60_000, []
    for size in sorted(total.values(), reverse=True):
        fits = [(capacity - sum(b), i) for i, b in enumerate(bins) if capacity - sum(b) >= size]
        if fits:
            bins[min(fits)[1]].append(size)
        else:
            bins.append([size])
    got = defaultdict(lambda: defaultdict(int))
    for r in shard_by_bytes(docs.select("doc_id", "text", F.md5("text").alias("m")), capacity=capacity).collect():
        got[r["shard"]][r["m"]] += r["size"]
    assert sorted(sorted(b.values(), reverse=True) for b in got.values()) == sorted(bins)


def test_a_third_of_identical_rows_is_spread(spark):
    rows = spark.range(9000).selectExpr("IF(id % 3 = 0, -1, id) AS doc_id", "IF(id % 3 = 0, 'same', concat('text ', id)) AS text")
    got = shard_by_bytes(rows, 4).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert len(got) == 9000 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    same = sorted(r["slot"] for r in got if r["doc_id"] == -1)
    runs = sum(b != a + 1 for a, b in zip(same, same[1:]))  # in one bucket they would be one run
    assert len(same) == 3000 and len({r["shard"] for r in got if r["doc_id"] == -1}) == 1
    assert len(set(slots)) == 4 and (runs > 10 or len(slots[next(r["shard"] for r in got if r["doc_id"] == -1)]) == 3000)
