import random

import pytest

from tessera.llm.op3_decontaminate import WORD_BYTES, mark, remove_hits
from tests.conftest import SF_SMALL
from tests.llm.sql import agrees


def words(s):
    return (s or "").encode().translate(WORD_BYTES).decode().split()


def brute(text, items, window):
    w, hit, found, longest = words(text), set(), set(), 0
    for name, item in items:
        v = words(item)
        n = min(window, len(v))
        wins = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for p in range(len(w) - n + 1):
            if n and tuple(w[p : p + n]) in wins:
                hit |= set(range(p, p + n))
                found.add("null" if name is None else str(name))
    return len(w), len(hit), sorted(found), hit


@pytest.mark.parametrize("shard_bytes", [1 << 20, 150])
@pytest.mark.parametrize("window", [1, 3, 4])
def test_against_brute_force(spark, window, shard_bytes):
    r = random.Random(window)
    vocabulary = ["a", "b", "c", "D", "é", "x1"]
    text = lambda n: " ".join(r.choice(vocabulary) + r.choice(["", ",", "\n"]) for _ in range(n))
    items = [(i if i else None, text(r.choice([0, 1, 2, 3, 5, 9]))) for i in range(8 if window == 1 else 14)] + [(77, None), (78, "")]
    items.append(items[3])
    docs = [(i, text(r.randint(0, 40)), "mine") for i in range(40)] + [(90, None, "x"), (91, "", "x"), (3, "a b c", "x"), (None, "a b c d", None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, hit_items string")
    got = mark(frame, spark.createDataFrame(items, "item_id long, text string"), window, shard_bytes=shard_bytes)
    rows = got.collect()
    assert len(rows) == len(docs)
    for row in rows:
        n, n_hit, found, at = brute(row["text"], items, window)
        assert (row["n_words"], row["n_hit"], row["hit_items"]) == (n, n_hit, found), row
        spans = {k for s in row["hit_spans"] for k in range(s["first_word"], s["last_word"] + 1)}
        assert spans == at
    for row in remove_hits(got, max_coverage=0.5).collect():
        n, n_hit, _, at = brute(row["text"] if not row["n_hit"] else next(d[1] for d in docs if d[0] == row["doc_id"]), items, window)
        assert n_hit <= 0.5 * n
        original = next(d[1] for d in docs if (d[0], len(words(d[1]))) == (row["doc_id"], row["n_words"]))
        assert words(row["text"]) == [w for i, w in enumerate(words(original)) if i not in at]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert mark(none, items).count() == 0
    assert [r["n_hit"] for r in mark(some, items).collect()] == [0]


def test_query_against_sql(spark):
    agrees(spark, "op3_decontaminate", SF_SMALL)
