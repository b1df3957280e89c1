from collections import defaultdict

from tessera.llm.op4_chat import rotate
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.sql import agrees

ROWS = [(1, 0, "system", "be <|kind|>"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, None, "é漢"), (1, 3, "ann", "x"), (1, 3, "ann", "x"), (1, None, "bob", "late")]
ROWS += [(None, 0, "ann", "alone"), (2, 0, "system", "nobody"), (3, 500, "ann", ""), (3, 5, "ann", "a")]


def test_against_a_plain_rendering(spark):
    check(spark, ROWS, 3)
    check(spark, ROWS, None)


def test_a_flood_of_turns_without_or_with_one_number(spark):
    flood = [(5, None, "ann" if i % 3 else "bob", f"t{i % 40}") for i in range(700)] + [(6, 2, "ann", "same")] * 300 + [(None, None, "eve", "same")] * 500
    check(spark, ROWS + flood, 16)


def check(spark, rows, size):
    frame = spark.createDataFrame([(*r, "m", 1) for r in rows], "conv_id long, turn int, role string, text string, masks string, speaker int").repartition(4)
    got = rotate(frame, segment_turns=size).collect()
    assert size is None or max(r["n_turns"] for r in got) <= size
    want = {}
    rows = [(c, t, (r or "unknown"), (x or "").replace("<|", "< |")) for c, t, r, x in rows]
    for conv, speaker in {(c, r) for c, _, r, _ in rows if r != "system"}:
        parts = defaultdict(list)
        seen = defaultdict(int)
        for c, t, r, x in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])):
            segment = 0 if size is None else None if t is None else t // size
            parts[segment, 0 if size is None else seen[segment] // size].append((r, x))
            seen[segment] += 1
        for segment, turns in parts.items():
            out, masks = "", []
            for r, x in turns:
                out += "<|assistant|>\n" if r == speaker else "<|system|>\n" if r == "system" else f"<|user name={r}|>\n"
                if r == speaker:
                    masks.append((len(out), len(out) + len(x) + 8))
                out += x + "<|end|>\n"
            want[conv, speaker, *segment] = (len(turns), len(masks), out, masks)
    assert {(r["conv_id"], r["speaker"], r["segment"], r["part"]): (r["n_turns"], r["n_spoken"], r["rendered"], [tuple(m) for m in r["masks"]]) for r in got} == want


def test_native_plan_and_empty_table(spark):
    frame = rotate(spark.createDataFrame([], "conv_id long, turn int, role string, text string"))
    assert frame.count() == 0
    flood = spark.createDataFrame([(1, None, "a", "x")] * 99, "conv_id long, turn int, role string, text string")
    plan = rotate(flood)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan
    assert "Python" not in frame._jdf.queryExecution().toString() and "Arrow" not in frame._jdf.queryExecution().toString()


def test_query_against_sql(spark):
    agrees(spark, "op4_chat", SF_SMALL)
    agrees(spark, "op4_chat", SF_MID)
