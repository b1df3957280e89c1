"""Semantic unit tests on small inline tables (FIXTURES.md section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions import blank as B
from tessera.functions import excel as X
from tessera.functions import formula as fx
from tessera.operators import joins as J
from tessera.operators import prepare as P
from tessera.operators import quality as Q
from tessera.operators import window as W


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy(cols[0]).collect()]


@pytest.fixture
def blanks(spark):
    data = [(1, None, None), (2, "", ""), (3, " ", " "), (4, "12", "12"), (5, "abc", "abc"), (6, "1e3", "1e3"),
            (7, " 7 ", " 7 ")]
    return spark.createDataFrame(data, "id bigint, s string, n string")


def test_blank_and_to_number(blanks):
    out = blanks.select("id", B.is_blank("s").alias("b"), B.to_number("n").alias("x"))
    assert rows(out, "id", "b", "x") == [(1, True, None), (2, True, None), (3, False, None), (4, False, 12.0),
                                         (5, False, None), (6, False, 1000.0), (7, False, 7.0)]


def test_fill_empty_vs_fillna(blanks):
    a = P.fill_empty(blanks, ["s"], "X")
    b = P.fillna(blanks, "X", subset=["s"])
    assert [r.s for r in a.orderBy("id").collect()][:3] == ["X", "X", " "]
    assert [r.s for r in b.orderBy("id").collect()][:3] == ["X", "", " "]


@pytest.fixture
def filter3(spark):
    data = [(1, "A", 1.0), (2, "B", None), (3, None, 3.0), (4, None, None), (5, "A", -1.0)]
    return spark.createDataFrame(data, "id bigint, status string, x double")


def test_filter_keep_remove_nulls(filter3):
    keep = P.filter_on_value(filter3, "status", ["A"], "KEEP")
    rem = P.filter_on_value(filter3, "status", ["A"], "REMOVE")
    assert sorted(r.id for r in keep.collect()) == [1, 5]
    assert sorted(r.id for r in rem.collect()) == [2, 3, 4]
    t, f = P.filter_split(filter3, F.col("x") > 0)
    assert sorted(r.id for r in t.collect()) == [1, 3]
    assert sorted(r.id for r in f.collect()) == [2, 4, 5]
    removed = P.filter_formula(filter3, F.col("x") > 0, "REMOVE")
    assert sorted(r.id for r in removed.collect()) == [2, 4, 5]


def test_split_column_parts(spark):
    df = spark.createDataFrame([(1, "a.b"), (2, "a.b.c"), (3, "a.b.c.d"), (4, "a..c"), (5, None)], "id bigint, s string")
    out = P.split_column(df, "s", ".", out_columns=["p1", "p2", "p3"])
    assert rows(out, "id", "p1", "p2", "p3") == [
        (1, "a", "b", None), (2, "a", "b", "c"), (3, "a", "b", "c.d"), (4, "a", "", "c"), (5, None, None, None)]
    pipe = spark.createDataFrame([(1, "x|y")], "id bigint, s string")
    assert P.split_column(pipe, "s", "|", prefix="c", limit=2).first()["c_2"] == "y"
    out2 = P.split_column(df, "s", ".", out_columns=["p1", "p2", "p3"], empty_as_null=True)
    assert rows(out2, "id", "p2")[3] == (4, None)


def test_split_to_rows_keeps_null_row(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "id bigint, s string")
    out = P.split_to_rows(df, "s", " ", out="w")
    assert sorted((r.id, r.w) for r in out.collect()) == [(1, "a"), (1, "b"), (2, None)]


def test_dates_parse_and_excel(spark):
    df = spark.createDataFrame([(1, "2024-02-29", "yyyy-MM-dd"), (2, "2023-02-29", "yyyy-MM-dd"),
                                (3, "31/01/2024", "dd/MM/yyyy"), (4, "20240131", "yyyyMMdd")],
                               "id bigint, s string, fmt string")
    parsed = [P.parse_date(df.filter(F.col("id") == i), "s", f, out="d", as_date=True).first()["d"]
              for i, f in [(1, "yyyy-MM-dd"), (2, "yyyy-MM-dd"), (3, "dd/MM/yyyy"), (4, "yyyyMMdd")]]
    assert parsed == [dt.date(2024, 2, 29), None, dt.date(2024, 1, 31), dt.date(2024, 1, 31)]
    one = spark.range(1)
    r = one.select(X.DATE(2024, 14, 1).alias("a"), X.DATE(2024, 1, 0).alias("b"),
                   X.EOMONTH(F.lit(dt.date(2024, 1, 31)), 1).alias("c"), X.EDATE(F.lit(dt.date(2024, 1, 31)), 1).alias("d"),
                   X.DATEDIF(F.lit(dt.date(2024, 1, 31)), F.lit(dt.date(2024, 2, 29)), "M").alias("e"),
                   X.DATEDIF(F.lit(dt.date(2020, 2, 29)), F.lit(dt.date(2024, 2, 28)), "Y").alias("f"),
                   X.WEEKDAY(F.lit(dt.date(2024, 6, 3)), 2).alias("g"), fx.date_part(F.lit(dt.date(2024, 6, 3)), "dayOfWeek").alias("h"),
                   X.DATEDIF(F.lit(dt.date(2024, 3, 1)), F.lit(dt.date(2024, 2, 1)), "D").alias("i")).first()
    assert r["a"] == dt.date(2025, 2, 1) and r["b"] == dt.date(2023, 12, 31)
    assert r["c"] == dt.date(2024, 2, 29) and r["d"] == dt.date(2024, 2, 29)
    assert r["e"] == 0 and r["f"] == 3 and r["g"] == 1 and r["h"] == 1 and r["i"] is None


def test_networkdays_matches_brute_force(spark):
    import random

    rnd = random.Random(5)
    hol = [dt.date(2024, 1, 1), dt.date(2024, 12, 25), dt.date(2023, 12, 25)]
    pairs = []
    for _ in range(200):
        a = dt.date(2023, 1, 1) + dt.timedelta(days=rnd.randint(0, 700))
        b = a + dt.timedelta(days=rnd.randint(-60, 60))
        pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a date, b date")
    got = [r.n for r in df.select(X.NETWORKDAYS("a", "b", hol).alias("n")).collect()]

    def brute(a, b):
        lo, hi = min(a, b), max(a, b)
        n = sum(1 for k in range((hi - lo).days + 1) if (lo + dt.timedelta(k)).weekday() < 5
                and (lo + dt.timedelta(k)) not in hol)
        return n if a <= b else -n

    assert got == [brute(a, b) for a, b in pairs]


def test_excel_text_and_math(spark):
    r = spark.range(1).select(
        X.TRIM(F.lit("  a   b  ")).alias("t"), X.PROPER(F.lit("hello wORLD-foo o'neil")).alias("p"),
        X.SUBSTITUTE(F.lit("a.b.c.d"), ".", "|", instance=2).alias("s"), X.FIND("b", F.lit("abcb"), 3).alias("f"),
        X.SEARCH("B", F.lit("xyz")).alias("sr"), X.INT(F.lit(-1.5)).alias("i"), X.MOD(F.lit(-7), F.lit(3)).alias("m"),
        X.MOD(F.lit(7), F.lit(-3)).alias("m2"), X.ROUNDDOWN(F.lit(0.29), 2).alias("rd"), X.ROUNDUP(F.lit(-1.21), 1).alias("ru"),
        X.SQRT(F.lit(-1.0)).alias("sq"), X.LN(F.lit(-1.0)).alias("ln"), X.ROUND(F.lit(2.5), 0).alias("r")).first()
    assert r["t"] == "a b" and r["p"] == "Hello World-Foo O'Neil" and r["s"] == "a.b|c.d"
    assert r["f"] == 4 and r["sr"] is None and r["i"] == -2 and r["m"] == 2.0 and r["m2"] == -2.0
    assert r["rd"] == 0.29 and r["ru"] == -1.3 and r["sq"] is None and r["ln"] is None and r["r"] == 3.0


@pytest.fixture
def merge_pair(spark):
    left = spark.createDataFrame([(1, "l1", "x"), (2, "l2", "y"), (None, "ln", "z")], "k bigint, v string, only_l string")
    right = spark.createDataFrame([(2, "r2", "p"), (3, "r3", "q"), (None, "rn", "s")], "k bigint, v string, only_r string")
    return left, right


def test_match_merge(merge_pair):
    x, y = merge_pair
    out = J.match_merge(x, y, "k", keep="all", in_x="in_x", in_y="in_y")
    got = sorted([(r.k if r.k is not None else -1, r.v, r.only_l, r.only_r, r.in_x, r.in_y) for r in out.collect()])
    assert got == [(-1, "rn", "z", "s", True, True), (1, "l1", "x", None, True, False),
                   (2, "r2", "y", "p", True, True), (3, "r3", None, "q", False, True)]
    dup_x = x.unionByName(x.filter("k = 2"))
    dup_y = y.unionByName(y.filter("k = 2"))
    with pytest.raises(ValueError):
        J.match_merge(dup_x, dup_y, "k")
    assert J.match_merge(dup_x, y, "k").count() == 5


def test_asof_lookup_edges(spark):
    data = spark.createDataFrame([(1, 0.5), (2, 1.0), (3, 2.5), (4, 10.0), (5, None)], "id bigint, x double")
    lk = spark.createDataFrame([(1.0, "a", 1), (1.0, "a2", 2), (2.0, "b", 1), (3.0, "c", 1)], "k double, v string, ord int")
    out = J.asof_lookup(data, "x", lk, "k", "v", tie_col="ord")
    assert rows(out, "id", "v") == [(1, None), (2, "a2"), (3, "b"), (4, "c"), (5, None)]


@pytest.fixture
def ordered(spark):
    data = [("g1", 1, 1.0), ("g1", 2, None), ("g1", 2, 3.0), ("g1", 3, 4.0), ("g2", 1, None), ("g3", 5, 2.0)]
    return spark.createDataFrame(data, "g string, ord int, x double")


def test_running_blocked_equals_plain(ordered):
    aggs = {"s": ("sum", "x"), "c": ("count", "x"), "mx": ("max", "x"), "lst": ("last", "x"), "rk": ("rank", None),
            "dr": ("dense_rank", None), "n": ("group_count", None)}
    plain = W.running(ordered, ["ord"], {k: v for k, v in aggs.items() if k != "lst"}, "g", blocks=1)
    blocked = W.running(ordered, ["ord"], {k: v for k, v in aggs.items() if k != "lst"}, "g", splits=[1.5, 2.5])
    key = lambda r: (r.g, r.ord, r.x if r.x is not None else -1)
    a = sorted((key(r), r.s, r.c, r.mx, r.rk, r.dr, r.n) for r in plain.collect())
    b = sorted((key(r), r.s, r.c, r.mx, r.rk, r.dr, r.n) for r in blocked.collect())
    assert a == b
    g2 = [r for r in blocked.collect() if r.g == "g2"][0]
    assert g2.s is None and g2.c == 0 and g2.n == 1


def test_hot_group_blocked_scan(spark):
    # one key holds a third of the rows
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("g"),
                                     F.col("id").alias("t"), (F.col("id") % 7).cast("double").alias("x"))
    plain = W.running(df, ["t"], {"s": ("sum", "x"), "rn": ("row_number", None), "l": ("last", "x")}, "g", blocks=1)
    blocked = W.running(df, ["t"], {"s": ("sum", "x"), "rn": ("row_number", None), "l": ("last", "x")}, "g", blocks=16)
    a = sorted((r.t, r.s, r.rn, r.l) for r in plain.collect())
    b = sorted((r.t, r.s, r.rn, r.l) for r in blocked.collect())
    assert a == b
    plan = blocked._jdf.queryExecution().executedPlan().toString()
    assert "__blk" in plan


def test_record_id_contiguous(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"))
    ids = sorted(r.rid for r in W.record_id(df, "rid", ["k"], start=10, blocks=8).collect())
    assert ids == list(range(10, 5010))


def test_linear_recurrence_matches_loop(spark):
    data = [(g, t, 0.5 + (t % 3) * 0.1, float(t % 5)) for g in ("a", "b") for t in range(200)]
    df = spark.createDataFrame(data, "g string, t int, a double, b double")
    out = W.linear_recurrence(df, ["t"], "a", "b", "x", "g", x0=1.0, blocks=6)
    got = {(r.g, r.t): r.x for r in out.collect()}
    for g in ("a", "b"):
        x = 1.0
        for t in range(200):
            x = (0.5 + (t % 3) * 0.1) * x + float(t % 5)
            assert abs(got[(g, t)] - x) < 1e-9


def test_unpivot_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, None, "a"), (2, None, 2.0, None)], "id bigint, a double, b double, c string")
    out = P.unpivot(df, ["id"], ["a", "b", "c"])
    assert out.count() == 6
    assert dict(out.dtypes)["Value"] == "string"


def test_meanings(spark):
    df = spark.createDataFrame([("Café",), ("cafe",), (" CAFÉ ",), ("tea",), (None,)], "code string")
    for mode, valid in (("EXACT", 1), ("LOWERCASE", 1), ("NORMALIZED", 3)):
        r = Q.meaning_counts(df, "code", Q.values_meaning("code", ["Café"], mode)).first()
        assert (r.valid, r.invalid, r.empty) == (valid, 4 - valid, 1), mode


def test_reconcile(spark):
    e = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    p = spark.createDataFrame([(2, "B"), (3, None), (4, "d")], "k int, v string")
    got = sorted((r.k, r.status, r.diff_columns) for r in Q.reconcile(e, p, "k").collect())
    assert got == [(1, "missing", ""), (2, "changed", "v"), (3, "same", ""), (4, "extra", "")]


def test_nan_and_null_keys_blocked(spark):
    vals = [(i, float(i % 9)) for i in range(60)] + [(100, float("nan")), (101, None), (102, float("nan"))]
    df = spark.createDataFrame(vals, "id int, k double")
    for asc in (True, False):
        spec = [("k", asc), ("id", True)]
        plain = W.running(df, spec, {"rn": ("row_number", None)}, blocks=1)
        blocked = W.running(df, spec, {"rn": ("row_number", None)}, splits=[2.0, 4.0, 6.0])
        assert sorted((r.id, r.rn) for r in plain.collect()) == sorted((r.id, r.rn) for r in blocked.collect())


def test_search_wildcards(spark):
    r = spark.range(1).select(
        X.SEARCH("b?d", F.lit("abcBxd")).alias("a"), X.SEARCH("c*x", F.lit("abcBxd")).alias("b"),
        X.SEARCH("~?", F.lit("what? yes")).alias("c"), X.SEARCH("B", F.lit("abcb"), 3).alias("d"),
        X.SEARCH("z*", F.lit("abc")).alias("e"), X.SEARCH("(", F.lit("f(x)")).alias("f")).first()
    assert (r.a, r.b, r.c, r.d, r.e, r.f) == (4, 3, 5, 4, None, 2)


def test_last_non_null_both_directions(spark):
    vals = [(g, t, None if (t * 7 + g) % 3 == 0 else float(t)) for g in range(3) for t in range(40)]
    df = spark.createDataFrame(vals, "g int, t int, x double")
    for asc in (True, False):
        spec = [("t", asc)]
        aggs = {"l": ("last", "x"), "s": ("sum", "x"), "dr": ("dense_rank", None)}
        plain = W.running(df, spec, aggs, "g", blocks=1)
        blocked = W.running(df, spec, aggs, "g", splits=[9.5, 20.5, 31.5] if asc else [-31.5, -20.5, -9.5])
        key = lambda r: (r.g, r.t, r.l, r.s, r.dr)
        assert sorted(map(key, plain.collect())) == sorted(map(key, blocked.collect())), asc


def test_many_splits_use_jvm_binary_search(spark):
    vals = [(i, float(i % 700)) for i in range(2000)] + [(5000, float("nan")), (5001, None)]
    df = spark.createDataFrame(vals, "id int, k double")
    for asc in (True, False):
        spec = [("k", asc), ("id", True)]
        splits = [float(v) + 0.5 for v in range(0, 600, 2)]  # 300 split points
        if not asc:
            splits = sorted(-s for s in splits)
        plain = W.running(df, spec, {"rn": ("row_number", None), "s": ("sum", "k")}, blocks=1)
        blocked = W.running(df, spec, {"rn": ("row_number", None), "s": ("sum", "k")}, splits=splits)
        key = lambda r: (r.id, r.rn)
        assert sorted(map(key, plain.collect())) == sorted(map(key, blocked.collect())), asc
