"""Joins (J1-J14) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..sources import io as S
from ..tables import table
from . import as_double, register


@register("j01_join_left", """
SELECT o_orderkey, o_custkey, CAST(c_custkey AS DOUBLE) AS c_custkey, c_name, c_mktsegment
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey""")
def j01l(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, d, "customer").filter("c_acctbal > 0").select("c_custkey", "c_name", "c_mktsegment")
    return as_double(J.join(o, c, [("o_custkey", "c_custkey")], "LEFT"), "c_custkey")


@register("j01_join_right", """
SELECT CAST(s_suppkey AS DOUBLE) AS s_suppkey, s_name, n_nationkey, n_name
FROM (SELECT * FROM supplier WHERE s_acctbal > 5000) s RIGHT JOIN nation ON s_nationkey = n_nationkey""")
def j01r(spark, d):
    s = table(spark, d, "supplier").filter("s_acctbal > 5000").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return as_double(J.join(s, n, [("s_nationkey", "n_nationkey")], "RIGHT").drop("s_nationkey"), "s_suppkey")


@register("j01_join_outer_multi_key", """
WITH a AS (SELECT c_nationkey AS nk, c_mktsegment AS seg, count(*) AS n_cust FROM customer GROUP BY 1, 2),
     b AS (SELECT s_nationkey AS nk2, 'BUILDING' AS seg2, count(*) AS n_supp FROM supplier GROUP BY 1)
SELECT CAST(nk AS DOUBLE) AS nk, seg, CAST(n_cust AS DOUBLE) AS n_cust, CAST(nk2 AS DOUBLE) AS nk2, seg2,
       CAST(n_supp AS DOUBLE) AS n_supp FROM a FULL OUTER JOIN b ON nk = nk2 AND seg = seg2""")
def j01o(spark, d):
    a = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nk"), F.col("c_mktsegment").alias("seg")).agg(
        F.count(F.lit(1)).alias("n_cust"))
    b = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("nk2")).agg(
        F.count(F.lit(1)).alias("n_supp")).withColumn("seg2", F.lit("BUILDING"))
    return as_double(J.join(a, b, [("nk", "nk2"), ("seg", "seg2")], "OUTER"), "nk", "n_cust", "nk2", "n_supp")


@register("j02_append_fields", """
SELECT o_orderkey, o_totalprice, t.n_all, t.max_all, o_totalprice / t.max_all AS share
FROM orders CROSS JOIN (SELECT count(*) AS n_all, max(o_totalprice) AS max_all FROM orders) t""")
def j02(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    t = o.agg(F.count(F.lit(1)).alias("n_all"), F.max("o_totalprice").alias("max_all"))
    return J.append_fields(o, t).withColumn("share", F.col("o_totalprice") / F.col("max_all"))


@register("j03_join_multiple", """
SELECT l_orderkey, l_linenumber, o_orderstatus, c_name, n_name, r_name
FROM lineitem
LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey""")
def j03(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, d, "region")
    res = J.join_multiple(li, [(o, [("l_orderkey", "o_orderkey")], "LEFT"), (c, [("o_custkey", "c_custkey")], "LEFT"),
                               (n, [("c_nationkey", "n_nationkey")], "LEFT"), (r, [("n_regionkey", "r_regionkey")], "LEFT")])
    return res.select("l_orderkey", "l_linenumber", "o_orderstatus", "c_name", "n_name", "r_name")


@register("j04_join_select_drop", """
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_custkey, c.c_name
FROM orders o INNER JOIN customer c ON o.o_custkey = c.c_custkey""")
def j04(spark, d):
    o = J.select_columns(table(spark, d, "orders"), "SELECT", ["o_orderkey", "o_custkey", "o_totalprice"])
    c = J.select_columns(table(spark, d, "customer"), "DROP", ["c_nationkey", "c_acctbal", "c_mktsegment"])
    return J.join(o, c, [("o_custkey", "c_custkey")], "INNER")


@register("j05_join_prefix", """
SELECT n.n_nationkey AS nat_n_nationkey, n.n_name AS nat_n_name, n.n_regionkey AS nat_n_regionkey,
       r.r_regionkey AS reg_r_regionkey, r.r_name AS reg_r_name
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")
def j05(spark, d):
    n = J.prefixed(table(spark, d, "nation"), "nat")
    r = J.prefixed(table(spark, d, "region"), "reg")
    return J.join(n, r, [("nat_n_regionkey", "reg_r_regionkey")], "INNER")


def _j6(spark, d):
    c = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name")
    o = table(spark, d, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    return J.join_three_way(c, o, [("c_custkey", "o_custkey")])


_J6C = "(SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING')"
_J6O = "(SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F')"


@register("j06_left_only", f"SELECT * FROM {_J6C} c WHERE NOT EXISTS (SELECT 1 FROM {_J6O} o WHERE o.o_custkey = c.c_custkey)")
def j06l(spark, d):
    return _j6(spark, d)[0]


@register("j06_joined", f"SELECT * FROM {_J6C} c JOIN {_J6O} o ON c.c_custkey = o.o_custkey")
def j06j(spark, d):
    return _j6(spark, d)[1]


@register("j06_right_only", f"SELECT * FROM {_J6O} o WHERE NOT EXISTS (SELECT 1 FROM {_J6C} c WHERE o.o_custkey = c.c_custkey)")
def j06r(spark, d):
    return _j6(spark, d)[2]


@register("j08_match_merge", """
WITH x AS (SELECT c_custkey AS k, c_name, c_acctbal FROM customer WHERE c_nationkey < 20),
     y AS (SELECT o_custkey AS k, round(sum(o_totalprice), 2) AS c_acctbal, count(*) AS n_orders
           FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
SELECT coalesce(x.k, y.k) AS k, x.c_name,
       CASE WHEN y.k IS NOT NULL THEN y.c_acctbal ELSE x.c_acctbal END AS c_acctbal,
       CAST(y.n_orders AS DOUBLE) AS n_orders, x.k IS NOT NULL AS in_x, y.k IS NOT NULL AS in_y
FROM x FULL OUTER JOIN y ON x.k = y.k""")
def j08(spark, d):
    x = table(spark, d, "customer").filter("c_nationkey < 20").select(F.col("c_custkey").alias("k"), "c_name", "c_acctbal")
    y = table(spark, d, "orders").filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("k")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("c_acctbal"), F.count(F.lit(1)).alias("n_orders"))
    return as_double(J.match_merge(x, y, "k", keep="all", in_x="in_x", in_y="in_y"), "n_orders")


@register("j08_match_merge_if_x", """
WITH x AS (SELECT c_custkey AS k, c_name, c_acctbal FROM customer WHERE c_nationkey < 20),
     y AS (SELECT o_custkey AS k, round(sum(o_totalprice), 2) AS c_acctbal, count(*) AS n_orders
           FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
SELECT x.k AS k, x.c_name, CASE WHEN y.k IS NOT NULL THEN y.c_acctbal ELSE x.c_acctbal END AS c_acctbal,
       CAST(y.n_orders AS DOUBLE) AS n_orders
FROM x LEFT JOIN y ON x.k = y.k""")
def j08x(spark, d):
    x = table(spark, d, "customer").filter("c_nationkey < 20").select(F.col("c_custkey").alias("k"), "c_name", "c_acctbal")
    y = table(spark, d, "orders").filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("k")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("c_acctbal"), F.count(F.lit(1)).alias("n_orders"))
    return as_double(J.match_merge(x, y, "k", keep="x"), "n_orders")


@register("j08_match_merge_positional", """
WITH x AS (SELECT c_nationkey AS k, c_custkey, c_acctbal AS v, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS p FROM customer WHERE c_nationkey % 7 <> 3),
     y AS (SELECT s_nationkey AS k, s_suppkey, s_acctbal AS v, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS p FROM supplier WHERE s_nationkey <> 5),
     z AS (SELECT n_nationkey AS k, n_name, 1 AS p FROM nation WHERE n_nationkey <> 9),
     n AS (SELECT k, (SELECT count(*) FROM x WHERE x.k = a.k) AS nx, (SELECT count(*) FROM y WHERE y.k = a.k) AS ny, (SELECT count(*) FROM z WHERE z.k = a.k) AS nz
           FROM (SELECT k FROM x UNION SELECT k FROM y UNION SELECT k FROM z) a),
     spine AS (SELECT n.*, unnest(range(1, greatest(nx, ny, nz) + 1)) AS p FROM n)
SELECT spine.k, CAST(c_custkey AS DOUBLE) AS c_custkey, CASE WHEN ny >= least(spine.p, greatest(nx, ny)) AND ny > 0 THEN y.v ELSE x.v END AS v,
       CAST(s_suppkey AS DOUBLE) AS s_suppkey, n_name, nx > 0 AS in_x, ny > 0 AS in_y, nz > 0 AS in_z
FROM spine LEFT JOIN x ON x.k = spine.k AND x.p = least(spine.p, nx) LEFT JOIN y ON y.k = spine.k AND y.p = least(spine.p, ny)
     LEFT JOIN z ON z.k = spine.k AND z.p = least(spine.p, nz)""")
def j08_positional(spark, d):
    """Three tables whose by values repeat, paired row by row."""
    k = lambda c: F.col(c).alias("k")
    x = table(spark, d, "customer").filter("c_nationkey % 7 <> 3").select(k("c_nationkey"), "c_custkey", F.col("c_acctbal").alias("v"))
    y = table(spark, d, "supplier").filter("s_nationkey <> 5").select(k("s_nationkey"), "s_suppkey", F.col("s_acctbal").alias("v"))
    z = table(spark, d, "nation").filter("n_nationkey <> 9").select(k("n_nationkey"), "n_name")
    merged = J.match_merge_by_position([(x, ["c_custkey"]), (y, [("v", False), "s_suppkey"]), (z, ["n_name"])], "k", ["in_x", "in_y", "in_z"])
    return as_double(merged, "c_custkey", "s_suppkey")


@register("j09_lookup_exact", """
WITH lk AS (SELECT n_nationkey AS k, n_name AS name, 1 AS ord FROM nation WHERE n_nationkey < 20
            UNION ALL SELECT n_nationkey, lower(n_name), 2 FROM nation),
     first AS (SELECT k, arg_min(name, ord) AS name FROM lk GROUP BY k)
SELECT c_custkey, c_nationkey, coalesce(first.name, 'UNKNOWN') AS name
FROM customer LEFT JOIN first ON c_nationkey = first.k""")
def j09(spark, d):
    n = table(spark, d, "nation")
    lk = n.filter("n_nationkey < 20").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), F.lit(1).alias("ord")) \
        .unionByName(n.select(F.col("n_nationkey").alias("k"), F.lower("n_name").alias("name"), F.lit(2).alias("ord")))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return J.lookup_exact(c, "c_nationkey", lk, "k", "name", "ord", default="UNKNOWN")


@register("j09_lookup_exact_default", """
SELECT c_custkey, coalesce(n.n_name, 'UNKNOWN') AS name
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON c_nationkey = n.n_nationkey""")
def j09d(spark, d):
    n = table(spark, d, "nation").filter("n_regionkey <> 2").select(F.col("n_nationkey"), F.col("n_name").alias("name"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return J.lookup_exact(c, "c_nationkey", n, "n_nationkey", "name", "n_nationkey", default="UNKNOWN").drop("c_nationkey")


@register("j10_asof_by_user", """
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
     v AS (SELECT user_id, ts, event_id AS view_id, value AS view_value FROM events WHERE event_type = 'view')
SELECT p.event_id, p.user_id, p.ts, CAST(v.view_id AS DOUBLE) AS view_id, v.view_value
FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def j10u(spark, d):
    ev = table(spark, d, "events")
    p = ev.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    v = ev.filter("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view_id"),
                                                F.col("value").alias("view_value"))
    return as_double(J.asof_lookup(p, "ts", v, "ts", ["view_id", "view_value"], by="user_id", tie_col="view_id"), "view_id")


@register("j10_asof_up", """
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
     v AS (SELECT user_id, ts, max(event_id) AS view_id FROM events WHERE event_type = 'view' GROUP BY 1, 2)
SELECT p.event_id, p.user_id, p.ts, CAST(v.view_id AS DOUBLE) AS view_id
FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts <= v.ts""")
def j10up(spark, d):
    ev = table(spark, d, "events")
    p = ev.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    v = ev.filter("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view_id"))
    return as_double(J.asof_lookup(p, "ts", v, "ts", "view_id", by="user_id", tie_col="view_id", direction="up"), "view_id")


@register("j10_asof_global", """
WITH p AS (SELECT event_id, ts FROM events WHERE event_type = 'purchase'),
     v AS (SELECT ts, event_id AS err_id FROM events WHERE event_type = 'error')
SELECT p.event_id, p.ts, CAST(v.err_id AS DOUBLE) AS err_id FROM p ASOF LEFT JOIN v ON p.ts >= v.ts""")
def j10g(spark, d):
    ev = table(spark, d, "events")
    p = ev.filter("event_type = 'purchase'").select("event_id", "ts")
    v = ev.filter("event_type = 'error'").select("ts", F.col("event_id").alias("err_id"))
    return as_double(J.asof_lookup(p, "ts", v, "ts", ["err_id"], tie_col="err_id"), "err_id")


@register("j11_hlookup", """
WITH wide AS (SELECT l_linestatus,
                     sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS "A",
                     sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS "N",
                     sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS "R"
              FROM lineitem GROUP BY l_linestatus),
     long AS (SELECT l_linestatus AS ls, hdr, val FROM wide UNPIVOT INCLUDE NULLS (val FOR hdr IN ("A", "N", "R")))
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, long.val AS value
FROM lineitem LEFT JOIN long ON l_returnflag = long.hdr AND l_linestatus = long.ls""")
def j11(spark, d):
    li = table(spark, d, "lineitem")
    wide = li.groupBy("l_linestatus").pivot("l_returnflag", ["A", "N", "R"]).agg(F.sum("l_quantity"))
    base = li.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return J.hlookup(base, "l_returnflag", wide, ["A", "N", "R"], [("l_linestatus", "l_linestatus")])


@register("j12_match_position", """
WITH b AS (SELECT DISTINCT p_brand FROM part),
     pos AS (SELECT p_brand AS b, row_number() OVER (ORDER BY p_brand) AS match FROM b)
SELECT p_partkey, p_brand, pos.match FROM part LEFT JOIN pos ON p_brand = pos.b""")
def j12m(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_brand")
    brands = p.select("p_brand").distinct().withColumnRenamed("p_brand", "brand")
    return J.lookup_position(p, "p_brand", brands, "brand", "brand", out="match")


@register("j12_index_value", """
WITH pos AS (SELECT r_name, row_number() OVER (ORDER BY r_name) AS p FROM region)
SELECT n_nationkey, n_regionkey, pos.r_name AS value FROM nation LEFT JOIN pos ON n_regionkey + 1 = pos.p""")
def j12i(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", "n_regionkey").withColumn("pos", F.col("n_regionkey") + 1)
    r = table(spark, d, "region")
    return J.value_at(n, "pos", r, "r_name", "r_name", out="value").drop("pos")


@register("j13_case_insensitive", """
WITH seg AS (SELECT DISTINCT lower(c_mktsegment) AS seg FROM customer)
SELECT c_custkey, c_mktsegment, seg FROM customer LEFT JOIN seg ON lower(c_mktsegment) = lower(seg)""")
def j13(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    seg = c.select(F.lower("c_mktsegment").alias("seg")).distinct()
    return J.join_case_insensitive(c, seg, "c_mktsegment", "seg", "LEFT")


@register("j14_sql_join", """
SELECT c.c_custkey, c.c_name, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_acctbal > 1000""")
def j14(spark, d):
    views = {"c": table(spark, d, "customer"), "n": table(spark, d, "nation")}
    return S.sql_step(spark, """
        SELECT c.c_custkey, c.c_name, n.n_name FROM ${c} c LEFT JOIN ${n} n ON c.c_nationkey = n.n_nationkey
        WHERE c.c_acctbal > :min_bal""", views=views, args={"min_bal": 1000})
