"""Sort, top-k, sample, distinct, unique (O1-O6) and stacking."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ordering as O
from ..operators import setops as U
from ..tables import table
from . import register


@register("o01_sort", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC")
def o01(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return O.sort(o, ["o_orderpriority", ("o_totalprice", False)])


@register("o02_limit")
def o02(spark, d):
    return O.limit(table(spark, d, "lineitem"), 100)


@register("o03_top_k", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def o03(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return O.top_k(o, [("o_totalprice", False), "o_orderkey"], 10)


@register("o04_sample_fraction")
def o04f(spark, d):
    return O.sample_fraction(table(spark, d, "lineitem"), 0.1, ["l_orderkey", "l_linenumber"], seed=7)


@register("o04_sample_first_n", """
SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 25""")
def o04n(spark, d):
    return O.sample_first(table(spark, d, "events").select("event_id", "ts"), 25, ["ts", "event_id"])


@register("o04_sample_per_group", """
SELECT o_custkey, o_orderkey FROM (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) WHERE rn <= 3""")
def o04g(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return O.sample_per_group(o, "o_custkey", 3, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@register("o05_distinct_keys", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def o05k(spark, d):
    return O.distinct(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


@register("o05_distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem")
def o05r(spark, d):
    return O.distinct(table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity"))


_UNIQ = """
SELECT o_custkey, o_orderkey, o_orderdate,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders"""


@register("o06_unique", f"SELECT o_custkey, o_orderkey, o_orderdate FROM ({_UNIQ}) WHERE rn = 1")
def o06u(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return O.unique(o, "o_custkey", ["o_orderdate", "o_orderkey"])[0]


@register("o06_duplicates", f"SELECT o_custkey, o_orderkey, o_orderdate FROM ({_UNIQ}) WHERE rn > 1")
def o06d(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return O.unique(o, "o_custkey", ["o_orderdate", "o_orderkey"])[1]


@register("o06_drop_duplicates_rows", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def o06p(spark, d):
    return O.drop_duplicates(table(spark, d, "orders").select("o_custkey", "o_orderstatus"))


@register("u01_stack_by_name", """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS bal, c_mktsegment AS segment FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def u01(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                          F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("bal"),
                                          F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"),
                                          F.col("s_acctbal").alias("bal"), F.col("s_nationkey").alias("nation"))
    return U.stack([c, s])


@register("u02_stack_by_position", """
SELECT n_nationkey AS k, n_name AS name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region""")
def u02(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    r = table(spark, d, "region").select("r_regionkey", "r_name")
    return U.stack_by_position([n, r])


@register("u03_stack_with_origin", """
SELECT o_orderkey, o_totalprice, 'finished' AS source FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_totalprice, 'pending' FROM orders WHERE o_orderstatus = 'P'""")
def u03(spark, d):
    o = table(spark, d, "orders")
    f = o.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    p = o.filter("o_orderstatus = 'P'").select("o_orderkey", "o_totalprice")
    return U.stack_with_origin({"finished": f, "pending": p})


@register("s12_append", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_orderstatus, NULL FROM orders WHERE o_orderstatus = 'O'""")
def s12(spark, d):
    o = table(spark, d, "orders")
    base = o.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.filter("o_orderstatus = 'O'").select("o_orderstatus", "o_orderkey", "o_custkey")
    return U.append(base, new, force=True)
