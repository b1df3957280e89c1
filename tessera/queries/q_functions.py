"""Formula functions (F1-F12) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import formula as fx
from ..tables import table
from . import register


@register("f01_arithmetic", """
SELECT l_orderkey, l_linenumber, l_extendedprice + l_tax AS a, l_extendedprice - l_tax AS s,
       l_quantity * l_discount AS m, CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity / l_discount END AS q
FROM lineitem""")
def f01(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", fx.add(F.col("l_extendedprice"), F.col("l_tax")).alias("a"),
                     fx.sub(F.col("l_extendedprice"), F.col("l_tax")).alias("s"),
                     fx.mul(F.col("l_quantity"), F.col("l_discount")).alias("m"),
                     fx.div(F.col("l_quantity"), F.col("l_discount")).alias("q"))


@register("f02_string_plus", """
SELECT c_custkey, c_name || '-' || (CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END) AS label FROM customer""")
def f02(spark, d):
    c = table(spark, d, "customer")
    seg = F.when(F.col("c_acctbal") < 0, None).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", fx.concat(F.col("c_name"), "-", seg).alias("label"))


@register("f03_if_nested", """
SELECT c_custkey,
       CASE WHEN c_acctbal > 5000 THEN (CASE WHEN c_nationkey < 10 THEN 'rich-a' ELSE 'rich-b' END)
            ELSE 'other' END AS cls,
       CASE WHEN (CASE WHEN c_nationkey = 3 THEN NULL ELSE c_nationkey > 12 END) THEN 'hi' ELSE 'lo' END AS unk
FROM customer""")
def f03(spark, d):
    c = table(spark, d, "customer")
    unknown = F.when(F.col("c_nationkey") == 3, None).otherwise(F.col("c_nationkey") > 12)
    return c.select("c_custkey",
                    fx.if_(F.col("c_acctbal") > 5000, fx.if_(F.col("c_nationkey") < 10, "rich-a", "rich-b"), "other").alias("cls"),
                    fx.if_(unknown, "hi", "lo").alias("unk"))


@register("f04_to_string", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR) AS s FROM orders")
def f04(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", F.concat(fx.to_string("o_custkey"), F.lit("/"), fx.to_string("o_orderkey")).alias("s"))


@register("f05_to_number", """
SELECT c_custkey, TRY_CAST(trim(CASE WHEN c_mktsegment = 'BUILDING' THEN 'x' || c_name
                                     ELSE ' ' || CAST(c_custkey AS VARCHAR) || ' ' END) AS DOUBLE) AS n
FROM customer""")
def f05(spark, d):
    c = table(spark, d, "customer")
    txt = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("x"), "c_name")).otherwise(
        F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit(" ")))
    return c.select("c_custkey", fx.to_number(txt).alias("n"))


@register("f06_length", "SELECT doc_id, length(text) AS n, n_chars FROM documents")
def f06(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", fx.length("text").alias("n"), "n_chars")


@register("f07_trim_upper_lower", """
SELECT p_partkey, trim('  ' || p_name || '  ') AS t, upper(p_name) AS u, lower(p_brand) AS l FROM part""")
def f07(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", fx.trim(F.concat(F.lit("  "), "p_name", F.lit("  "))).alias("t"),
                    fx.upper("p_name").alias("u"), fx.lower("p_brand").alias("l"))


@register("f08_date_part", """
SELECT event_id, year(ts) AS y, month(ts) AS mo, day(ts) AS dd, hour(ts) AS h, minute(ts) AS mi,
       second(ts) AS s, isodow(ts) AS dow FROM events""")
def f08(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", *[fx.date_part("ts", p).cast("bigint").alias(a) for p, a in
                                   [("year", "y"), ("month", "mo"), ("day", "dd"), ("hour", "h"), ("minute", "mi"),
                                    ("second", "s"), ("dayOfWeek", "dow")]])


@register("f09_blank", """
WITH b AS (SELECT p_partkey, CASE WHEN p_size < 10 THEN NULL WHEN p_size < 20 THEN '' ELSE p_brand END AS brand FROM part)
SELECT p_partkey, brand IS NULL OR brand = '' AS blank, NOT (brand IS NULL OR brand = '') AS not_blank FROM b""")
def f09(spark, d):
    p = table(spark, d, "part")
    brand = F.when(F.col("p_size") < 10, None).when(F.col("p_size") < 20, "").otherwise(F.col("p_brand"))
    return p.select("p_partkey", fx.is_blank(brand).alias("blank"), fx.is_not_blank(brand).alias("not_blank"))


@register("f10_coalesce", """
SELECT p_partkey, coalesce(CASE WHEN p_size < 10 THEN NULL ELSE p_brand END,
                           CASE WHEN p_size < 5 THEN NULL ELSE p_type END, 'none') AS v FROM part""")
def f10(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", fx.coalesce(F.when(F.col("p_size") < 10, None).otherwise(F.col("p_brand")),
                                             F.when(F.col("p_size") < 5, None).otherwise(F.col("p_type")),
                                             F.lit("none")).alias("v"))


@register("f11_boolean", """
WITH x AS (SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN NULL ELSE c_acctbal > 0 END AS a, c_nationkey < 10 AS b
           FROM customer)
SELECT c_custkey, a AND b AS a_and_b, a OR b AS a_or_b, NOT a AS not_a FROM x""")
def f11(spark, d):
    c = table(spark, d, "customer")
    a = F.when(F.col("c_nationkey") == 0, None).otherwise(F.col("c_acctbal") > 0)
    b = F.col("c_nationkey") < 10
    return c.select("c_custkey", fx.and_(a, b).alias("a_and_b"), fx.or_(a, b).alias("a_or_b"), fx.not_(a).alias("not_a"))


@register("f12_binning", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'neg' WHEN c_acctbal < 2500 THEN 'q1' WHEN c_acctbal < 5000 THEN 'q2'
                       WHEN c_acctbal < 7500 THEN 'q3' ELSE 'q4' END AS bin FROM customer""")
def f12(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", fx.bin_by_edges("c_acctbal", [0, 2500, 5000, 7500], ["neg", "q1", "q2", "q3", "q4"]).alias("bin"))
