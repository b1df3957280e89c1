"""Aggregations (A1-A19) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..sources import io as S
from ..tables import table
from . import register


@register("a01_group", """
SELECT l_returnflag, l_linestatus,
       round(sum(l_quantity), 2) AS l_quantity_sum, round(avg(l_quantity), 6) AS l_quantity_avg,
       min(l_quantity) AS l_quantity_min, max(l_quantity) AS l_quantity_max,
       count(l_quantity) AS l_quantity_count, count(DISTINCT l_quantity) AS l_quantity_distinct,
       round(stddev_samp(l_quantity), 6) AS l_quantity_std,
       round(sum(l_extendedprice), 2) AS l_extendedprice_sum, count(DISTINCT l_suppkey) AS l_suppkey_distinct,
       count(*) AS count
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def a01(spark, d):
    li = table(spark, d, "lineitem")
    g = A.group(li, ["l_returnflag", "l_linestatus"], {
        "l_quantity": ["sum", "avg", "min", "max", "count", "countDistinct", "stddev"],
        "l_extendedprice": ["sum"], "l_suppkey": ["countDistinct"]}, global_count=True)
    return g.withColumns({
        "l_quantity_sum": F.round("l_quantity_sum", 2), "l_quantity_avg": F.round("l_quantity_avg", 6),
        "l_quantity_std": F.round("l_quantity_std", 6), "l_extendedprice_sum": F.round("l_extendedprice_sum", 2)})


@register("a02_count_only", "SELECT c_mktsegment, count(*) AS count FROM customer GROUP BY c_mktsegment")
def a02(spark, d):
    return A.group(table(spark, d, "customer"), "c_mktsegment", {}, global_count=True)


@register("a03_first_last", """
SELECT o_custkey,
       first(o_orderstatus ORDER BY o_orderdate, o_orderkey) AS o_orderstatus_first,
       last(o_orderstatus ORDER BY o_orderdate, o_orderkey) AS o_orderstatus_last,
       first(o_totalprice ORDER BY o_orderdate, o_orderkey) AS o_totalprice_first
FROM orders GROUP BY o_custkey""")
def a03(spark, d):
    o = table(spark, d, "orders")
    return A.group(o, "o_custkey", {"o_orderstatus": ["first", "last"], "o_totalprice": ["first"]},
                   order_by=["o_orderdate", "o_orderkey"])


@register("a04_concat", """
SELECT conv_id, array_to_string(list_sort(list(role || ':' || turn)), '|') AS turns_concat,
       array_to_string(list_sort(list_distinct(list(role))), '|') AS role_concat
FROM conversations GROUP BY conv_id""")
def a04(spark, d):
    c = table(spark, d, "conversations").withColumn("turns", F.concat("role", F.lit(":"), F.col("turn").cast("string")))
    a = A.group(c, "conv_id", {"turns": ["concat"]}, concat_sep="|")
    b = A.group(c, "conv_id", {"role": ["concat"]}, concat_sep="|", concat_distinct=True)
    return a.join(b, "conv_id")


@register("a05_summarize", """
SELECT l_returnflag AS flag, round(sum(l_quantity), 2) AS qty, count(DISTINCT l_suppkey) AS suppliers,
       round(sum(DISTINCT l_tax), 6) AS distinct_tax_sum, count(l_orderkey) AS n,
       first(l_orderkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS first_order,
       last(l_orderkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS last_order,
       round(stddev_samp(l_discount), 6) AS sd_disc
FROM lineitem GROUP BY l_returnflag""")
def a05(spark, d):
    li = table(spark, d, "lineitem")
    s = A.summarize(li, [
        {"field": "l_returnflag", "action": "GroupBy", "rename": "flag"},
        {"field": "l_quantity", "action": "Sum", "rename": "qty"},
        {"field": "l_suppkey", "action": "CountDistinct", "rename": "suppliers"},
        {"field": "l_tax", "action": "Sum_Distinct", "rename": "distinct_tax_sum"},
        {"field": "l_orderkey", "action": "Count", "rename": "n"},
        {"field": "l_orderkey", "action": "First", "rename": "first_order"},
        {"field": "l_orderkey", "action": "Last", "rename": "last_order"},
        {"field": "l_discount", "action": "StdDev", "rename": "sd_disc"},
    ], order_by=["l_shipdate", "l_orderkey", "l_linenumber"])
    return s.withColumns({"qty": F.round("qty", 2), "distinct_tax_sum": F.round("distinct_tax_sum", 6),
                          "sd_disc": F.round("sd_disc", 6)})


@register("a07_pandas_agg", """
SELECT o_orderstatus, round(sum(o_totalprice), 2) AS o_totalprice_sum, round(avg(o_totalprice), 6) AS o_totalprice_mean,
       max(o_totalprice) AS o_totalprice_max, count(DISTINCT o_custkey) AS o_custkey_nunique, count(*) AS o_custkey_size
FROM orders GROUP BY o_orderstatus""")
def a07(spark, d):
    o = table(spark, d, "orders")
    g = A.agg(o, "o_orderstatus", {"o_totalprice": ["sum", "mean", "max"], "o_custkey": ["nunique", "size"]})
    return g.withColumns({"o_totalprice_sum": F.round("o_totalprice_sum", 2),
                          "o_totalprice_mean": F.round("o_totalprice_mean", 6)})


@register("a08_conditional", """
SELECT c_mktsegment,
       round(sum(CASE WHEN c_acctbal > 0 THEN c_acctbal END), 2) AS sumif_pos,
       CAST(count_if(c_nationkey < 10 AND c_acctbal > 1000) AS BIGINT) AS countifs,
       round(avg(CASE WHEN c_nationkey >= 10 THEN c_acctbal END), 6) AS avgif,
       max(CASE WHEN c_nationkey < 5 THEN c_acctbal END) AS maxifs,
       min(CASE WHEN c_nationkey < 5 THEN c_acctbal END) AS minifs
FROM customer GROUP BY c_mktsegment""")
def a08(spark, d):
    c = table(spark, d, "customer")
    return c.groupBy("c_mktsegment").agg(
        F.round(A.SUMIF("c_acctbal", F.col("c_acctbal") > 0), 2).alias("sumif_pos"),
        A.COUNTIFS(F.col("c_nationkey") < 10, F.col("c_acctbal") > 1000).alias("countifs"),
        F.round(A.AVERAGEIF("c_acctbal", F.col("c_nationkey") >= 10), 6).alias("avgif"),
        A.MAXIFS("c_acctbal", F.col("c_nationkey") < 5).alias("maxifs"),
        A.MINIFS("c_acctbal", F.col("c_nationkey") < 5).alias("minifs"),
    )


@register("a09_pivot", """
SELECT l_returnflag,
       round(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity END), 2) AS "F",
       round(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END), 2) AS "O"
FROM lineitem GROUP BY l_returnflag""")
def a09(spark, d):
    p = A.pivot(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus", "l_quantity", "sum", ["F", "O"])
    return p.withColumns({"F": F.round("F", 2), "O": F.round("O", 2)})


@register("a09_pivot_count", """
SELECT o_orderpriority,
       count(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS "F",
       count(CASE WHEN o_orderstatus = 'O' THEN o_orderkey END) AS "O",
       count(CASE WHEN o_orderstatus = 'P' THEN o_orderkey END) AS "P"
FROM orders GROUP BY o_orderpriority""")
def a09c(spark, d):
    return A.pivot(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", "o_orderkey", "count", ["F", "O", "P"])


@register("a10_tabulate", """
SELECT c_mktsegment,
       count(CASE WHEN c_acctbal >= 0 THEN c_acctbal END) AS pos_n,
       round(sum(CASE WHEN c_acctbal >= 0 THEN c_acctbal END), 2) AS pos_sum,
       round(avg(CASE WHEN c_acctbal >= 0 THEN c_acctbal END), 6) AS pos_mean,
       count(CASE WHEN c_acctbal < 0 THEN c_acctbal END) AS neg_n,
       round(sum(CASE WHEN c_acctbal < 0 THEN c_acctbal END), 2) AS neg_sum,
       round(avg(CASE WHEN c_acctbal < 0 THEN c_acctbal END), 6) AS neg_mean
FROM customer GROUP BY c_mktsegment""")
def a10(spark, d):
    c = table(spark, d, "customer").withColumn("sign", F.when(F.col("c_acctbal") >= 0, "pos").otherwise("neg"))
    t = A.tabulate(c, "c_mktsegment", "sign", "c_acctbal", ["pos", "neg"])
    return t.withColumns({k: F.round(k, 2 if k.endswith("sum") else 6) for k in t.columns if k.endswith(("sum", "mean"))})


@register("a11_range_aggregates", """
WITH m AS (
  SELECT c_mktsegment, c_acctbal,
         CASE WHEN c_nationkey < 5 THEN 'n/a' WHEN c_nationkey < 8 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS txt
  FROM customer)
SELECT c_mktsegment, round(sum(c_acctbal), 2) AS s, round(avg(c_acctbal), 6) AS a, min(c_acctbal) AS mn,
       max(c_acctbal) AS mx, count(TRY_CAST(trim(txt) AS DOUBLE)) AS n_numbers,
       CAST(count_if(txt IS NOT NULL AND txt <> '') AS BIGINT) AS n_nonblank,
       round(median(c_acctbal), 6) AS med, round(stddev_samp(c_acctbal), 6) AS sd, round(var_samp(c_acctbal), 4) AS var
FROM m GROUP BY c_mktsegment""")
def a11(spark, d):
    c = table(spark, d, "customer").withColumn(
        "txt", F.when(F.col("c_nationkey") < 5, "n/a").when(F.col("c_nationkey") < 8, "")
        .otherwise(F.col("c_nationkey").cast("string")))
    return c.groupBy("c_mktsegment").agg(
        F.round(F.sum("c_acctbal"), 2).alias("s"), F.round(F.avg("c_acctbal"), 6).alias("a"),
        F.min("c_acctbal").alias("mn"), F.max("c_acctbal").alias("mx"),
        A.COUNT("txt").alias("n_numbers"), A.COUNTA("txt").alias("n_nonblank"),
        F.round(A.MEDIAN("c_acctbal"), 6).alias("med"), F.round(A.STDEV("c_acctbal"), 6).alias("sd"),
        F.round(A.VAR("c_acctbal"), 4).alias("var"))


@register("a12_totals", """
SELECT CASE WHEN GROUPING(c_mktsegment) = 1 THEN 'Total' ELSE c_mktsegment END AS c_mktsegment,
       CASE WHEN GROUPING(o_orderstatus) = 1 THEN 'Total' ELSE o_orderstatus END AS o_orderstatus,
       count(*) AS n, round(sum(o_totalprice), 2) AS revenue,
       CAST(GROUPING(c_mktsegment, o_orderstatus) AS BIGINT) AS _level
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY ROLLUP (c_mktsegment, o_orderstatus)""")
def a12(spark, d):
    j = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    t = A.with_totals(j, ["c_mktsegment", "o_orderstatus"],
                      {"n": F.count(F.lit(1)), "revenue": F.sum("o_totalprice")})
    return t.withColumns({"revenue": F.round("revenue", 2), "_level": F.col("_level").cast("bigint")})


@register("a13_freq_one_way", """
WITH f AS (SELECT o_orderpriority, count(*) AS frequency FROM orders GROUP BY 1)
SELECT o_orderpriority, frequency, round(frequency * 100.0 / sum(frequency) OVER (), 6) AS percent,
       CAST(sum(frequency) OVER (ORDER BY o_orderpriority) AS BIGINT) AS cum_frequency,
       round(sum(frequency) OVER (ORDER BY o_orderpriority) * 100.0 / sum(frequency) OVER (), 6) AS cum_percent
FROM f""")
def a13(spark, d):
    f = A.freq_one_way(table(spark, d, "orders"), "o_orderpriority")
    return f.withColumns({"percent": F.round("percent", 6), "cum_percent": F.round("cum_percent", 6),
                          "cum_frequency": F.col("cum_frequency").cast("bigint")})


@register("a14_freq_two_way", """
WITH f AS (SELECT quality, toxic, count(*) AS frequency FROM labels GROUP BY 1, 2)
SELECT quality, toxic, frequency,
       round(frequency * 100.0 / sum(frequency) OVER (), 6) AS percent,
       round(frequency * 100.0 / sum(frequency) OVER (PARTITION BY quality), 6) AS row_percent,
       round(frequency * 100.0 / sum(frequency) OVER (PARTITION BY toxic), 6) AS col_percent
FROM f""")
def a14(spark, d):
    f = A.freq_two_way(table(spark, d, "labels"), "quality", "toxic")
    return f.withColumns({c: F.round(c, 6) for c in ("percent", "row_percent", "col_percent")})


@register("a15_means", """
WITH x AS (SELECT l_returnflag, CASE WHEN l_linestatus = 'O' AND l_quantity > 45 THEN NULL ELSE l_quantity END AS q
           FROM lineitem)
SELECT l_returnflag, count(q) AS n, CAST(count_if(q IS NULL) AS BIGINT) AS nmiss, round(avg(q), 6) AS mean,
       round(stddev_samp(q), 6) AS std, min(q) AS min, max(q) AS max, round(sum(q), 2) AS sum
FROM x GROUP BY l_returnflag""")
def a15(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_returnflag", F.when((F.col("l_linestatus") == "O") & (F.col("l_quantity") > 45), None)
        .otherwise(F.col("l_quantity")).alias("q"))
    m = A.means(li, "q", "l_returnflag")
    return m.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6), "sum": F.round("sum", 2)})


@register("a16_univariate", """
WITH m AS (SELECT c_mktsegment, count(c_acctbal) AS n, avg(c_acctbal) AS mean FROM customer GROUP BY 1),
s AS (SELECT c.c_mktsegment, any_value(m.n) AS n, any_value(m.mean) AS mean,
             sum(power(c_acctbal - m.mean, 2)) AS m2, sum(power(c_acctbal - m.mean, 3)) AS m3,
             sum(power(c_acctbal - m.mean, 4)) AS m4
      FROM customer c JOIN m ON c.c_mktsegment = m.c_mktsegment GROUP BY 1),
mo AS (SELECT c_mktsegment, arg_min(c_acctbal, struct_pack(a := -cnt, b := c_acctbal)) AS mode
       FROM (SELECT c_mktsegment, c_acctbal, count(*) AS cnt FROM customer GROUP BY 1, 2) GROUP BY 1),
q AS (SELECT c_mktsegment, min(c_acctbal) AS min, max(c_acctbal) AS max, max(c_acctbal) - min(c_acctbal) AS range,
             quantile_cont(c_acctbal, 0.25) AS p25, quantile_cont(c_acctbal, 0.5) AS p50,
             quantile_cont(c_acctbal, 0.75) AS p75 FROM customer GROUP BY 1)
SELECT q.c_mktsegment, q.min, q.max, round(q.range, 6) AS range, s.n, round(s.mean, 6) AS mean,
       round(sqrt(m2 / (n - 1)), 6) AS std,
       round(n * 1.0 / ((n - 1) * (n - 2)) * m3 / power(m2 / (n - 1), 1.5), 6) AS skewness,
       round(n * (n + 1) * 1.0 / ((n - 1) * (n - 2) * (n - 3)) * m4 / power(m2 / (n - 1), 2)
             - 3.0 * power(n - 1, 2) / ((n - 2) * (n - 3)), 6) AS kurtosis,
       mo.mode, round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75
FROM q JOIN s ON q.c_mktsegment = s.c_mktsegment JOIN mo ON q.c_mktsegment = mo.c_mktsegment""")
def a16(spark, d):
    u = A.univariate(table(spark, d, "customer"), "c_acctbal", "c_mktsegment")
    return u.withColumns({c: F.round(c, 6) for c in ("range", "mean", "std", "skewness", "kurtosis", "p25", "p50", "p75")})


@register("a17_sql_aggregate", """
SELECT o_orderpriority, count(*) AS n,
       CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_finished,
       round(avg(o_totalprice), 6) AS avg_price
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY o_orderpriority HAVING count(*) > 10
ORDER BY n DESC""")
def a17(spark, d):
    q = S.sql_step(spark, """
        SELECT o_orderpriority, count(*) AS n,
               CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_finished,
               round(avg(o_totalprice), 6) AS avg_price
        FROM ${orders} WHERE o_orderdate >= CAST(${start} AS TIMESTAMP_NTZ)
        GROUP BY o_orderpriority HAVING count(*) > 10 ORDER BY n DESC""",
                   views={"orders": table(spark, d, "orders")}, variables={"start": "1997-01-01"})
    return q


@register("a18_sumproduct", """
SELECT l_returnflag, round(sum(l_quantity * l_extendedprice), 2) AS sumproduct FROM lineitem GROUP BY 1""")
def a18(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.round(A.SUMPRODUCT("l_quantity", "l_extendedprice"), 2).alias("sumproduct"))


@register("a19_describe")
def a19(spark, d):
    return A.describe(table(spark, d, "orders"))


def _describe_sql(cols):
    parts = []
    for c, t in cols:
        parts.append(f"""SELECT '{c}' AS "column", '{t}' AS type, count({c}) AS count,
       CAST(count_if({c} IS NULL) AS BIGINT) AS nulls, count(DISTINCT {c}) AS distinct_approx,
       CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max FROM orders""")
    return "\nUNION ALL\n".join(parts)


@register("a19_describe_exact", _describe_sql([("o_orderkey", "bigint"), ("o_custkey", "bigint"),
                                               ("o_orderstatus", "string"), ("o_orderpriority", "string")]))
def a19e(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return A.describe(o, exact=True)


@register("a12_subtotal_functions", """
SELECT o_orderstatus, round(avg(o_totalprice), 6) AS f1, count(o_totalprice) AS f2, max(o_totalprice) AS f4,
       min(o_totalprice) AS f5, round(stddev_samp(o_totalprice), 6) AS f7, round(sum(o_totalprice), 2) AS f9
FROM orders GROUP BY o_orderstatus""")
def a12s(spark, d):
    o = table(spark, d, "orders")
    return o.groupBy("o_orderstatus").agg(
        F.round(A.subtotal(1, "o_totalprice"), 6).alias("f1"), A.subtotal(2, "o_totalprice").alias("f2"),
        A.subtotal(4, "o_totalprice").alias("f4"), A.subtotal(5, "o_totalprice").alias("f5"),
        F.round(A.subtotal(7, "o_totalprice"), 6).alias("f7"), F.round(A.subtotal(109, "o_totalprice"), 2).alias("f9"))


