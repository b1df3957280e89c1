"""Window operators (W1-W10) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import window as W
from ..sources import io as S
from ..tables import table
from . import as_double, register


@register("w01_running_total_by_user", """
SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS value_cumsum
FROM events""")
def w01u(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    r = W.running_total(ev, "value", ["ts", "event_id"], "user_id")
    return r.select("event_id", "user_id", F.round("value_cumsum", 2).alias("value_cumsum"))


@register("w01_running_total_global", """
SELECT o_orderkey, round(sum(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running
FROM orders""")
def w01g(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    r = W.running(o, ["o_orderdate", "o_orderkey"], {"running": ("sum", "o_totalprice")})
    return r.select("o_orderkey", F.round("running", 2).alias("running"))


@register("w02_group_total", """
SELECT o_orderkey, o_custkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey), 2) AS cust_total,
       count(*) OVER (PARTITION BY o_custkey) AS cust_orders
FROM orders""")
def w02(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    g = W.group_total(o, "o_custkey", {"cust_total": F.sum("o_totalprice"), "cust_orders": F.count(F.lit(1))})
    return g.select("o_orderkey", "o_custkey", F.round("cust_total", 2).alias("cust_total"), "cust_orders")


@register("w03_rank", """
SELECT l_orderkey, l_linenumber,
       rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS qty_rank,
       dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS qty_dense
FROM lineitem""")
def w03(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    r = W.running(li, [("l_quantity", False)], {"qty_rank": ("rank", None), "qty_dense": ("dense_rank", None)},
                  "l_returnflag")
    return r.select("l_orderkey", "l_linenumber", F.col("qty_rank").cast("bigint").alias("qty_rank"),
                    F.col("qty_dense").cast("bigint").alias("qty_dense"))


@register("w04_row_number", """
SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders""")
def w04(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    r = W.row_number(o, ["o_orderdate", "o_orderkey"], "o_custkey", out="rn")
    return r.select("o_orderkey", F.col("rn").cast("bigint").alias("rn"))


@register("w05_first_last_flags", """
SELECT conv_id, turn,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1 AS "first",
       row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1 AS "last"
FROM conversations""")
def w05(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn")
    return W.first_last_flags(c, "conv_id", ["turn"])


@register("w06_keep_first_per_group", """
SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT o_custkey, o_orderkey, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def w06(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return W.keep_first_per_group(o, "o_custkey", ["o_orderdate", "o_orderkey"])


@register("w06_keep_last_per_group", """
SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT o_custkey, o_orderkey, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""")
def w06l(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return W.keep_first_per_group(o, "o_custkey", ["o_orderdate", "o_orderkey"], last=True)


_EV_NULLS_SQL = """
SELECT event_id, user_id, ts, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v FROM events"""


def _ev_nulls(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", "user_id", "ts",
                     F.when(F.col("event_type") == "error", None).otherwise(F.col("value")).alias("v"))


@register("w07_retain", f"""
SELECT event_id,
       last(v IGNORE NULLS) OVER w AS last_v,
       max(v) OVER w AS max_v, min(v) OVER w AS min_v, count(v) OVER w AS n_v,
       round(sum(v) OVER w, 2) AS sum_v
FROM ({_EV_NULLS_SQL})
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def w07(spark, d):
    r = W.retain(_ev_nulls(spark, d), "user_id", ["ts", "event_id"], carry={"last_v": "v"}, maxs={"max_v": "v"},
                 mins={"min_v": "v"}, counts={"n_v": "v"}, sums={"sum_v": "v"})
    return r.select("event_id", "last_v", "max_v", "min_v", "n_v", F.round("sum_v", 2).alias("sum_v"))


@register("w08_lag_lead", """
SELECT event_id, lag(value, 1) OVER w AS value_lag1, lead(value, 2) OVER w AS value_lead2,
       CAST(lag(event_id, 1, -1) OVER w AS DOUBLE) AS prev_id
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def w08(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    out = W.shift_many(ev, [("value", 1, None, "value_lag1"), ("value", -2, None, "value_lead2"),
                            ("event_id", 1, -1, "prev_id")], ["ts", "event_id"], "user_id")
    return as_double(out.select("event_id", "value_lag1", "value_lead2", "prev_id"), "prev_id")


@register("w09_linear_recurrence", """
WITH RECURSIVE n AS (
  SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
r AS (SELECT user_id, rn, event_id, value AS x FROM n WHERE rn = 1
      UNION ALL
      SELECT n.user_id, n.rn, n.event_id, 0.9 * r.x + n.value FROM r JOIN n ON n.user_id = r.user_id AND n.rn = r.rn + 1)
SELECT event_id, round(x, 6) AS smooth FROM r""")
def w09(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", "ts", "value").withColumn("a", F.lit(0.9))
    r = W.linear_recurrence(ev, ["ts", "event_id"], "a", "value", "smooth", "user_id")
    return r.select("event_id", F.round("smooth", 6).alias("smooth"))


@register("w09_clamped_recurrence", """
WITH RECURSIVE n AS (
  SELECT user_id, event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value - 20 END AS delta,
         CASE WHEN event_type = 'error' THEN 0.5123456789 WHEN event_id % 7 = 0 THEN -0.2123456789 ELSE 1.0 END AS rate,
         CASE WHEN event_id % 3 > 0 THEN 60.0 + event_id % 5 END AS cap,
         row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('month', ts), event_id DESC) AS rn FROM events),
r AS (SELECT user_id, 0 AS rn, CAST(NULL AS BIGINT) AS event_id, CAST(10 AS DOUBLE) AS x FROM (SELECT DISTINCT user_id FROM n)
      UNION ALL
      SELECT n.user_id, n.rn, n.event_id,
             CASE WHEN n.delta IS NULL THEN r.x ELSE least(coalesce(n.cap, 1e300), greatest(0.0, n.rate * r.x + n.delta)) END
      FROM r JOIN n ON n.user_id = r.user_id AND n.rn = r.rn + 1)
SELECT event_id, round(x, 6) AS stock FROM r WHERE event_id IS NOT NULL""")
def w09_clamped(spark, d):
    """Stock that neither falls below zero nor above a cap; the first order column holds few values."""
    i = F.col("event_id")
    ev = table(spark, d, "events").select(
        "event_id", "user_id", F.date_trunc("month", "ts").alias("month"), (-i).alias("back"),
        F.when(i % 11 == 0, None).otherwise(F.col("value") - 20).alias("delta"),
        F.when(F.col("event_type") == "error", 0.5123456789).when(i % 7 == 0, -0.2123456789).otherwise(1.0).alias("rate"),
        F.when(i % 3 > 0, 60.0 + i % 5).alias("cap"))
    r = W.clamped_recurrence(ev, ["month", "back"], "rate", "delta", "stock", 0.0, "cap", "user_id", x0=10.0)
    return r.select("event_id", F.round("stock", 6).alias("stock"))


@register("w10_sql_window", """
WITH m AS (SELECT o_custkey, date_trunc('year', o_orderdate) AS yr, sum(o_totalprice) AS total
           FROM orders GROUP BY 1, 2)
SELECT o_custkey, yr, round(total, 2) AS total,
       round(total - lag(total) OVER (PARTITION BY o_custkey ORDER BY yr), 2) AS change,
       rank() OVER (PARTITION BY yr ORDER BY total DESC) AS yr_rank
FROM m""")
def w10(spark, d):
    return S.sql_step(spark, """
        WITH m AS (SELECT o_custkey, CAST(date_trunc('year', o_orderdate) AS TIMESTAMP_NTZ) AS yr,
                          sum(o_totalprice) AS total FROM ${orders} GROUP BY 1, 2)
        SELECT o_custkey, yr, round(total, 2) AS total,
               round(total - lag(total) OVER (PARTITION BY o_custkey ORDER BY yr), 2) AS change,
               CAST(rank() OVER (PARTITION BY yr ORDER BY total DESC) AS BIGINT) AS yr_rank
        FROM m""", views={"orders": table(spark, d, "orders")})
