"""The flagship plan: orders x customer, date-range filter, computed column,
group by market segment and month, running revenue per segment, sorted.

Uses S3, P9, P1, J1, A1, W1, O1, F1, F3, F8.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import formula as fx
from ..operators import joins, prepare, window
from ..tables import table

START = dt.datetime(1996, 1, 1)
END = dt.datetime(1999, 1, 1)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    # Date range with literal bounds -> pushed to the Parquet scan
    recent = prepare.filter_formula(orders, (F.col("o_orderdate") >= F.lit(START)) & (F.col("o_orderdate") < F.lit(END)))
    j = joins.join(recent, customer, [("o_custkey", "c_custkey")], "INNER")
    # Computed columns
    j = prepare.with_formulas(j, {
        "order_month": F.date_trunc("month", F.col("o_orderdate")).cast("timestamp_ntz"),
        "is_priority": fx.if_(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1, 0),
        "order_year": fx.date_part("o_orderdate", "year"),
    })
    g = j.groupBy("c_mktsegment", "order_month").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.round(F.sum("o_totalprice"), 2).alias("revenue"),
        F.sum("is_priority").cast("bigint").alias("n_priority"),
    )
    # W1 over the aggregated table (segments x months rows)
    r = window.running_total(g, "revenue", ["order_month"], ["c_mktsegment"], suffix="_running")
    r = r.withColumn("revenue_running", F.round("revenue_running", 2))
    return r.orderBy("c_mktsegment", "order_month")


FLAGSHIP_SQL = """
WITH j AS (
  SELECT c.c_mktsegment,
         date_trunc('month', o.o_orderdate) AS order_month,
         o.o_totalprice,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS is_priority
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderdate >= TIMESTAMP '1996-01-01' AND o.o_orderdate < TIMESTAMP '1999-01-01'
), g AS (
  SELECT c_mktsegment, order_month, count(*) AS n_orders,
         round(sum(o_totalprice), 2) AS revenue,
         CAST(sum(is_priority) AS BIGINT) AS n_priority
  FROM j GROUP BY c_mktsegment, order_month
)
SELECT c_mktsegment, order_month, n_orders, revenue, n_priority,
       round(sum(revenue) OVER (PARTITION BY c_mktsegment ORDER BY order_month
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS revenue_running
FROM g ORDER BY c_mktsegment, order_month
"""
