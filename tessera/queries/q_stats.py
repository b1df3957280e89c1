"""Statistical procedures (T1-T10) on the driver tables.

Oracle queries compare the statistics and degrees of freedom; p-values are
checked in unit tests against known distribution values.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from ..operators import stats as T
from ..tables import table
from . import register


@register("t01_chi_square", """
WITH c AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*) AS o FROM lineitem GROUP BY 1, 2),
r AS (SELECT a, sum(o) AS ra FROM c GROUP BY a), k AS (SELECT b, sum(o) AS cb FROM c GROUP BY b),
t AS (SELECT sum(o) AS n, count(DISTINCT a) AS nr, count(DISTINCT b) AS nc FROM c)
SELECT round(sum(o * o * n / (ra * cb)) - any_value(n), 9) AS chi2, CAST((any_value(nr) - 1) * (any_value(nc) - 1) AS BIGINT) AS df
FROM c JOIN r USING (a) JOIN k USING (b), t""")
def t01(spark, d):
    r = T.chi_square(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus", p_value=False)
    return r.select(F.round("chi2", 9).alias("chi2"), F.col("df").cast("bigint").alias("df"))


@register("t02_fisher_exact", """
WITH c AS (SELECT CAST(count_if(quality = 1 AND toxic = 1) AS BIGINT) AS n11, CAST(count_if(quality = 1 AND toxic <> 1) AS BIGINT) AS n12,
                  CAST(count_if(quality <> 1 AND toxic = 1) AS BIGINT) AS n21, CAST(count_if(quality <> 1 AND toxic <> 1) AS BIGINT) AS n22
           FROM labels),
m AS (SELECT *, n11 + n12 AS r1, n21 + n22 AS r2, n11 + n21 AS c1, n11 + n12 + n21 + n22 AS n FROM c),
terms AS (SELECT m.*, k, lgamma(r1 + 1) - lgamma(k + 1) - lgamma(r1 - k + 1)
                        + lgamma(r2 + 1) - lgamma(c1 - k + 1) - lgamma(r2 - c1 + k + 1)
                        - lgamma(n + 1) + lgamma(c1 + 1) + lgamma(n - c1 + 1) AS lp
          FROM m, generate_series(greatest(0, c1 - r2), least(r1, c1)) g(k)),
obs AS (SELECT lp AS lpo FROM terms WHERE k = n11)
SELECT any_value(n11) AS n11, any_value(n12) AS n12, any_value(n21) AS n21, any_value(n22) AS n22,
       round(least(sum(CASE WHEN lp <= lpo + 1e-7 THEN exp(lp) END) / sum(exp(lp)), 1.0), 9) AS p_value
FROM terms, obs""")
def t02(spark, d):
    r = T.fisher_exact_2x2(table(spark, d, "labels"), "quality", "toxic")
    return r.select(*[F.col(c).cast("bigint").alias(c) for c in ("n11", "n12", "n21", "n22")],
                    F.round("p_value", 9).alias("p_value"))


_Z = NormalDist().inv_cdf(0.975)


@register("t03_means_ci", f"""
SELECT o_orderstatus, count(o_totalprice) AS n, round(avg(o_totalprice), 6) AS mean, round(stddev_samp(o_totalprice), 6) AS std,
       round(avg(o_totalprice) - {_Z!r} * stddev_samp(o_totalprice) / sqrt(count(o_totalprice)), 6) AS lower,
       round(avg(o_totalprice) + {_Z!r} * stddev_samp(o_totalprice) / sqrt(count(o_totalprice)), 6) AS upper
FROM orders GROUP BY o_orderstatus""")
def t03(spark, d):
    r = T.means_ci(table(spark, d, "orders"), "o_totalprice", "o_orderstatus", 0.95)
    return r.withColumns({c: F.round(c, 6) for c in ("mean", "std", "lower", "upper")})


@register("t04_ttest_one_sample", """
SELECT l_returnflag, count(l_quantity) AS n,
       round((avg(l_quantity) - 25) / (stddev_samp(l_quantity) / sqrt(count(l_quantity))), 9) AS t,
       CAST(count(l_quantity) - 1 AS DOUBLE) AS df
FROM lineitem GROUP BY l_returnflag""")
def t04a(spark, d):
    r = T.ttest_one_sample(table(spark, d, "lineitem"), "l_quantity", 25.0, "l_returnflag")
    return r.select("l_returnflag", "n", F.round("t", 9).alias("t"), "df")


@register("t04_ttest_two_sample", """
WITH s AS (SELECT count(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS n1,
                  count(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS n2,
                  avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS m1,
                  avg(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS m2,
                  var_samp(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS v1,
                  var_samp(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS v2
           FROM orders WHERE o_orderstatus IN ('F', 'O'))
SELECT 'pooled' AS method, round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)), 9) AS t,
       CAST(n1 + n2 - 2 AS DOUBLE) AS df FROM s
UNION ALL
SELECT 'satterthwaite', round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 9),
       round(power(v1 / n1 + v2 / n2, 2) / (power(v1 / n1, 2) / (n1 - 1) + power(v2 / n2, 2) / (n2 - 1)), 6) FROM s""")
def t04b(spark, d):
    r = T.ttest_two_sample(table(spark, d, "orders"), "o_totalprice", "o_orderstatus", "F", "O")
    return r.select("method", F.round("t", 9).alias("t"),
                    F.when(F.col("method") == "pooled", F.col("df")).otherwise(F.round("df", 6)).alias("df"))


@register("t04_ttest_paired", """
SELECT count(d) AS n, round(avg(d) / (stddev_samp(d) / sqrt(count(d))), 9) AS t, CAST(count(d) - 1 AS DOUBLE) AS df
FROM (SELECT l_tax - l_discount AS d FROM lineitem)""")
def t04c(spark, d):
    r = T.ttest_paired(table(spark, d, "lineitem"), "l_tax", "l_discount")
    return r.select("n", F.round("t", 9).alias("t"), "df")


@register("t05_anova", """
WITH g AS (SELECT o_orderpriority, count(o_totalprice) AS n, sum(o_totalprice) AS s, sum(o_totalprice * o_totalprice) AS ss
           FROM orders GROUP BY 1),
t AS (SELECT sum(n) AS nn, sum(s) AS S, sum(ss) AS SS, count(*) AS k, sum(s * s / n) AS A FROM g)
SELECT CAST(k - 1 AS DOUBLE) AS df_between, CAST(nn - k AS DOUBLE) AS df_within,
       round(((A - S * S / nn) / (k - 1)) / ((SS - A) / (nn - k)), 6) AS f,
       round((A - S * S / nn) / (SS - S * S / nn), 9) AS eta_sq
FROM t""")
def t05(spark, d):
    r = T.anova_one_way(table(spark, d, "orders"), "o_totalprice", "o_orderpriority")
    return r.select("df_between", "df_within", F.round("f", 6).alias("f"),
                    F.round(F.col("ss_between") / (F.col("ss_between") + F.col("ss_within")), 9).alias("eta_sq"))


@register("t06_linear_regression", """
SELECT round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
       round(regr_slope(l_extendedprice, l_quantity), 6) AS slope FROM lineitem""")
def t06(spark, d):
    li = table(spark, d, "lineitem")
    m = T.linear_regression(li, "l_extendedprice", ["l_quantity"])
    (_, b0), (_, b1) = T.coefficients(m, ["l_quantity"])
    # the fitted model is a few numbers; expose them as a one-row frame
    return spark.range(1).select(F.round(F.lit(b0), 4).alias("intercept"), F.round(F.lit(b1), 6).alias("slope"))


@register("t07_logistic_regression")
def t07(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars", "lang").withColumn("log_chars", F.log1p("n_chars"))
    labels = table(spark, d, "labels")
    m = T.logistic_regression(docs.join(labels, "doc_id"), "quality", ["log_chars", "lang"], categorical=["lang"])
    # fitted on the labelled documents, every document scored
    return m.transform(docs.join(labels, "doc_id", "left")).select("doc_id", "quality", "prediction", F.col("probability").cast("string").alias("probability"))


@register("t08_genmod_poisson")
def t08(spark, d):
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).cast("double").alias("n_orders"))
    # customers with no order are the model's zero counts
    c = table(spark, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").withColumn(
        "n_orders", F.coalesce("n_orders", F.lit(0.0)))
    m = T.genmod(c, "n_orders", ["c_acctbal", "c_mktsegment"], family="poisson", categorical=["c_mktsegment"])
    return m.transform(c).select("c_custkey", "n_orders", "prediction")


_KM_BASE = """
SELECT l_linestatus AS arm, CAST(date_diff('day', o_orderdate, l_shipdate) AS BIGINT) AS t, l_returnflag = 'R' AS ev
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


@register("t09_kaplan_meier", f"""
WITH b AS ({_KM_BASE}),
lv AS (SELECT arm, t, CAST(count_if(ev) AS BIGINT) AS events, count(*) AS n_time FROM b GROUP BY 1, 2),
r AS (SELECT *, CAST(sum(n_time) OVER (PARTITION BY arm) - sum(n_time) OVER (PARTITION BY arm ORDER BY t) + n_time AS BIGINT) AS at_risk
      FROM lv)
SELECT arm, t, at_risk, events, n_time - events AS censored,
       round(CASE WHEN sum(CASE WHEN events >= at_risk THEN 1 ELSE 0 END) OVER w > 0 THEN 0.0
                  ELSE exp(sum(CASE WHEN events < at_risk THEN ln(1 - events / at_risk) ELSE 0 END) OVER w) END, 9) AS survival
FROM r WINDOW w AS (PARTITION BY arm ORDER BY t)""")
def t09(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linestatus", "l_shipdate", "l_returnflag")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    b = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_linestatus").alias("arm"),
        F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).cast("bigint").alias("t"),
        (F.col("l_returnflag") == "R").cast("int").alias("ev"))
    km = T.kaplan_meier(b, "t", "ev", "arm")
    return km.select("arm", "t", F.col("at_risk").cast("bigint").alias("at_risk"), "events",
                     F.col("censored").cast("bigint").alias("censored"), F.round("survival", 9).alias("survival"))


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql():
    rows = []
    for a in _CORR_COLS:
        vals = [("1.0" if a == b else f"round(corr({a}, {b}), 9)") + f" AS {b}" for b in _CORR_COLS]
        rows.append(f"SELECT '{a}' AS \"column\", " + ", ".join(vals) + " FROM lineitem")
    return "\nUNION ALL\n".join(rows)


@register("t10_correlation", _corr_sql())
def t10(spark, d):
    m = T.correlation_matrix(table(spark, d, "lineitem"), _CORR_COLS)
    return m.withColumns({c: F.round(c, 9) for c in _CORR_COLS})


def _spearman_sql() -> str:
    ranks = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in _CORR_COLS)
    rows = [f"SELECT '{a}' AS \"column\", " + ", ".join(f"round(corr({a}, {b}), 9) AS {b}" if a != b else f"1.0::DOUBLE AS {b}" for b in _CORR_COLS) + " FROM r" for a in _CORR_COLS]
    return f"WITH r AS (SELECT {ranks} FROM lineitem) " + " UNION ALL ".join(rows)


@register("t10_rank_correlation", _spearman_sql())
def t10_spearman(spark, d):
    m = T.correlation_matrix(table(spark, d, "lineitem"), _CORR_COLS, method="spearman")
    return m.withColumns({c: F.round(c, 9) for c in _CORR_COLS})
