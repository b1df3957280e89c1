"""Distribution helpers against known values, and closed-form statistics."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import stats as T


@pytest.mark.parametrize("t,df,p", [(2.228138852, 10, 0.05), (1.959963985, 1e6, 0.05), (0.0, 5, 1.0), (3.169272667, 10, 0.01)])
def test_t_two_sided(t, df, p):
    assert abs(T.t_sf_two_sided(t, df) - p) < 1e-6


@pytest.mark.parametrize("x,k,p", [(3.841458821, 1, 0.05), (5.991464547, 2, 0.05), (18.30703805, 10, 0.05), (0.0, 3, 1.0)])
def test_chi2_sf(x, k, p):
    assert abs(T.chi2_sf(x, k) - p) < 1e-6


def test_f_sf():
    # F(0.95; 2, 10) = 4.102821015
    assert abs(T.f_sf(4.102821015, 2, 10) - 0.05) < 1e-6


def test_fisher_2x2_zero_cell(spark):
    # table [[3, 0], [1, 4]]: two-sided p = 0.1428571 (known value)
    rows = [(1, 1)] * 3 + [(0, 1)] * 1 + [(0, 0)] * 4
    df = spark.createDataFrame(rows, "a int, b int")
    r = T.fisher_exact_2x2(df, "a", "b").first()
    assert (r.n11, r.n12, r.n21, r.n22) == (3, 0, 1, 4)
    assert abs(r.p_value - 0.142857142857) < 1e-9


def test_kaplan_meier_ties_and_censoring(spark):
    data = [(1.0, 1, "a"), (1.0, 1, "a"), (2.0, 0, "a"), (3.0, 1, "a"), (4.0, 0, "a"), (2.0, 1, "b"), (2.0, 1, "b")]
    km = T.kaplan_meier(spark.createDataFrame(data, "t double, event int, arm string"), "t", "event", "arm")
    got = {(r.arm, r.t): (r.at_risk, r.events, r.censored, round(r.survival, 12)) for r in km.collect()}
    s1 = 1 - 2 / 5
    s3 = s1 * (1 - 1 / 2)
    assert got[("a", 1.0)] == (5, 2, 0, round(s1, 12))
    assert got[("a", 2.0)] == (3, 0, 1, round(s1, 12))
    assert got[("a", 3.0)] == (2, 1, 0, round(s3, 12))
    assert got[("a", 4.0)] == (1, 0, 1, round(s3, 12))
    assert got[("b", 2.0)] == (2, 2, 0, 0.0)


def test_ttest_and_anova_closed_form(spark):
    vals = [("x", 1.0), ("x", 2.0), ("x", 3.0), ("y", 2.0), ("y", 4.0), ("y", 6.0)]
    df = spark.createDataFrame(vals, "g string, v double")
    r = {x.method: x for x in T.ttest_two_sample(df, "v", "g", "x", "y").collect()}
    # means 2 and 4, variances 1 and 4, n = 3
    assert abs(r["pooled"].t - (-2 / math.sqrt(2.5 * (2 / 3)))) < 1e-12 and r["pooled"].df == 4
    a = T.anova_one_way(df, "v", "g").first()
    assert abs(a.ss_between - 6.0) < 1e-9 and abs(a.ss_within - 10.0) < 1e-9 and abs(a.f - 2.4) < 1e-9


def test_means_ci(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "v double")
    r = T.means_ci(df, "v", level=0.95).first()
    half = 1.959963984540054 * r["std"] / 10
    assert abs(r["lower"] - (50.5 - half)) < 1e-9


def test_correlation_matrix(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("a"), (F.col("id") * -2.0).alias("b"))
    m = {r.column: r for r in T.correlation_matrix(df, ["a", "b"]).collect()}
    assert abs(m["a"]["b"] + 1.0) < 1e-12 and m["b"]["b"] == 1.0
