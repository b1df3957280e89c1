"""Statistical procedures (T1-T10) on Spark aggregates.

Test statistics come from one or two ``groupBy().agg()`` passes (sums,
counts, sums of squares), so they scale with the data and never gather a
group. P-values are computed from the (few) statistic rows with small
numeric helpers, applied as an Arrow-batched ``pandas_udf``.
"""

from __future__ import annotations

import math
from functools import reduce
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import with_scalars
from .window import materialize_if_costly, running

# -- distribution helpers (scalar, pure Python) ------------------------------------------


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction for the incomplete beta function (modified Lentz)."""
    tiny, eps = 1e-300, 3e-16
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < eps:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    ln_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(ln_front) * _betacf(a, b, x) / a
    return 1.0 - math.exp(ln_front) * _betacf(b, a, 1.0 - x) / b


def gammaincc(s: float, x: float) -> float:
    """Regularized upper incomplete gamma Q(s, x)."""
    if x <= 0:
        return 1.0
    if x < s + 1.0:
        term = total = 1.0 / s
        n = s
        for _ in range(10000):
            n += 1.0
            term *= x / n
            total += term
            if abs(term) < abs(total) * 1e-16:
                break
        return 1.0 - total * math.exp(-x + s * math.log(x) - math.lgamma(s))
    tiny = 1e-300
    b = x + 1.0 - s
    c, d = 1.0 / tiny, 1.0 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - s)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-16:
            break
    return math.exp(-x + s * math.log(x) - math.lgamma(s)) * h


def t_sf_two_sided(t: float, df: float) -> float:
    if t is None or df is None or not np.isfinite(t) or df <= 0:
        return float("nan")
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    if f is None or not np.isfinite(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_sf(x: float, k: float) -> float:
    if x is None or not np.isfinite(x) or k <= 0:
        return float("nan")
    return gammaincc(k / 2.0, x / 2.0)


@F.pandas_udf(DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_sf_two_sided(a, b) for a, b in zip(t, df)])


@F.pandas_udf(DoubleType())
def f_pvalue(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([f_sf(a, b, c) for a, b, c in zip(f, d1, d2)])


@F.pandas_udf(DoubleType())
def chi2_pvalue(x: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf(a, b) for a, b in zip(x, k)])


def _keys(by) -> list[str]:
    return [] if by is None else ([by] if isinstance(by, str) else list(by))


# T1 -------------------------------------------------------------------------------------
def chi_square(df: DataFrame, a: str, b: str, by=None, p_value: bool = True) -> DataFrame:
    """Pearson chi-square of independence for a two-way table.

    Uses chi2 = sum(o^2 / e) - N over observed cells only, so the full
    grid of levels is never built. Returns chi2, df and (optionally) p.
    """
    keys = _keys(by)
    # the cell table (levels a x levels b, observed only) feeds four aggregates: compute it once
    cells = materialize_if_costly(df.groupBy(*keys, a, b).agg(F.count(F.lit(1)).alias("o")))
    rows = cells.groupBy(*keys, a).agg(F.sum("o").alias("ra"))
    cols = cells.groupBy(*keys, b).agg(F.sum("o").alias("cb"))
    tot = cells.groupBy(*keys).agg(F.sum("o").alias("n"), F.count_distinct(a).alias("r"),
                                   F.count_distinct(b).alias("c"))
    j = cells.join(rows, [*keys, a]).join(cols, [*keys, b]).join(tot, keys) if keys else \
        with_scalars(cells.join(rows, a).join(cols, b), tot)
    out = j.groupBy(*keys).agg(
        # in double from the start: the product of three counts outgrows a long
        (F.sum((F.col("o").cast("double") / F.col("ra")) * (F.col("o").cast("double") / F.col("cb"))) * F.first("n") - F.first("n")).alias("chi2"),
        ((F.first("r") - 1) * (F.first("c") - 1)).alias("df"),
    )
    if p_value:
        out = out.withColumn("p_value", chi2_pvalue(F.col("chi2"), F.col("df").cast("double")))
    return out


# T2 -------------------------------------------------------------------------------------
def fisher_exact_2x2(df: DataFrame, a: str, b: str, first_a=1, first_b=1) -> DataFrame:
    """Two-sided Fisher exact test of a 2x2 table (levels ``first_*`` vs the rest).

    Cell counts are one aggregate. The hypergeometric terms for every
    possible top-left count k are generated by ``spark.range`` and their log
    probabilities accumulated with the blocked running sum of log ratios
    P(k+1)/P(k); the p-value sums the terms not more likely than the observed.
    """
    spark = df.sparkSession
    A, B = F.col(a) == F.lit(first_a), F.col(b) == F.lit(first_b)
    cnt = df.agg(F.count_if(A & B).alias("n11"), F.count_if(A & ~B).alias("n12"),
                 F.count_if(~A & B).alias("n21"), F.count_if(~A & ~B).alias("n22")).first()
    n11, n12, n21, n22 = (int(cnt[i]) for i in range(4))
    r1, c1, n = n11 + n12, n11 + n21, n11 + n12 + n21 + n22
    r2 = n - r1
    kmin, kmax = max(0, c1 - r2), min(r1, c1)
    ks = spark.range(kmin, kmax + 1).withColumnRenamed("id", "k")
    # log P(k) - log P(kmin): running sum of log ratios log P(j)/P(j-1) for j <= k
    ratio = F.when(F.col("k") == kmin, F.lit(0.0)).otherwise(
        F.log((F.lit(r1) - F.col("k") + 1) * (F.lit(c1) - F.col("k") + 1))
        - F.log(F.col("k") * (F.lit(r2 - c1) + F.col("k"))))
    terms = materialize_if_costly(running(ks.withColumn("lr", ratio), ["k"], {"lw": ("sum", "lr")}))
    mx = terms.agg(F.max("lw")).first()[0]
    obs = terms.filter(F.col("k") == n11).select("lw").first()[0]
    res = terms.agg(
        F.sum(F.exp(F.col("lw") - F.lit(mx))).alias("z"),
        F.sum(F.when(F.col("lw") <= F.lit(obs) + F.lit(1e-7), F.exp(F.col("lw") - F.lit(mx)))).alias("tail"),
    )
    return res.select(F.lit(n11).alias("n11"), F.lit(n12).alias("n12"), F.lit(n21).alias("n21"),
                      F.lit(n22).alias("n22"), F.least(F.col("tail") / F.col("z"), F.lit(1.0)).alias("p_value"))


# T3, T4, T5 -----------------------------------------------------------------------------
def means_ci(df: DataFrame, var: str, by=None, level: float = 0.95) -> DataFrame:
    """Mean with normal-quantile confidence limits: mean +/- z * std / sqrt(n)."""
    z = NormalDist().inv_cdf(0.5 + level / 2.0)
    x = F.col(var)
    g = df.groupBy(*_keys(by)).agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"))
    half = F.lit(z) * F.col("std") / F.sqrt("n")
    return g.withColumns({"lower": F.col("mean") - half, "upper": F.col("mean") + half})


def ttest_one_sample(df: DataFrame, var: str, mu: float = 0.0, by=None) -> DataFrame:
    x = F.col(var)
    g = df.groupBy(*_keys(by)).agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"))
    t = (F.col("mean") - F.lit(mu)) / (F.col("std") / F.sqrt("n"))
    return g.withColumns({"t": t, "df": (F.col("n") - 1).cast("double")}).withColumn(
        "p_value", t_pvalue(F.col("t"), F.col("df")))


def ttest_two_sample(df: DataFrame, var: str, group: str, level_a, level_b) -> DataFrame:
    """Pooled and Welch two-sample t-tests between two levels of ``group``; one row each."""
    x = F.col(var)
    s = df.filter(F.col(group).isin(level_a, level_b)).agg(
        *[F.count(F.when(F.col(group) == lv, x)).alias(f"n{i}") for i, lv in ((1, level_a), (2, level_b))],
        *[F.avg(F.when(F.col(group) == lv, x)).alias(f"m{i}") for i, lv in ((1, level_a), (2, level_b))],
        *[F.var_samp(F.when(F.col(group) == lv, x)).alias(f"v{i}") for i, lv in ((1, level_a), (2, level_b))],
    )
    n1, n2, m1, m2, v1, v2 = (F.col(c) for c in ("n1", "n2", "m1", "m2", "v1", "v2"))
    sp = ((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)
    pooled = s.select(F.lit("pooled").alias("method"), ((m1 - m2) / F.sqrt(sp * (1 / n1 + 1 / n2))).alias("t"),
                      (n1 + n2 - 2).cast("double").alias("df"))
    se2 = v1 / n1 + v2 / n2
    welch = s.select(F.lit("satterthwaite").alias("method"), ((m1 - m2) / F.sqrt(se2)).alias("t"),
                     (se2 * se2 / ((v1 / n1) * (v1 / n1) / (n1 - 1) + (v2 / n2) * (v2 / n2) / (n2 - 1))).alias("df"))
    return pooled.unionByName(welch).withColumn("p_value", t_pvalue(F.col("t"), F.col("df")))


def ttest_paired(df: DataFrame, a: str, b: str) -> DataFrame:
    d = df.select((F.col(a) - F.col(b)).alias("__d"))
    return ttest_one_sample(d, "__d", 0.0)


def anova_one_way(df: DataFrame, var: str, group: str) -> DataFrame:
    """One-way ANOVA: SSB, SSW, F and degrees of freedom from each group's count, mean and central moment.

    Central moments are merged by Spark's own variance aggregate, so a mean that
    is large against the spread costs no digits.
    """
    x = F.col(var).cast("double")
    g = materialize_if_costly(df.filter(x.isNotNull()).groupBy(group).agg(
        F.count(x).alias("n"), F.avg(x).alias("m"), F.var_pop(x).alias("v")))
    # the grand mean relative to one group's: differences stay small
    t = with_scalars(g, g.agg(F.min("m").alias("m0")))
    d = F.col("m") - F.col("m0")
    t = t.agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * F.col("v")).alias("W"),
              F.sum(F.col("n") * d).alias("D"), F.sum(F.col("n") * d * d).alias("DD"))
    ssb = F.col("DD") - F.col("D") * F.col("D") / F.col("N")
    ssw = F.col("W")
    d1 = (F.col("k") - 1).cast("double")
    d2 = (F.col("N") - F.col("k")).cast("double")
    out = t.select(ssb.alias("ss_between"), ssw.alias("ss_within"), d1.alias("df_between"), d2.alias("df_within"),
                   ((ssb / d1) / (ssw / d2)).alias("f"))
    return out.withColumn("p_value", f_pvalue(F.col("f"), F.col("df_between"), F.col("df_within")))


# T6-T8 models ------------------------------------------------------------------------------
def _fit(df: DataFrame, target: str, features: list[str], categorical, estimator):
    """Fit ``estimator`` on the rows whose target and numeric features are complete.

    The model keeps every row it is applied to: a row with a null (or NaN) numeric
    feature gets nulls in the columns the estimator adds.
    """
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler

    stages, cols = [], []
    for c in features:
        if c in categorical:
            stages += [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep"),
                       OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__ohe")]
            cols.append(f"{c}__ohe")
        else:
            cols.append(c)
    stages.append(VectorAssembler(inputCols=cols, outputCol="__features", handleInvalid="keep"))
    nums = [c for c in features if c not in categorical]
    model = Pipeline(stages=[*stages, estimator]).fit(df.dropna(subset=[target, *nums]))
    # "keep" assembles a null as NaN, from which a classifier would still give a class
    added = [c for c in ("rawPrediction", "probability", "prediction") if estimator.hasParam(f"{c}Col")]
    whole = " AND ".join([f"`{c}` IS NOT NULL AND NOT isnan(CAST(`{c}` AS DOUBLE))" for c in nums]) or "true"
    nulls = ", ".join(f"CASE WHEN {whole} THEN {c} END AS {c}" for c in added)
    return PipelineModel([*model.stages, SQLTransformer(
        statement=f"SELECT * EXCEPT ({', '.join(added)}), {nulls} FROM __THIS__")])


def linear_regression(df: DataFrame, target: str, features: list[str], categorical=(), reg: float = 0.0,
                      elastic: float = 0.0):
    """PROC REG / GLM: least squares (``categorical`` columns one-hot, GLM class variables)."""
    from pyspark.ml.regression import LinearRegression

    return _fit(df, target, features, categorical, LinearRegression(
        featuresCol="__features", labelCol=target, regParam=reg, elasticNetParam=elastic))


def logistic_regression(df: DataFrame, target: str, features: list[str], categorical=(), reg: float = 0.0):
    from pyspark.ml.classification import LogisticRegression

    return _fit(df, target, features, categorical, LogisticRegression(
        featuresCol="__features", labelCol=target, regParam=reg))


def genmod(df: DataFrame, target: str, features: list[str], family: str = "poisson", link: str | None = None,
           categorical=()):
    from pyspark.ml.regression import GeneralizedLinearRegression

    return _fit(df, target, features, categorical, GeneralizedLinearRegression(
        featuresCol="__features", labelCol=target, family=family, **({"link": link} if link else {})))


def coefficients(model, names: list[str]) -> list[tuple[str, float]]:
    last = model.stages[-2]  # the stage after it nulls the predictions of incomplete rows
    coefs = list(last.coefficients.toArray())
    return [("intercept", float(last.intercept))] + list(zip(names, coefs))


# T9 ------------------------------------------------------------------------------------------
def kaplan_meier(df: DataFrame, time: str, event: str, by=None) -> DataFrame:
    """Product-limit survival table per stratum: time, at risk, events, censored, survival.

    One aggregate per (stratum, time); at-risk counts and the product of
    (1 - d/n) come from running sums over the time-ordered level table
    (log of the product; a factor of zero is tracked separately).
    """
    keys = _keys(by)
    ev = F.col(event).cast("int") == 1
    lv = df.groupBy(*keys, time).agg(F.count_if(ev).alias("events"), F.count(F.lit(1)).alias("n_time"))
    tot = lv.groupBy(*keys).agg(F.sum("n_time").alias("__total"))
    lv = lv.join(tot, keys) if keys else with_scalars(lv, tot)
    lv = running(lv, [time], {"__before_incl": ("sum", "n_time")}, keys)
    lv = lv.withColumn("at_risk", F.col("__total") - F.col("__before_incl") + F.col("n_time"))
    lv = lv.withColumns({
        "__zero": F.when(F.col("events") >= F.col("at_risk"), 1).otherwise(0),
        "__log": F.when(F.col("events") < F.col("at_risk"), F.log1p(-F.col("events") / F.col("at_risk"))).otherwise(0.0),
    })
    lv = running(lv, [time], {"__cum_log": ("sum", "__log"), "__zeros": ("sum", "__zero")}, keys)
    surv = F.when(F.col("__zeros") > 0, F.lit(0.0)).otherwise(F.exp("__cum_log"))
    return lv.select(*keys, time, "at_risk", "events", (F.col("n_time") - F.col("events")).alias("censored"),
                     surv.alias("survival"))


def mean_ranks(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns as ranks from 1 (ties: their mean), over the rows in which none is null or NaN.

    Each column's distinct values are counted and numbered by the blocked scan;
    the rows then meet their value's rank (a join that AQE broadcasts or splits).
    """
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in columns])
    out = materialize_if_costly(values.where(complete))
    for c in columns:
        # -0.0 and 0.0 are one value
        level = (F.col(c) + F.lit(0.0)).alias("__v")
        levels = materialize_if_costly(out.groupBy(level).agg(F.count(F.lit(1)).alias("__n")))
        upto = running(levels, ["__v"], {"__upto": ("sum", "__n")})
        ranks = upto.select("__v", (F.col("__upto") - (F.col("__n") - 1) / 2).alias("__rank"))
        out = out.withColumn("__k", F.col(c) + F.lit(0.0)).join(ranks, F.col("__k") == F.col("__v")).withColumn(c, F.col("__rank")).drop("__k", "__v", "__rank")
    return out


# T10 -----------------------------------------------------------------------------------------
def correlation_matrix(df: DataFrame, columns: list[str], method: str = "pearson") -> DataFrame:
    """Pairwise correlations in one aggregate; one row per column with one value per column.

    ``pearson`` uses the rows in which both columns of a pair have a value;
    ``spearman`` correlates the ranks (ties: their mean) of the rows in which
    all columns have one.
    """
    if method not in ("pearson", "spearman"):
        raise ValueError("method is pearson or spearman")
    if method == "spearman":
        df = mean_ranks(df, columns)
    pairs = {(a, b): F.corr(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]}
    wide = df.agg(*[v.alias(f"{a}__{b}") for (a, b), v in pairs.items()]).first()
    rows = []
    for a in columns:
        vals = []
        for b in columns:
            if a == b:
                vals.append(1.0)
            else:
                key = f"{a}__{b}" if (a, b) in pairs else f"{b}__{a}"
                vals.append(wide[key])
        rows.append((a, *vals))
    return df.sparkSession.createDataFrame(rows, ["column", *columns])
