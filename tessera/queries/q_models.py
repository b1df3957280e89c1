"""Model training, evaluation and scoring (M1-M11) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import models as M
from ..sources.io import scratch_path
from ..tables import table
from . import register


def _all_docs(spark, d):
    """Every document, with its label where it has one."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars", "lang", "source")
    return docs.join(table(spark, d, "labels"), "doc_id", "left")


def _doc_labels(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars", "lang", "source")
    return docs.join(table(spark, d, "labels"), "doc_id")


def _split(df, key):
    h = F.pmod(F.xxhash64(F.col(key), F.lit(3)), F.lit(10))
    return df.filter(h < 7), df.filter(h >= 7)


@register("m01_train_binary")
def m01b(spark, d):
    m = M.train(_doc_labels(spark, d), "quality", "BINARY_CLASSIFICATION", ["n_chars", "lang", "source"], "random_forest",
                {"numTrees": 20, "maxDepth": 5})
    # documents without a label are scored too; their label is null
    return M.score(m, _all_docs(spark, d), "quality").select("doc_id", "label", "prediction", "score")


@register("m01_train_multiclass")
def m01m(spark, d):
    e = table(spark, d, "embeddings")
    m = M.train(e, "label", "MULTICLASS", ["embedding"], "logistic", {"maxIter": 50}, vector_features=["embedding"])
    return M.score(m, e, "label", vector_features=["embedding"]).select("vec_id", "label", "prediction")


@register("m01_train_regression")
def m01r(spark, d):
    c = table(spark, d, "customer")
    m = M.train(c, "c_acctbal", "REGRESSION", ["c_nationkey", "c_mktsegment"], "ridge")
    return M.score(m, c, "c_acctbal").select("c_custkey", "label", "prediction")


@register("m05_compare_algorithms")
def m05(spark, d):
    train, test = _split(_doc_labels(spark, d), "doc_id")
    return M.compare_algorithms(train, test, "quality", "BINARY_CLASSIFICATION", ["n_chars", "lang", "source"],
                                algorithms=("random_forest", "gbt", "decision_tree", "logistic", "linear_svc", "mlp"),
                                params={"random_forest": {"numTrees": 20}, "gbt": {"maxIter": 10},
                                        "logistic": {"maxIter": 50}, "linear_svc": {"maxIter": 20},
                                        "mlp": {"maxIter": 50}})


@register("m06_cross_validate")
def m06(spark, d):
    data = _doc_labels(spark, d)
    _, rows = M.cross_validate(data, "quality", "BINARY_CLASSIFICATION", ["n_chars", "lang"], "random_forest",
                               {"maxDepth": [2, 4], "numTrees": [5, 10]}, folds=3)  # 4 settings x 3 folds
    return spark.createDataFrame([(str(p), a, s) for p, a, s in rows], "params string, auc_mean double, auc_std double")


@register("m06_cross_test")
def m06_test(spark, d):
    """Every metric of a cross-test, with its deviation over the folds."""
    return M.cross_test(_doc_labels(spark, d), "quality", "BINARY_CLASSIFICATION", ["n_chars", "lang"], "logistic", folds=3)


_SCORE_SQL = "SELECT least(n_chars / 20000.0, 1.0) AS s, CAST(quality AS DOUBLE) AS y FROM documents JOIN labels USING (doc_id)"


def _scores(spark, d):
    return _doc_labels(spark, d).select(F.least(F.col("n_chars") / 20000.0, F.lit(1.0)).alias("s"),
                                        F.col("quality").cast("double").alias("y"))


@register("m07_binary_metrics", f"""
WITH t AS ({_SCORE_SQL}),
lv AS (SELECT s, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM t GROUP BY s),
c AS (SELECT *, sum(neg) OVER (ORDER BY s) AS neg_le, sum(pos) OVER (ORDER BY s DESC) AS tp,
             sum(neg) OVER (ORDER BY s DESC) AS fp FROM lv),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM lv),
curve AS (SELECT sum(pos * (neg_le - neg) + 0.5 * pos * neg) / (any_value(P) * any_value(N)) AS auc,
                 sum(pos / P * tp / (tp + fp)) AS average_precision FROM c, tot),
pt AS (SELECT -avg(y * ln(least(greatest(s, 1e-15), 1 - 1e-15)) + (1 - y) * ln(1 - least(greatest(s, 1e-15), 1 - 1e-15))) AS log_loss,
              count_if(s >= 0.5 AND y = 1) AS tp, count_if(s >= 0.5 AND y <> 1) AS fp, count_if(s < 0.5 AND y = 1) AS fn FROM t)
SELECT round(auc, 9) AS auc, round(average_precision, 9) AS average_precision, round(log_loss, 9) AS log_loss,
       round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall, round(2 * tp / (2 * tp + fp + fn), 9) AS f1
FROM curve, pt""")
def m07(spark, d):
    m = M.binary_metrics(_scores(spark, d), "s", "y")
    return m.select(*[F.round(c, 9).alias(c) for c in ("auc", "average_precision", "log_loss", "precision", "recall", "f1")])


@register("m07_optimal_threshold", f"""
WITH t AS ({_SCORE_SQL}),
lv AS (SELECT s, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM t GROUP BY s),
c AS (SELECT s, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp FROM lv WHERE s IS NOT NULL),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM lv),
f AS (SELECT s, tp / (tp + fp) AS prec, tp / P AS rec, 2 * tp / (tp + fp + P) AS f1, P / (P + N) AS rate FROM c, tot)
SELECT round(s, 9) AS optimal_threshold, round(prec, 9) AS optimal_precision, round(rec, 9) AS optimal_recall,
       round(f1, 9) AS optimal_f1, round(prec / rate, 9) AS optimal_lift
FROM f ORDER BY f1 DESC, s DESC LIMIT 1""")
def m07o(spark, d):
    m = M.binary_metrics(_scores(spark, d), "s", "y")
    return m.select(*[F.round(c, 9).alias(c) for c in ("optimal_threshold", "optimal_precision", "optimal_recall",
                                                       "optimal_f1", "optimal_lift")])


@register("m08_lift", f"""
WITH t AS ({_SCORE_SQL}),
r AS (SELECT s, y, row_number() OVER (ORDER BY s DESC, y) AS rn, count(*) OVER () AS n FROM t),
b AS (SELECT CAST(floor((rn - 1) * 10 / n) + 1 AS INTEGER) AS bin, s, y FROM r),
o AS (SELECT avg(y) AS rate FROM t)
SELECT bin, count(*) AS n, sum(y) AS positives, round(sum(y) / count(*), 9) AS rate,
       round(sum(y) / count(*) / any_value(o.rate), 9) AS lift, round(avg(s), 9) AS mean_score,
       round(abs(avg(s) - sum(y) / count(*)), 9) AS calibration_gap
FROM b, o GROUP BY bin""")
def m08(spark, d):
    t = M.lift_table(_scores(spark, d), "s", "y", 10)
    return t.select("bin", "n", "positives", *[F.round(c, 9).alias(c) for c in ("rate", "lift", "mean_score", "calibration_gap")])


@register("m08_calibration_loss", f"""
WITH t AS ({_SCORE_SQL}),
r AS (SELECT s, y, row_number() OVER (ORDER BY s DESC, y) AS rn, count(*) OVER () AS n FROM t),
b AS (SELECT floor((rn - 1) * 10 / n) AS bin, s, y FROM r),
g AS (SELECT count(*) AS n, abs(avg(s) - avg(y)) AS gap FROM b GROUP BY bin)
SELECT round(sum(n * gap) / sum(n), 9) AS calibration_loss FROM g""")
def m08c(spark, d):
    c = M.calibration_loss(_scores(spark, d), "s", "y", 10)
    return c.select(F.round("calibration_loss", 9).alias("calibration_loss"))


@register("m09_threshold_curve", f"""
WITH t AS ({_SCORE_SQL}),
per AS (SELECT CAST(least(floor(round(s * 100, 9)), 100) AS INTEGER) AS b, count_if(y = 1) AS pos, count_if(y <> 1) AS neg
        FROM t GROUP BY 1),
grid AS (SELECT CAST(range AS INTEGER) AS b FROM range(0, 101)),
f AS (SELECT g.b, coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg FROM grid g LEFT JOIN per USING (b)),
c AS (SELECT b, sum(pos) OVER (ORDER BY b DESC) AS tp, sum(neg) OVER (ORDER BY b DESC) AS fp FROM f),
tot AS (SELECT sum(pos) AS P FROM per)
SELECT b / 100.0 AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END, 9) AS precision, round(tp / P, 9) AS recall,
       round(CASE WHEN tp > 0 THEN 2 * tp / (tp + fp + P) ELSE 0.0 END, 9) AS f1
FROM c, tot""")
def m09(spark, d):
    c = M.threshold_curve(_scores(spark, d), "s", "y", 100)
    return c.select("threshold", F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"),
                    *[F.round(x, 9).alias(x) for x in ("precision", "recall", "f1")])


@register("m10_feature_importance")
def m10(spark, d):
    data = _doc_labels(spark, d)
    m = M.train(data, "quality", "BINARY_CLASSIFICATION", ["n_chars", "lang", "source"], "gbt", {"maxIter": 10})
    return spark.createDataFrame(M.feature_importance(m), "feature string, importance double")


@register("m11_save_load_score")
def m11(spark, d):
    data = _doc_labels(spark, d)
    base = scratch_path(spark, "models")
    m = M.train(data, "quality", "BINARY_CLASSIFICATION", ["n_chars", "lang"], "logistic")
    M.save_model(m, base, 1)
    m2 = M.train(data, "quality", "BINARY_CLASSIFICATION", ["n_chars", "lang"], "logistic", {"regParam": 0.1})
    path = M.save_model(m2, base, 2)
    return M.score(M.load_model(path), _all_docs(spark, d)).select("doc_id", "prediction", "score")
