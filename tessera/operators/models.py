"""Model training, evaluation and scoring (M1-M11) on ``pyspark.ml``.

Training is Spark ML (distributed fitting). Evaluation metrics are plain
aggregates over a (score, label) table: per distinct score level counts,
then running sums over the level table (the blocked scan), so AUC, average
precision, lift and threshold curves are exact without a global sort.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import with_scalars
from .window import materialize_if_costly, running

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")

# Algorithm names accepted by the prediction task, per task type.
CLASSIFIERS = ("random_forest", "gbt", "decision_tree", "logistic", "linear_svc", "mlp")
REGRESSORS = ("random_forest", "gbt", "decision_tree", "least_squares", "ridge", "lasso")


def _estimator(name: str, task: str, params: dict, n_features: int | None = None, n_classes: int = 2):
    from pyspark.ml import classification as C
    from pyspark.ml import regression as R

    common = {"featuresCol": "features", "labelCol": "label"}
    if task in ("BINARY_CLASSIFICATION", "MULTICLASS"):
        if name == "random_forest":
            return C.RandomForestClassifier(**common, seed=7, **params)
        if name == "gbt":
            if task == "MULTICLASS":
                raise ValueError("gbt is binary only in Spark ML")
            return C.GBTClassifier(**common, seed=7, **params)
        if name == "decision_tree":
            return C.DecisionTreeClassifier(**common, seed=7, **params)
        if name == "logistic":
            return C.LogisticRegression(**common, **params)
        if name == "linear_svc":
            return C.LinearSVC(**common, **params)
        if name == "mlp":
            hidden = params.pop("hidden", [16])
            return C.MultilayerPerceptronClassifier(**common, layers=[n_features, *hidden, n_classes], seed=7, **params)
    else:
        if name == "random_forest":
            return R.RandomForestRegressor(**common, seed=7, **params)
        if name == "gbt":
            return R.GBTRegressor(**common, seed=7, **params)
        if name == "decision_tree":
            return R.DecisionTreeRegressor(**common, seed=7, **params)
        if name == "least_squares":
            return R.LinearRegression(**common, **params)
        if name == "ridge":
            return R.LinearRegression(**common, elasticNetParam=0.0, regParam=params.pop("regParam", 0.1), **params)
        if name == "lasso":
            return R.LinearRegression(**common, elasticNetParam=1.0, regParam=params.pop("regParam", 0.1), **params)
    raise ValueError(f"unknown algorithm {name!r} for {task}")


def feature_pipeline(df: DataFrame, features: list[str], vector_features=()) -> tuple[list, list[str]]:
    """Stages that turn raw columns into ``features``: strings indexed and one-hot
    encoded, numbers mean-imputed, array columns converted to vectors."""
    types = dict(df.dtypes)
    stages, cols = [], []
    nums = [c for c in features if types[c] in NUMERIC and c not in vector_features]
    if nums:
        stages.append(Imputer(inputCols=nums, outputCols=[f"{c}__imp" for c in nums], strategy="mean"))
        cols += [f"{c}__imp" for c in nums]
    for c in features:
        if types[c] == "string":
            stages += [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep"),
                       OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__ohe", dropLast=True)]
            cols.append(f"{c}__ohe")
    cols += [f"{c}__vec" for c in vector_features]
    # "keep" needs known vector sizes; array-derived vectors carry none, so fail on bad rows instead
    stages.append(VectorAssembler(inputCols=cols, outputCol="features",
                                  handleInvalid="error" if vector_features else "keep"))
    return stages, cols


def _prepare(df: DataFrame, target: str, vector_features=()) -> DataFrame:
    out = df.withColumn("label", F.col(target).cast("double"))
    for c in vector_features:
        out = out.withColumn(f"{c}__vec", array_to_vector(F.transform(c, lambda x: x.cast("double"))))
    return out


def train(df: DataFrame, target: str, task: str, features: list[str], algorithm: str = "random_forest",
          params: dict | None = None, vector_features=()) -> PipelineModel:
    """M1-M4: fit one algorithm on a prediction task; returns a PipelineModel."""
    data = _prepare(df, target, vector_features)
    stages, _ = feature_pipeline(data, [f for f in features if f not in vector_features], vector_features)
    n_classes = 2
    n_feat = None
    if algorithm == "mlp":
        n_classes = int(data.agg(F.max("label")).first()[0]) + 1
        n_feat = Pipeline(stages=stages).fit(data).transform(data.limit(1)).first()["features"].size
    est = _estimator(algorithm, task, dict(params or {}), n_feat, n_classes)
    return Pipeline(stages=stages + [est]).fit(data)


def score(model: PipelineModel, df: DataFrame, target: str | None = None, vector_features=()) -> DataFrame:
    """Scored rows with ``prediction`` and, for classifiers, ``score`` = P(class 1)."""
    data = _prepare(df, target, vector_features) if target else df
    if not target:
        for c in vector_features:
            data = data.withColumn(f"{c}__vec", array_to_vector(F.transform(c, lambda x: x.cast("double"))))
    out = model.transform(data)
    if "probability" in out.columns:
        out = out.withColumn("score", vector_to_array("probability")[1])
    elif "rawPrediction" in out.columns:
        # margin-only classifiers (linear SVC): a rank-preserving score, not a probability
        out = out.withColumn("score", vector_to_array("rawPrediction")[1])
    return out


# M5, M6 ------------------------------------------------------------------------------------
def compare_algorithms(train_df: DataFrame, test_df: DataFrame, target: str, task: str, features: list[str],
                       algorithms=("random_forest", "logistic", "decision_tree"), vector_features=(),
                       params: dict[str, dict] | None = None) -> DataFrame:
    """Fit each algorithm (``params[algorithm]`` overrides its settings), evaluate on
    ``test_df``; one metrics row per algorithm, best first."""
    spark = train_df.sparkSession
    rows = []
    # the feature stages are fitted once and shared by every algorithm
    data = _prepare(train_df, target, vector_features)
    stages, _ = feature_pipeline(data, [f for f in features if f not in vector_features], vector_features)
    prep = Pipeline(stages=stages).fit(data)
    feats = prep.transform(data)
    n_feat = feats.select("features").first()["features"].size
    n_classes = int(data.agg(F.max("label")).first()[0]) + 1
    for alg in algorithms:
        est = _estimator(alg, task, dict((params or {}).get(alg) or {}), n_feat, max(2, n_classes))
        m = PipelineModel(stages=[*prep.stages, est.fit(feats)])
        scored = score(m, test_df, target, vector_features)
        if task == "REGRESSION":
            r = scored.agg(F.sqrt(F.avg((F.col("prediction") - F.col("label")) ** 2)).alias("rmse"),
                           F.avg(F.abs(F.col("prediction") - F.col("label"))).alias("mae")).first()
            rows.append((alg, float(r["rmse"]), float(r["mae"])))
        else:
            acc = scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
            auc = binary_metrics(scored, "score", "label").first()["auc"] if task == "BINARY_CLASSIFICATION" else None
            rows.append((alg, float(acc), None if auc is None else float(auc)))
    if task == "REGRESSION":
        return spark.createDataFrame(rows, "algorithm string, rmse double, mae double").orderBy("rmse")
    return spark.createDataFrame(rows, "algorithm string, accuracy double, auc double").orderBy(
        F.desc_nulls_last("auc"), F.desc("accuracy"))


def cross_validate(df: DataFrame, target: str, task: str, features: list[str], algorithm: str,
                   grid: dict[str, list], folds: int = 3, vector_features=()):
    """M6: K-fold cross-test over a parameter grid; returns (best model, metrics rows with mean and std)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    data = _prepare(df, target, vector_features)
    stages, _ = feature_pipeline(data, [f for f in features if f not in vector_features], vector_features)
    n_feat, n_classes = None, 2
    if algorithm == "mlp":  # its layers take their sizes from the data
        fitted = Pipeline(stages=stages).fit(data)
        # every fold's features have these sizes: the string levels of the whole input
        stages = [fit if type(fit).__name__ == "StringIndexerModel" else st for st, fit in zip(stages, fitted.stages)]
        n_feat = fitted.transform(data.limit(1)).first()["features"].size
        n_classes = int(data.agg(F.max("label")).first()[0]) + 1
    est = _estimator(algorithm, task, {}, n_feat, n_classes)
    builder = ParamGridBuilder()
    for p, values in grid.items():
        builder = builder.addGrid(est.getParam(p), values)
    maps = builder.build()
    ev = {"BINARY_CLASSIFICATION": BinaryClassificationEvaluator(labelCol="label"),
          "MULTICLASS": MulticlassClassificationEvaluator(labelCol="label"),
          "REGRESSION": RegressionEvaluator(labelCol="label")}[task]
    # the feature stages are fitted on each fold's training rows, as the algorithm is
    cv = CrossValidator(estimator=Pipeline(stages=[*stages, est]), estimatorParamMaps=maps, evaluator=ev,
                        numFolds=folds, seed=7)
    model = cv.fit(data)
    rows = [({p.name: v for p, v in m.items()}, float(a), float(s))
            for m, a, s in zip(maps, model.avgMetrics, model.stdMetrics)]
    return model, rows


def cross_test(df: DataFrame, target: str, task: str, features: list[str], algorithm: str, params: dict | None = None,
               folds: int = 3, seed: int = 7, vector_features=()) -> DataFrame:
    """M6: K-fold cross-test with every metric: (metric, mean, std, folds), one row per metric.

    Rows are dealt to folds at random (written once, so each row stays in its
    fold) and scored by a model fitted on the other folds. All folds are
    measured together: score levels by fold, one scan over them. ``std`` is the
    sample deviation over the folds in which the metric is defined.
    """
    ensure_checkpoint_dir(df.sparkSession)
    dealt = df.withColumn("__fold", F.floor(F.rand(seed) * folds).cast("int")).checkpoint(eager=True)
    parts = []
    for k in range(folds):
        model = train(dealt.where(F.col("__fold") != k), target, task, features, algorithm, params, vector_features)
        parts.append(score(model, dealt.where(F.col("__fold") == k), target, vector_features))
    wanted = ["__fold", "label", "prediction"] + (["score"] if task == "BINARY_CLASSIFICATION" else [])
    scored = materialize_if_costly(reduce(DataFrame.unionByName, [p.select(*wanted) for p in parts])).where(F.col("label").isNotNull())
    y, p = F.col("label"), F.col("prediction")
    if task == "REGRESSION":
        by = scored.groupBy("__fold").agg(F.sqrt(F.avg((p - y) ** 2)).alias("rmse"), F.avg(F.abs(p - y)).alias("mae"),
                                          (1 - F.try_divide(F.sum((p - y) ** 2), F.var_pop(y) * F.count(y))).alias("r2"))
    elif task == "BINARY_CLASSIFICATION":
        by = binary_metrics_by(scored, "score", "label", "__fold")
    else:
        by = scored.groupBy("__fold").agg(F.avg((p == y).cast("double")).alias("accuracy"))
    names = [c for c in by.columns if c != "__fold"]
    rows = by.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v")) for c in names])).alias("m"))
    return rows.groupBy(F.col("m.metric").alias("metric")).agg(F.avg("m.v").alias("mean"), F.stddev("m.v").alias("std"), F.count("m.v").alias("folds"))


# M7-M9 metrics -----------------------------------------------------------------------------
def _levels(df: DataFrame, score_col: str, label_col: str) -> DataFrame:
    s = F.col(score_col).cast("double")
    y = F.col(label_col).cast("double") == 1.0
    return df.groupBy(s.alias("s")).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))


def binary_metrics(df: DataFrame, score_col: str, label_col: str, threshold: float = 0.5, eps: float = 1e-15) -> DataFrame:
    """auc, log_loss, average_precision, precision, recall, f1 (at ``threshold``), and the
    f1-best threshold with its precision, recall, f1 and lift (``optimal_*``), one row.

    AUC counts tied scores as half; average precision = sum over distinct
    score levels (descending) of (recall gain) x (precision at that level).
    The optimal threshold is a score level (rows at or above it are predicted
    positive), the highest one on ties; without positives its metrics are null.
    """
    lv = _levels(df, score_col, label_col)
    asc = running(lv, ["s"], {"neg_le": ("sum", "neg")})
    desc = running(asc, [("s", False)], {"tp": ("sum", "pos"), "fp": ("sum", "neg")})
    tot = lv.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    j = with_scalars(desc, tot)
    # in double: products of counts outgrow a long
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    auc_terms = pos * (F.col("neg_le") - F.col("neg")) + 0.5 * pos * neg
    # a ratio over no rows is null
    prec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    ap_terms = F.try_divide(F.col("pos"), F.col("P")) * prec
    level_f1 = F.try_divide(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("P"))
    best = F.max(F.when(F.col("s").isNotNull() & (F.col("P") > 0),
                        F.struct(level_f1.alias("f1"), "s", prec.alias("precision"),
                                 F.try_divide(F.col("tp"), F.col("P")).alias("recall"),
                                 F.try_divide(prec, F.try_divide(F.col("P"), F.col("P") + F.col("N"))).alias("lift"))))
    curve = j.agg(F.try_divide(F.sum(auc_terms), F.first("P").cast("double") * F.first("N")).alias("auc"),
                  F.sum(ap_terms).alias("average_precision"), best.alias("__best"))
    curve = curve.select("auc", "average_precision", F.col("__best.s").alias("optimal_threshold"),
                         *[F.col(f"__best.{c}").alias(f"optimal_{c}") for c in ("precision", "recall", "f1", "lift")])
    p = F.least(F.greatest(F.col(score_col).cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label_col).cast("double")
    pred = F.col(score_col) >= threshold
    pt = df.agg(
        (-F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"),
        F.count_if(pred & (y == 1)).alias("__tp"), F.count_if(pred & (y != 1)).alias("__fp"),
        F.count_if(~pred & (y == 1)).alias("__fn"))
    tp, fp, fn = F.col("__tp"), F.col("__fp"), F.col("__fn")
    pt = pt.select("log_loss", F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tp, tp + fn).alias("recall"),
                   F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"))
    return with_scalars(curve, pt)


def binary_metrics_by(df: DataFrame, score_col: str, label_col: str, by: str, threshold: float = 0.5, eps: float = 1e-15) -> DataFrame:
    """One row per value of ``by``: auc, average_precision, log_loss, precision, recall, f1 (as in :func:`binary_metrics`)."""
    s, y = F.col(score_col).cast("double"), F.col(label_col).cast("double")
    lv = df.groupBy(by, s.alias("s")).agg(F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg"))
    asc = running(lv, ["s"], {"neg_le": ("sum", "neg")}, by)
    desc = running(asc, [("s", False)], {"tp": ("sum", "pos"), "fp": ("sum", "neg")}, by)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    # in sums over levels the totals of a group can be divided out at the end
    curve = desc.groupBy(by).agg(
        F.sum("pos").alias("P"), F.sum("neg").alias("N"),
        F.sum(pos * (F.col("neg_le") - F.col("neg")) + 0.5 * pos * neg).alias("pairs"),
        F.sum(pos * F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))).alias("gains"))
    curve = curve.select(by, F.try_divide("pairs", F.col("P").cast("double") * F.col("N")).alias("auc"), F.try_divide("gains", "P").alias("average_precision"))
    p = F.least(F.greatest(s, F.lit(eps)), F.lit(1 - eps))
    hit = s >= threshold
    tp, fp, fn = F.count_if(hit & (y == 1)), F.count_if(hit & (y != 1)), F.count_if(~hit & (y == 1))
    point = df.groupBy(F.col(by).alias("__by")).agg(
        (-F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"), F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"), F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"))
    return curve.join(point, F.col(by).eqNullSafe(F.col("__by"))).drop("__by")


def lift_table(df: DataFrame, score_col: str, label_col: str, bins: int = 10) -> DataFrame:
    """M8: rows ranked by score (descending, ties by score only) into ``bins`` equal-count bins;
    per bin: rows, positives, rate, lift over the overall rate, mean score, and
    |mean score - rate| (its weighted sum is the calibration loss)."""
    y = F.col(label_col).cast("double")
    # rows equal in (score, label) are interchangeable, so (score desc, label) is a sufficient order
    ranked = running(df.select(F.col(score_col).cast("double").alias("s"), y.alias("y")),
                     [("s", False), "y"], {"__rn": ("row_number", None), "__n": ("group_count", None)})
    binned = ranked.withColumn("bin", (F.floor((F.col("__rn") - 1) * bins / F.col("__n")) + 1).cast("int"))
    per = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positives"),
                                    F.avg("s").alias("mean_score"))
    overall = df.agg(F.avg(y).alias("__rate"))
    per = with_scalars(per, overall)
    rate = F.col("positives") / F.col("n")
    return per.select("bin", "n", "positives", rate.alias("rate"), (rate / F.col("__rate")).alias("lift"),
                      "mean_score", F.abs(F.col("mean_score") - rate).alias("calibration_gap"))


def calibration_loss(df: DataFrame, score_col: str, label_col: str, bins: int = 10) -> DataFrame:
    """M8: the calibration gaps of ``lift_table`` weighted by their rows, one value."""
    n = F.col("n")
    return lift_table(df, score_col, label_col, bins).agg(
        (F.sum(n * F.col("calibration_gap")) / F.sum(n)).alias("calibration_loss"))


def threshold_curve(df: DataFrame, score_col: str, label_col: str, steps: int = 100) -> DataFrame:
    """M9: precision, recall and F1 at thresholds 0, 1/steps, ..., 1 (predict positive when score >= t)."""
    spark = df.sparkSession
    s = F.col(score_col).cast("double")
    y = F.col(label_col).cast("double") == 1.0
    # bin b holds scores in [b/steps, (b+1)/steps); 1.0 goes to the last threshold bin
    b = F.least(F.floor(F.round(s * steps, 9)), F.lit(steps)).cast("int")
    per = df.groupBy(b.alias("b")).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    grid = spark.range(0, steps + 1).select(F.col("id").cast("int").alias("b"))
    full = grid.join(per, "b", "left").fillna(0, ["pos", "neg"])
    cum = running(full, [("b", False)], {"tp": ("sum", "pos"), "fp": ("sum", "neg")})
    tot = per.agg(F.sum("pos").alias("P"))
    cum = with_scalars(cum, tot)
    tp, fp, P = F.col("tp"), F.col("fp"), F.col("P")
    return cum.select((F.col("b") / F.lit(float(steps))).alias("threshold"), tp.alias("tp"), fp.alias("fp"),
                      F.when(tp + fp > 0, tp / (tp + fp)).alias("precision"), (tp / P).alias("recall"),
                      F.when(tp > 0, 2 * tp / (tp + fp + P)).otherwise(F.lit(0.0)).alias("f1"))


# M10, M11 -------------------------------------------------------------------------------------
def feature_importance(model: PipelineModel, dummies: str = "drop") -> list[tuple[str, float]]:
    """Tree-model importances zipped with the assembler's feature names, largest first.

    ``dummies``: ``"drop"`` leaves out one-hot dummy features (only original
    features remain), ``"sum"`` adds each column's dummies back onto the
    column, ``"keep"`` lists every dummy as ``column=level``.
    """
    last = model.stages[-1]
    names = _feature_names(model)
    imp = last.featureImportances.toArray()
    if len(names) != len(imp):
        raise ValueError(f"{len(names)} feature names for {len(imp)} importances")
    pairs = list(zip(names, imp))
    if dummies == "drop":
        pairs = [(n, v) for n, v in pairs if "__ohe" not in n]
    elif dummies == "sum":
        agg: dict[str, float] = {}
        for n, v in pairs:
            base = n.split("__ohe")[0]
            agg[base] = agg.get(base, 0.0) + v
        pairs = list(agg.items())
    elif dummies != "keep":
        raise ValueError("dummies is drop, sum or keep")
    clean = [(n.split("__imp")[0].split("__vec")[0].replace("__ohe=", "="), float(v)) for n, v in pairs]
    return sorted(clean, key=lambda t: (-t[1], t[0]))


def _feature_names(model: PipelineModel) -> list[str]:
    assembler = [s for s in model.stages if isinstance(s, VectorAssembler) or s.__class__.__name__ == "VectorAssembler"][0]
    names = []
    indexers = {s.getOutputCol(): s for s in model.stages if s.__class__.__name__ == "StringIndexerModel"}
    for c in assembler.getInputCols():
        if c.endswith("__ohe"):
            base = c[: -len("__ohe")]
            # handleInvalid="keep" appends an "unseen" index last and dropLast removes exactly
            # that slot, so the one-hot slots are the labels in index order
            names += [f"{base}__ohe={lab}" for lab in indexers[f"{base}__idx"].labels]
        else:
            names.append(c)
    return names


def save_model(model: PipelineModel, base_path: str, version: int) -> str:
    """Models are stored as ``{base}/v{version}``; retraining writes a new version."""
    path = f"{base_path.rstrip('/')}/v{version}"
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
