"""Cross-validation fits the feature stages on each fold's training rows."""

from pyspark.ml.feature import Imputer

from tessera.operators import models as M


def test_held_out_rows_do_not_reach_the_imputer(spark, monkeypatch):
    rows = [(float(i) if i % 4 else None, "ab"[i % 2], float(i % 3 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "x double, g string, y double")
    seen = []
    fit = Imputer._fit
    monkeypatch.setattr(Imputer, "_fit", lambda self, data: seen.append(data.count()) or fit(self, data))
    model, metrics = M.cross_validate(df, "y", "BINARY_CLASSIFICATION", ["x", "g"], "decision_tree",
                                      {"maxDepth": [2]}, folds=3)
    folds = [n for n in seen if n < 60]
    assert len(folds) == 3 and sum(folds) == 2 * 60  # each row is held out once
    assert len(metrics) == 1 and model.bestModel.transform(df.withColumnRenamed("y", "label")).count() == 60


def test_mlp_sizes_with_a_level_in_one_fold_only(spark):
    rows = [(float(i), "rare" if i == 0 else "ab"[i % 2], float(i % 3 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "x double, g string, y double")
    _, metrics = M.cross_validate(df, "y", "BINARY_CLASSIFICATION", ["x", "g"], "mlp", {"maxIter": [2]}, folds=3)
    assert len(metrics) == 1
