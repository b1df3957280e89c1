"""Metrics at the f1-best threshold and calibration loss against plain Python."""

import numpy as np

from tessera.operators import models as M


def test_rare_positives_under_one_half(spark):
    rng = np.random.default_rng(5)
    s = np.round(rng.random(300) * 0.4, 2)  # no score reaches 0.5
    y = (rng.random(300) < s * 0.5).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(s, y)], "s double, y double")
    r = M.binary_metrics(df, "s", "y").first()

    def f1(t):
        return 2 * y[s >= t].sum() / ((s >= t).sum() + y.sum())

    t = max(set(s), key=lambda t: (f1(t), t))
    assert r.precision is None and r.recall == 0.0 and r.optimal_threshold == t
    precision = y[s >= t].mean()
    want = {"precision": precision, "recall": y[s >= t].sum() / y.sum(), "f1": f1(t), "lift": precision / y.mean()}
    for k, v in want.items():
        assert abs(r[f"optimal_{k}"] - v) < 1e-12
    order = np.lexsort((y, -s))
    gaps = [abs(s[b].mean() - y[b].mean()) for b in np.array_split(order, 10)]
    assert abs(M.calibration_loss(df, "s", "y", 10).first()[0] - np.mean(gaps)) < 1e-12


def test_no_positives(spark):
    r = M.binary_metrics(spark.createDataFrame([(0.2, 0.0), (0.7, 0.0)], "s double, y double"), "s", "y").first()
    assert r.auc is None and r.recall is None and r.optimal_threshold is None and r.optimal_f1 is None
