"""Regressions keep incomplete rows, and a Poisson model its zero counts."""

import math

import pytest

from tessera.operators import stats as T
from tessera.queries import REGISTRY, load_all, q_stats

ROWS = [(i, 1.0 + 2.0 * i + i % 3, float(i), "ab"[i % 2], float(i * 7 % 5 > 1)) for i in range(20)]
HOLES = [(20, 5.0, None, "a", 1.0), (21, 5.0, math.nan, "b", 0.0), (22, None, 3.0, "a", None)]
SCHEMA = "id int, y double, x double, g string, b double"


@pytest.mark.parametrize("fit,target", [(T.linear_regression, "y"), (T.logistic_regression, "b"), (T.genmod, "y")])
def test_incomplete_rows_are_kept(spark, fit, target):
    df = spark.createDataFrame(ROWS + HOLES, SCHEMA)
    m = fit(df, target, ["x", "g"], categorical=["g"])
    out = {r.id: r for r in m.transform(df).collect()}
    assert sorted(out) == list(range(23))
    assert [i for i in out if out[i].prediction is None] == [20, 21]
    if fit is T.logistic_regression:
        assert out[20].probability is None and out[0].probability is not None
    # the incomplete rows do not change the fit
    whole = fit(spark.createDataFrame(ROWS, SCHEMA), target, ["x", "g"], categorical=["g"])
    for (_, a), (_, b) in zip(T.coefficients(m, ["x"]), T.coefficients(whole, ["x"])):
        assert abs(a - b) < 1e-9


def test_genmod_counts_customers_without_orders(spark, monkeypatch):
    load_all()
    customer = spark.createDataFrame([(i, None if i == 9 else 10.0 * i, "xy"[i % 2]) for i in range(40)],
                                     "c_custkey int, c_acctbal double, c_mktsegment string")
    orders = spark.createDataFrame([(i,) for i in range(1, 40) if i % 4 for _ in range(i % 4)], "o_custkey int")
    frames = {"customer": customer, "orders": orders}
    monkeypatch.setattr(q_stats, "table", lambda spark, d, name: frames[name])
    out = {r.c_custkey: r for r in REGISTRY["t08_genmod_poisson"](spark, "").collect()}
    assert sorted(out) == list(range(40))
    assert out[8].n_orders == 0.0 and out[8].prediction > 0
    assert out[9].n_orders == 1.0 and out[9].prediction is None
    # a Poisson fit with an intercept meets the total of the rows it was fitted on, zeros among them
    fitted = [r for r in out.values() if r.prediction is not None]
    assert abs(sum(r.prediction for r in fitted) - sum(r.n_orders for r in fitted)) < 1e-3
