"""Penalised regressions from cross products: optimality conditions, direct cross-validation, Spark's solver."""

import numpy as np
import pytest
from pyspark.ml import Pipeline

from millrace.operators import models, penalised, select, tuning

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(600, 4)) * [1, 5, 0.2, 1] + [100, -3, 0, 1e4]
    x[:, 3] = 7.0  # a constant
    y = 3 * x[:, 0] - 0.5 * x[:, 1] + draw.normal(size=600) + 40
    table = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "id int, a double, b double, c double, d double, y double")
    return x, y, table.repartition(5)


def objective_gradient(x, y, b, b0, name, params):
    """Derivative of the smooth part of the objective, and the weight of the absolute values."""
    n, e = len(y), y - b0 - x @ b
    alpha, r = params["alpha"], {"lasso": 1.0}.get(name, params.get("l1_ratio", 0.0))
    if name == "ridge":
        return -x.T @ e / n + alpha / n * b, 0.0
    return -x.T @ e / n + alpha * (1 - r) * b, alpha * r


@pytest.mark.parametrize("intercept", [True, False])
@pytest.mark.parametrize("name,params", [("ridge", {"alpha": 30.0}), ("lasso", {"alpha": 0.4}), ("elastic_net", {"alpha": 0.5, "l1_ratio": 0.3})])
def test_optimality(rows, name, params, intercept):
    x, y, df = rows
    model = models.fit_model(df, NAMES, "y", name, {**params, "fit_intercept": intercept})
    b = model.coefficients.toArray()
    g, l1 = objective_gradient(x, y, b, model.intercept, name, params)
    free = b != 0
    assert np.abs(g[free] + l1 * np.sign(b[free])).max() < 1e-6
    assert (np.abs(g[~free]) <= l1 + 1e-6).all()
    if intercept:
        assert abs((y - model.intercept - x @ b).mean()) < 1e-8
    scored = models.predict(model, df).orderBy("id").collect()
    assert np.allclose([r.prediction for r in scored], x @ b + model.intercept)


def test_as_the_iterative_solver(rows):
    x, y, df = rows
    est = models.native_estimator("lasso", {"alpha": 0.4, "max_iter": 1000}, target="y")
    theirs = Pipeline(stages=[models.assembler(NAMES), est]).fit(df).stages[-1]
    mine = models.fit_model(df, NAMES, "y", "lasso", {"alpha": 0.4})
    assert np.allclose(mine.coefficients.toArray(), theirs.coefficients.toArray(), atol=1e-4)


@pytest.mark.parametrize("metric", ["mse", "rmse", "r2", "mae"])
def test_search_reads_the_table_twice(rows, monkeypatch, metric):
    x, y, df = rows
    scans = []
    added = penalised.tree_sum
    monkeypatch.setattr(penalised, "tree_sum", lambda parts: scans.append(1) or added(parts))
    grid = {"alpha": [0.01, 0.5, 2.0], "l1_ratio": [0.2, 0.9], "fit_intercept": [True]}
    got = tuning.grid_search(df, NAMES, "y", "elastic_net", grid, cv=3, metric=metric, key="id")
    assert len(scans) == (2 if metric == "mae" else 1)  # beside one aggregate of means
    fold = {r.id: r[tuning.FOLD] for r in tuning.with_folds(df, "id", 3, 42).collect()}
    fold = np.array([fold[i] for i in range(len(y))])
    table = {tuple(sorted(r.params.items())): r.score for r in got.table.collect()}
    for c in tuning.combinations_of(grid):
        each = []
        for f in range(3):
            b, b0 = direct(x[fold != f], y[fold != f], c)
            e, t = (y - b0 - x @ b)[fold == f], y[fold == f]
            each.append({"mse": (e**2).mean(), "rmse": (e**2).mean() ** 0.5, "mae": np.abs(e).mean(), "r2": 1 - (e**2).sum() / ((t - t.mean()) ** 2).sum()}[metric])
        assert table[tuple(sorted((k, str(v)) for k, v in c.items()))] == pytest.approx(np.mean(each), rel=1e-6, abs=1e-9)
    assert got.model.coefficients.size == 4


def direct(x, y, params):
    """Elastic net by coordinate descent on centred rows."""
    mx, my = x.mean(axis=0), y.mean()
    q, c = (x - mx).T @ (x - mx) / len(y), (x - mx).T @ (y - my) / len(y)
    l1, l2 = params["alpha"] * params["l1_ratio"], params["alpha"] * (1 - params["l1_ratio"])
    b = np.zeros(x.shape[1])
    for _ in range(300):
        for j in range(len(b)):
            pull = c[j] - q[j] @ b + q[j, j] * b[j]
            b[j] = np.sign(pull) * max(abs(pull) - l1, 0) / (q[j, j] + l2)
    return b, my - mx @ b


def test_lasso_select_chooses_its_penalty(rows):
    _, _, df = rows
    found = select.lasso_select(df, "y", alpha=None, features=NAMES, key="id")
    assert set(found.selected) >= {"a", "b"} and "d" not in found.selected and found.extra["alpha"] < 1


def test_missing_values_are_refused(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, y double")
    with pytest.raises(ValueError, match="missing"):
        models.fit_model(df, ["a"], "y", "ridge")
