"""Models, selection, tuning, whole runs and sinks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import models, select, split, tuning
from millrace.plans import workflow
from millrace.sources import generate, sinks


@pytest.fixture(scope="module")
def linear_data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3)) * [1.0, 2.0, 0.5]
    y = 3.0 + x @ [1.5, -2.0, 0.0] + rng.normal(size=200) * 0.3
    rows = [(i, *map(float, r), float(v), int(v > 3)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, c double, y double, label int").repartition(4).persist()
    return df, x, y


FEATS = ["a", "b", "c"]


def coefs(model):
    return np.array(models.inner_model(model).coefficients.toArray())


def test_penalties_match_their_textbook_objectives(linear_data):
    df, x, y = linear_data
    xc, yc, n = x - x.mean(0), y - y.mean(), len(y)
    assert np.allclose(coefs(models.fit_model(df, FEATS, "y", "linear")), np.linalg.lstsq(xc, yc, rcond=None)[0], atol=1e-6)
    ridge = np.linalg.solve(xc.T @ xc + 20.0 * np.eye(3), xc.T @ yc)
    assert np.allclose(coefs(models.fit_model(df, FEATS, "y", "ridge", {"alpha": 20.0})), ridge, atol=1e-4)

    def descend(l1, l2):
        w = np.zeros(3)
        for _ in range(500):
            for j in range(3):
                r = yc - xc @ w + xc[:, j] * w[j]
                rho = xc[:, j] @ r / n
                w[j] = np.sign(rho) * max(abs(rho) - l1, 0) / (xc[:, j] @ xc[:, j] / n + l2)
        return w

    assert np.allclose(coefs(models.fit_model(df, FEATS, "y", "lasso", {"alpha": 0.3})), descend(0.3, 0.0), atol=1e-4)
    net = models.fit_model(df, FEATS, "y", "elastic_net", {"alpha": 0.4, "l1_ratio": 0.25})
    assert np.allclose(coefs(net), descend(0.1, 0.3), atol=1e-4)


@pytest.mark.parametrize(
    "name, params, floor",
    [
        ("random_forest", {"n_estimators": 10, "max_depth": 5}, 0.7),
        ("xgboost", {"n_estimators": 15, "max_depth": 3, "learning_rate": 0.3}, 0.8),
        ("adaboost", {"n_estimators": 4}, 0.6),
        ("bagging", {"n_estimators": 4, "max_features": 0.7, "max_depth": 6}, 0.5),
        ("knn", {"n_neighbors": 3, "weights": "distance"}, 0.9),
        ("svr", {"width": 64, "max_iter": 30}, 0.5),
    ],
)
def test_regressors_learn(linear_data, name, params, floor):
    df, _, _ = linear_data
    out = models.predict(models.fit_model(df, FEATS, "y", name, params, key="id"), df)
    assert out.count() == 200
    r2 = 1 - out.agg(F.avg((F.col("y") - F.col("prediction")) ** 2) / F.var_pop("y")).collect()[0][0]
    assert r2 > floor


@pytest.mark.parametrize("name", ["logistic", "random_forest", "lightgbm", "adaboost", "bagging", "linear_svc"])
def test_classifiers_learn(linear_data, name):
    df, _, _ = linear_data
    params = {"n_estimators": 4, "max_iter": 20, "max_depth": 4}
    out = models.predict(models.fit_model(df, FEATS, "label", name, params, "classification"), df)
    assert out.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).collect()[0][0] > 0.8
    assert "score" in out.columns


def test_weighted_median_combination(spark):
    trees = models.AveragedTrees([], [], [], [1.0, 1.0, 5.0], "median")
    df = spark.createDataFrame([(1.0, 9.0, 4.0)], "p double, q double, r double")
    assert df.select(trees._combined([F.col("p"), F.col("q"), F.col("r")])).collect()[0][0] == 4.0


def test_parameter_translation():
    assert models.spark_params("xgboost", {"n_estimators": 5, "gamma": None, "reg_alpha": 1, "colsample_bytree": 0.8}, "regression") == {"maxIter": 5, "featureSubsetStrategy": "0.8"}
    assert models.spark_params("random_forest", {"max_depth": 50, "mode.x": 1}, "regression") == {"maxDepth": 30}
    with pytest.raises(ValueError):
        models.fit_model(None, [], "y", "nothing")
    assert len(tuning.sample_candidates({"a": [1, 2], "b": [3, 4]}, 10)) == 4
    draws = tuning.sample_candidates({"d": ("int", 3, 6), "r": ("uniform", 0.1, 0.2)}, 20)
    assert all(3 <= d["d"] < 6 and 0.1 <= d["r"] <= 0.3 for d in draws)
    assert tuning.narrowed_grid({"n_estimators": 10, "max_depth": 1})["max_depth"] == [1, 2]


def test_selection_methods(linear_data, spark):
    df, x, y = linear_data
    assert select.kbest(df, "y", 2, features=FEATS).selected == ["a", "b"]
    assert select.lasso_select(df, "y", 0.3, features=FEATS).selected == ["a", "b"]
    assert select.lasso_select(df, "y", 1e9, features=FEATS).selected != []
    auto = select.lasso_select(df, "y", None, features=FEATS, key="id")
    assert {"a", "b"} <= set(auto.selected) and auto.extra["alpha"] > 0
    assert select.ridge_select(df, "y", features=FEATS).selected == ["a", "b"]
    from pyspark.ml.regression import RandomForestRegressor

    got = select.rfe(df, "y", 1, features=FEATS, estimator=RandomForestRegressor(numTrees=5, maxDepth=4, seed=1))
    assert got.scores["b"] == 1.0 and sorted(got.scores.values()) == [1.0, 2.0, 3.0]
    assert select.forest_select(df, "y", 1, FEATS, n_estimators=5, max_depth=4).selected == ["b"]
    doubled = df.withColumn("a2", F.col("a") * 2 + F.col("c") * 0.01)
    vif = select.vif_select(doubled, 5.0, features=["a", "a2", "b", "c"])
    assert len(vif.removed) == 1 and vif.extra["removed_vif"] and max(vif.extra["final_vif"].values()) <= 5.0
    twin = df.withColumn("a2", F.col("a"))
    assert len(select.vif_select(twin, 5.0, features=["a", "a2", "b"]).selected) == 2
    scores = select.knn_score_select(df, "y", "id", 1, features=["a", "b"])
    order = {}
    for j, name in enumerate("ab"):
        pred = []
        for i in range(200):
            near = sorted(range(200), key=lambda m: (abs(x[m, j] - x[i, j]), m))[:5]
            pred.append(y[near].mean())
        order[name] = 1 - ((y - pred) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert scores.scores == pytest.approx(order)
    with pytest.raises(ValueError):
        select.select_features(df, "y", "nothing")


def test_search_prefers_the_better_setting(linear_data):
    df, _, _ = linear_data
    got = tuning.grid_search(df, FEATS, "y", "lasso", {"alpha": [0.001, 5.0]}, cv=3, key="id")
    assert got.best_params == {"alpha": 0.001}
    loop = tuning.grid_search(df, FEATS, "y", "ridge", {"alpha": [0.1, 1e5]}, cv=2, key="id")
    assert loop.best_params == {"alpha": 0.1} and loop.table.count() == 2
    auc = tuning.grid_search(df, FEATS, "label", "logistic", {"C": [1.0]}, cv=2, key="id", task="classification")
    assert 0.8 < auc.best_score <= 1.0


def test_bootstrap_sizes(spark):
    n = tuning.bootstrap(spark.range(5000), "id", "s").count()
    assert 4700 < n < 5300


def test_full_regression_run_saves_its_preprocessing(spark, tmp_path):
    base = generate.gen_regression(generate.keyed_rows(spark, 400), "row_id", 3, 1, 1, 1, 1)
    df = generate.inject_missing(base, "row_id", ["float_feature_0", "cat_feature_0"], 0.1)
    run = workflow.regression_run(
        df, "target", "row_id", "ridge", grid={"alpha": [0.1, 10.0]}, tune="grid", selection="k_best", selection_params={"k": 4},
        features={"interactions": {"feature_pairs": [["float_feature_0", "int_feature_0"]]}}, cv=2, full_evaluation=True,
    )
    row = run.results.collect()[0]
    assert row["test_r2"] > 0.5 and run.best_params["alpha"] in (0.1, 10.0) and len(run.selection.selected) == 4
    path = str(tmp_path / "model")
    models.save_model(run.model, path)
    again = workflow.evaluate_saved(path, df.where("target IS NOT NULL"), "target", "row_id")
    assert again.collect()[0]["error_metrics"]["r2"] > 0.5
    sinks.write_results(run.results, str(tmp_path / "results"))
    sinks.write_results(run.results, str(tmp_path / "csv"), "csv")
    assert spark.read.parquet(str(tmp_path / "results")).count() == 1
    assert "param_alpha" in spark.read.option("header", True).csv(str(tmp_path / "csv")).columns
    sinks.write_run_record(spark, str(tmp_path / "log"), "r", {"model": "ridge", "params": run.best_params})
    assert spark.read.json(str(tmp_path / "log")).count() == 1
    sinks.write_evaluation(run.evaluation, str(tmp_path / "eval"))
    assert "durbin" not in spark.read.text(str(tmp_path / "eval")).collect()[0][0] and "error_metrics" in spark.read.text(str(tmp_path / "eval")).collect()[0][0]


@pytest.mark.parametrize("imbalance, encoder", [("smote", "target"), (None, "count")])
def test_classification_run(spark, imbalance, encoder):
    df = generate.gen_classification(generate.keyed_rows(spark, 300), "row_id", 4, 1, 1)
    df = df.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("row_id") % 90).cast("int")))
    _, scored, report = workflow.classification_run(
        df, "target", "row_id", "random_forest", {"n_estimators": 5, "max_depth": 4}, n_features=6, imbalance=imbalance, encoder=encoder
    )
    metrics = {r["metric"]: r["value"] for r in report.collect()}
    assert scored.count() == 60 and metrics["roc_auc"] > 0.5


def test_preprocessor_is_fitted_on_train_only(spark):
    df = spark.createDataFrame([(i, float(i), None if i % 5 == 0 else "ab"[i % 2]) for i in range(40)], "id bigint, x double, c string")
    train, test = split.parts(split.split_random(df, "id", 0.5))
    prep = workflow.fit_preprocessor(train, exclude=["id"], encode_labels=True)
    m = train.agg(F.avg("x"), F.stddev_pop("x")).collect()[0]
    row = test.limit(1).collect()[0]
    got = prep.transform(test.where(F.col("id") == row["id"])).collect()[0]
    assert got["x"] == pytest.approx((row["x"] - m[0]) / m[1])
    assert prep.feature_names(df) == ["id", "x", "c"] and "x" in prep.scalers()


def test_boosting_stops_early_and_repeats(spark):
    rows = spark.range(4000).selectExpr("CAST(id % 50 AS DOUBLE) AS a", "CAST(id % 50 > 20 AS INT) AS y")
    given = {"n_estimators": 15, "max_depth": 2, "max_bins": 64}
    trees = lambda more, task: models.fit_model(rows, ["a"], "y", "gbt", {**given, **more}, task=task).stages[-1].getNumTrees
    assert trees({}, "regression") == 15
    assert trees({"n_iter_no_change": 5}, "regression") < 15
    assert trees({"early_stopping_rounds": 5, "tol": 10.0}, "classification") < 15
    held = rows.withColumn("h", models._held(rows, ["a"], "y", 0.3))
    assert held.groupBy("a").agg(F.count_distinct("h").alias("n")).where("n > 1").count() == 0
    assert 0 < held.where("h").count() < 4000
