"""Every model and fitted step scores raw rows after loading as it did before saving."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import clean, encode, models, scale
from millrace.operators.neighbours import NeighbourFill
from millrace.operators.persist import Chain, ChainedModel
from millrace.plans import workflow

SMALL = {"n_estimators": 2, "max_depth": 1, "n_neighbors": 3, "max_iter": 5, "width": 4}


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(i, float(i % 17), None if i % 9 == 0 else float(i * 7 % 23), "xyz"[i % 3] if i % 11 else None, i % 2, i % 17 * 2.0 + i % 3) for i in range(240)]
    return spark.createDataFrame(rows, "id int, a double, b double, s string, label int, y double")


def rounded(df, key="id"):
    return sorted((r[key], round(r.prediction, 9)) for r in df.select(key, "prediction").collect())


def saved_again(model, path):
    models.save_model(model, path)
    return models.load_model(path)


@pytest.mark.parametrize("task,name", [("regression", n) for n in models.REGRESSORS] + [("classification", n) for n in models.CLASSIFIERS])
def test_round_trip(raw, tmp_path, task, name):
    target = "y" if task == "regression" else "label"
    model = models.fit_model(raw.fillna(0.0), ["a", "b"], target, name, SMALL, task, "id")
    again = saved_again(model, str(tmp_path))
    want, got = models.predict(model, raw.fillna(0.0)), models.predict(again, raw.fillna(0.0))
    assert rounded(got) == rounded(want) and got.columns == want.columns


def test_an_earlier_model_is_replaced(raw, tmp_path):
    for name in ("ridge", "lasso"):
        saved_again(models.fit_model(raw.fillna(0.0), ["a"], "y", name, {"alpha": 1.0}), str(tmp_path))
    want = models.fit_model(raw.fillna(0.0), ["a"], "y", "lasso", {"alpha": 1.0})
    assert models.load_model(str(tmp_path)) == want


@pytest.mark.parametrize("name", ["ridge", "adaboost"])
def test_chain_of_every_kind_of_step(raw, tmp_path, name):
    chain, df = Chain(), raw
    df = chain.add(df, NeighbourFill("id", ["a", "b"], raw, 3))
    df = chain.add(df, clean.impute(df, {"s": "mode"}, columns=["s"]))
    df = chain.add(df, scale.scale_standard(df, ["a"]))
    for made in (encode.target_encode(df, "s", "y", "by_target"), encode.count_encode(df, "s")):
        df = chain.add(df, made)
    whole = ChainedModel(chain, models.fit_model(df, ["a", "b", "s", "by_target"], "y", name, SMALL, "regression", "id"))
    again = saved_again(whole, str(tmp_path))
    assert rounded(again.transform(raw)) == rounded(whole.transform(raw))


@pytest.mark.parametrize("name", ["ridge", "bagging"])
def test_runs_keep_their_preprocessing(raw, tmp_path, name):
    run = workflow.regression_run(raw.drop("label"), "y", "id", name, SMALL)
    scored = saved_again(run.model, str(tmp_path)).transform(raw)
    held = {k for k, _ in rounded(run.predictions)}
    assert [r for r in rounded(scored) if r[0] in held] == rounded(run.predictions)


def test_classification_run_keeps_its_preprocessing(raw, tmp_path):
    df = raw.withColumn("label", (F.col("a") > 8).cast("int")).drop("y")
    model, scored, _ = workflow.classification_run(df, "label", "id", "adaboost", SMALL, imputer="knn", imbalance=None, n_features=None)
    again = saved_again(model, str(tmp_path)).transform(df)
    held = {k for k, _ in rounded(scored)}
    assert [r for r in rounded(again) if r[0] in held] == rounded(scored)
    assert models.importances(model, ["a", "b", "s"])
