"""No cap, prefix or size switch changes a result."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions.hashing import poisson_times
from millrace.operators import convert, encode, evaluate, hypothesis, models, neighbours, tuning
from millrace.plans import workflow


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(6000).selectExpr(
        "id", "concat('g', lpad(cast(id % 1200 as string), 4, '0')) as g", "cast(pmod(hash(id), 997) as double) as x", "id as o"
    ).cache()


def test_paired_test_takes_the_two_smallest_of_many_labels(labelled):
    pairs = hypothesis.paired_by_order(labelled, "g", "x", "o")
    want = labelled.where("g in ('g0000', 'g0001')").groupBy().pivot("g").agg(F.sum("x")).first()
    assert tuple(pairs.agg(F.sum("x0"), F.sum("x1")).first()) == tuple(want)


def test_kruskal_and_anova_of_many_groups(labelled):
    rows = labelled.select("g", "x").collect()
    values = np.array([r.x for r in rows])
    ordered = np.sort(values)
    ranks = (np.searchsorted(ordered, values, "left") + np.searchsorted(ordered, values, "right") + 1) / 2
    groups: dict = {}
    for r, k, v in zip(rows, ranks, values):
        groups.setdefault(r.g, []).append((k, v))
    n = len(rows)
    h = 12 / (n * (n + 1)) * sum(sum(k for k, _ in g) ** 2 / len(g) for g in groups.values()) - 3 * (n + 1)
    ties = sum(c**3 - c for c in np.unique(values, return_counts=True)[1].astype(float))
    got = hypothesis.kruskal(labelled, "g", "x")
    assert got["statistic"] == pytest.approx(h / (1 - ties / (n**3 - n))) and got["dof"] == 1199
    grand = values.mean()
    between = sum(len(g) * (np.mean([v for _, v in g]) - grand) ** 2 for g in groups.values())
    within = sum(((np.array([v for _, v in g]) - np.mean([v for _, v in g])) ** 2).sum() for g in groups.values())
    assert hypothesis.anova(labelled, "g", "x")["statistic"] == pytest.approx((between / 1199) / (within / (n - 1200)))


def test_chi_square_of_many_cells(spark):
    df = spark.range(4000).selectExpr("cast(id % 800 as string) as a", "cast(pmod(hash(id), 700) as string) as b")
    rows = [(r.a, r.b) for r in df.collect()]
    na, nb, cells = {}, {}, {}
    for a, b in rows:
        na[a], nb[b], cells[a, b] = na.get(a, 0) + 1, nb.get(b, 0) + 1, cells.get((a, b), 0) + 1
    want = sum(o * o / (na[a] * nb[b] / 4000) for (a, b), o in cells.items()) - 4000
    got = hypothesis.chi2_contingency(df, "a", "b")
    assert got["statistic"] == pytest.approx(want) and got["dof"] == (len(na) - 1) * (len(nb) - 1)
    small = spark.createDataFrame([("p", "u")] * 7 + [("q", "u")] * 2 + [("q", "v")] * 5, "a string, b string")
    cell = {("p", "u"): 7, ("p", "v"): 0, ("q", "u"): 2, ("q", "v"): 5}
    exp = {k: {"p": 7, "q": 7}[k[0]] * {"u": 9, "v": 5}[k[1]] / 14 for k in cell}
    want = sum((abs(cell[k] - exp[k]) - min(0.5, abs(cell[k] - exp[k]))) ** 2 / exp[k] for k in cell)
    assert hypothesis.chi2_contingency(small, "a", "b")["statistic"] == pytest.approx(want)


def test_exact_u_distribution():
    import itertools

    for n1, n2 in ((1, 1), (2, 3), (3, 3), (4, 6)):
        everything = [sum(c) - n1 * (n1 + 1) / 2 for c in itertools.combinations(range(1, n1 + n2 + 1), n1)]
        for u in sorted(set(everything)):
            reach = max(u, n1 * n2 - u)
            want = min(1.0, 2 * sum(x >= reach for x in everything) / len(everything))
            assert hypothesis._exact_u_p(u, n1, n2) == pytest.approx(want, abs=1e-12)
            assert hypothesis._exact_u_p(u, n2, n1) == pytest.approx(want, abs=1e-12)
    assert 0 < hypothesis._exact_u_p(9000, 8, 5000) < 0.02


def test_classes_are_kept_or_refused(spark, monkeypatch):
    df = spark.range(2400).selectExpr("cast(id % 1200 as double) as y")
    assert models._classes(df) == [float(i) for i in range(1200)]
    monkeypatch.setattr(models, "MAX_CLASSES", 100)
    with pytest.raises(ValueError):
        models._classes(df)


def test_three_classes_and_weighted_f1(spark):
    df = spark.range(240).selectExpr(
        "id", "cast(id % 3 as double) as y", "(id % 3) * 2.0 + pmod(hash(id), 100) / 60.0 as a", "pmod(hash(id, 1), 100) / 50.0 as b"
    )
    model = models.fit_model(df, ["a", "b"], "y", "linear_svc", {}, "classification", "id")
    assert models.predict(model, df).where("prediction = y").count() > 120
    found = tuning.grid_search(
        df, ["a", "b"], "y", "gbt", {"n_estimators": [2], "max_depth": [2]}, cv=2, task="classification", metric="f1", key="id", refit=False
    )
    assert 0.5 < found.best_score <= 1.0
    preds = spark.createDataFrame(
        [(0, 0.0, 0.0), (0, 0.0, 1.0), (0, 1.0, 1.0), (0, 2.0, 1.0), (1, 1.0, 1.0)], f"{tuning.FOLD} int, y double, p double"
    )
    f1 = (2 * (2 * 1 / 3) + 1 * (2 * 1 / 4) + 0) / 4
    assert tuning._loop_score(preds, "f1") == pytest.approx([f1, 1.0])
    assert tuning._loop_score(preds, "recall") == pytest.approx([0.5, 1.0])
    assert tuning._loop_score(preds, "precision") == pytest.approx([(2 * 1 + 1 / 3) / 4, 1.0])


def test_auc_of_searches_equals_the_exact_one(spark):
    df = spark.range(5000).selectExpr("id", "cast(pmod(hash(id), 2) as double) as y", "pmod(hash(id, 3), 100000) / 7e4 + 0.4 * pmod(hash(id), 2) as a")
    model = models.fit_model(df, ["a"], "y", "logistic", {}, "classification", "id")
    scored = models.predict(model, df)
    assert tuning.evaluator("roc_auc", "y").evaluate(scored.withColumnRenamed("score", "rawPrediction")) == pytest.approx(evaluate.roc_auc(scored, "y", "score").first()[0], abs=1e-9)


def test_depth_beyond_the_engine_is_told_and_bins_are_a_parameter():
    with pytest.warns(UserWarning, match="30 levels"):
        models.spark_params("random_forest", {"max_depth": 50}, "regression")
    assert models.spark_params("tree", {"max_bins": 256}, "regression") == {"maxBins": 256}
    assert tuning.narrowed_grid({"learning_rate": 1.0})["learning_rate"] == [0.8, 1.0]


def test_bagging_does_not_depend_on_partitions(spark):
    df = spark.range(300).selectExpr("id", "cast(pmod(hash(id), 50) as double) as a", "cast(pmod(hash(id), 50) * 2 + id % 3 as double) as y")
    picks = []
    for parts in (1, 7):
        model = models.fit_model(df.repartition(parts), ["a"], "y", "bagging", {"n_estimators": 3, "max_samples": 0.7}, "regression", "id")
        picks.append(sorted((r.id, round(r.prediction, 9)) for r in models.predict(model, df).collect()))
    assert picks[0] == picks[1]


def test_poisson_numbers(spark):
    us = [random.Random(1).random() for _ in range(200)] + [0.0, 1 - 2.0**-52]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in us], "u double").select(poisson_times(F.col("u"), 0.7)).collect()]
    for u, k in zip(us, got):
        below = sum(math.exp(-0.7) * 0.7**i / math.factorial(i) for i in range(k))
        assert below <= u + 1e-12 and (u < below + math.exp(-0.7) * 0.7**k / math.factorial(k) or u > 1 - 1e-12)


def test_many_text_values_and_unseen_ones_through_a_run(spark):
    df = spark.range(6000).selectExpr("id", "concat('v', cast(pmod(hash(id), 5000) as string)) as t", "pmod(hash(id), 100) * 1.0 as y", "id % 7 * 1.0 as a")
    run = workflow.regression_run(df, target="y", key="id", model="linear")
    assert run.model.transform(df.limit(5)).select("prediction").count() == 5
    steps = encode.label_steps(df, ["t"])
    values = sorted({r.t for r in df.collect()})
    probe = spark.createDataFrame([(values[3],), ("never seen",)], "t string")
    assert [r.t for r in steps[0].transform(probe).collect()] == [3.0, float(len(values))]
    few = encode.label_steps(df.where("id < 40"), ["t"])[0].transform(probe.where("t = 'never seen'"))
    assert few.first().t == df.where("id < 40").select("t").distinct().count()
    assert convert.group_candidates(df, max_unique_values=len(values)) == ["t"]


def test_neighbour_imputation_uses_the_training_rows(spark):
    train = spark.createDataFrame([(i, float(i), 10.0 * i) for i in range(10)], "id bigint, a double, b double")
    test = spark.createDataFrame([(100, 3.0, None), (101, 3.1, 5000.0)], "id bigint, a double, b double")
    got = neighbours.knn_impute(test, "id", ["a", "b"], k=1, donors_from=train).where("id = 100").first().b
    assert got == 30.0
