"""Trainers that keep their partitions in memory get tasks of bounded size."""

import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from millrace.functions import lineage
from millrace.operators import models, select


@pytest.fixture
def one_task(spark):
    return spark.range(0, 1000, 1, 1).selectExpr("id", "CAST(id % 17 AS DOUBLE) AS a", "CAST(id % 5 AS DOUBLE) AS b", "id * 1.5D AS y")


@pytest.fixture
def asked(monkeypatch):
    """(rows, rows of the largest task, columns) of every table that a tree is fitted on."""
    seen = []
    for kind in (RandomForestRegressor, GBTRegressor, DecisionTreeRegressor):

        def fit(self, df, params=None, real=kind.fit):
            sizes = df.groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.max("count")).first()
            seen.append((*sizes, df.columns))
            return real(self, df, params)

        monkeypatch.setattr(kind, "fit", fit)
    return seen


def test_small_tasks_pass_and_large_ones_are_dealt(spark, one_task):
    assert lineage.bounded(one_task) is one_task and lineage.bounded(one_task.limit(0), 1).count() == 0
    dealt = lineage.bounded(one_task, 100)
    assert dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] <= 110
    assert dealt.exceptAll(one_task).isEmpty() and dealt.count() == 1000
    skewed = one_task.union(spark.range(0, 1000, 1, 500).selectExpr("id", "0D", "0D", "0D"))
    assert lineage.bounded(skewed, 100).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] <= 300


@pytest.mark.parametrize("name", ["random_forest", "gbt", "tree", "adaboost", "bagging"])
def test_trees_get_bounded_tasks(monkeypatch, one_task, asked, name):
    monkeypatch.setattr(lineage, "TASK_ROWS", 200)
    models.fit_model(one_task, ["a", "b"], "y", name, {"n_estimators": 2, "max_depth": 2, "bootstrap": False})
    assert asked and all(n == 1000 and most <= 210 for n, most, _ in asked)
    assert all("id" not in columns for _, _, columns in asked)


def test_elimination_gets_bounded_tasks(monkeypatch, one_task, asked):
    monkeypatch.setattr(lineage, "TASK_ROWS", 200)
    picked = select.rfe(one_task.withColumn("c", F.col("id") % 3), "y", 1, features=["a", "b", "c"], estimator=RandomForestRegressor(numTrees=2, maxDepth=2, seed=1))
    assert [n for n, _, _ in asked] == [1000, 1000] and all(most <= 210 for _, most, _ in asked)
    assert sorted(picked.scores.values()) == [1.0, 2.0, 3.0]
