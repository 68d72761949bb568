"""Fitted chains and models on storage: JSON state, Parquet tables and Spark ML folders.

A folder holds ``state`` (one JSON line, written last) and what it names: tables of encoders and donors, the
rows of a nearest-neighbour model, the trees of an averaged model, the steps and the model of a chain.
Everything is written and read by Spark, so it may lie in any store.  A plain Spark ML pipeline is saved as
such and any Spark program can load it.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col
from ..functions.steps import ColumnStep
from .encode import ValueEncoder
from .models import AveragedTrees, NeighbourModel
from .neighbours import NeighbourFill
from .penalised import LinearModel


@dataclass
class Chain:
    """Fitted steps applied in order."""

    steps: list[Any] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        for s in self.steps:
            df = s.transform(df)
        return df

    def add(self, df: DataFrame, step: Any) -> DataFrame:
        self.steps.append(step)
        return step.transform(df)

    def is_pipeline(self) -> bool:
        """Whether all steps are expressions, which a saved pipeline can hold."""
        return all(isinstance(s, ColumnStep) for s in self.steps)

    def stages(self) -> list:
        return [s.stage() for s in self.steps if isinstance(s, ColumnStep) and (s.exprs or s.drop or s.where)]


@dataclass
class ChainedModel:
    """A model behind its preprocessing; it scores raw rows."""

    chain: Chain
    model: Any

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.chain.transform(df))


def _state(spark: SparkSession, path: str, **state: Any) -> None:
    line = json.dumps(state, default=str)
    spark.range(1).select(F.lit(line).alias("value")).write.mode("overwrite").text(f"{path}/state")


def _table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save(model: Any, path: str) -> None:
    """Write a model, a step or a chain; an earlier one in the folder is replaced."""
    spark = SparkSession.active()
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
        return
    if isinstance(model, ChainedModel):
        save(model.chain, f"{path}/chain")
        save(model.model, f"{path}/model")
        _state(spark, path, kind="chained")
    elif isinstance(model, Chain):
        for i, step in enumerate(model.steps):
            save(step, f"{path}/step-{i}")
        _state(spark, path, kind="chain", steps=len(model.steps))
    elif isinstance(model, ColumnStep):
        _state(spark, path, kind="columns", step=model.to_json())
    elif isinstance(model, LinearModel):
        _state(spark, path, kind="linear", **asdict(model))
    elif isinstance(model, ValueEncoder):
        _table(model.table, f"{path}/table")
        _state(spark, path, kind="values", column=model.column, output=model.output, default=model.default, small=model.small)
    elif isinstance(model, NeighbourFill):
        _table(model.donors.select(col(model.key), *[col(c) for c in model.columns]), f"{path}/table")
        _state(spark, path, kind="fill", key=model.key, columns=model.columns, k=model.k)
    elif isinstance(model, NeighbourModel):
        _table(model.train.select(col(model.key), *[col(c) for c in model.features], col(model.target)), f"{path}/table")
        _state(spark, path, kind="neighbours", key=model.key, features=model.features, target=model.target, params=model.params)
    elif isinstance(model, AveragedTrees):
        PipelineModel(model.trees).write().overwrite().save(f"{path}/trees")
        told = {k: getattr(model, k) for k in ("features", "slices", "weights", "combine", "classes")}
        _state(spark, path, kind="trees", **told)
    else:
        save(getattr(model, "step"), path)  # fitted results that wrap a step


def load(path: str) -> Any:
    """What :func:`save` wrote."""
    spark = SparkSession.active()
    try:
        state = json.loads(spark.read.text(f"{path}/state").collect()[0]["value"])  # one line
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return PipelineModel.load(path)
    kind = state.pop("kind")
    table = lambda: spark.read.parquet(f"{path}/table")
    if kind == "chained":
        return ChainedModel(load(f"{path}/chain"), load(f"{path}/model"))
    if kind == "chain":
        return Chain([load(f"{path}/step-{i}") for i in range(state["steps"])])
    if kind == "columns":
        return ColumnStep.from_json(state["step"])
    if kind == "linear":
        return LinearModel(**state)
    if kind == "values":
        return ValueEncoder(table=table(), **state)
    if kind == "fill":
        return NeighbourFill(donors=table(), **state)
    if kind == "neighbours":
        return NeighbourModel(train=table(), **state)
    if kind == "trees":
        return AveragedTrees(trees=PipelineModel.load(f"{path}/trees").stages, **state)
    raise ValueError(f"unknown kind of saved model: {kind}")
