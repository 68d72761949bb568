"""Fitted column steps.

Fitting reads the table once or twice and ends in a handful of scalars.  What it returns is a set of
SQL expressions, so applying it is a narrow projection that Catalyst fuses into whatever surrounds
it, runs unchanged on a stream, and is saved inside a ``PipelineModel`` as a ``SQLTransformer``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any, Sequence

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import local_rows, quote


@dataclass
class ColumnStep:
    exprs: dict[str, str] = field(default_factory=dict)
    drop: list[str] = field(default_factory=list)
    replaces: list[str] = field(default_factory=list)
    where: str | None = None
    state: dict[str, dict[str, Any]] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        # computed and removed in one projection, so a step may read a column it drops
        names = df.columns
        gone = set(self.drop)
        picks = [
            F.expr(self.exprs[c]).alias(c) if c in self.exprs else F.col(quote(c)) for c in names if c not in gone
        ]
        picks += [F.expr(e).alias(c) for c, e in self.exprs.items() if c not in names]
        out = df.where(self.where) if self.where else df
        return out.select(*picks)

    def stage(self) -> SQLTransformer:
        """The same projection as a Spark ML stage that can be saved with a model."""
        out = sorted(set(self.drop) | set(self.replaces))
        star = f"* EXCEPT ({', '.join(quote(c) for c in out)})" if out else "*"
        adds = "".join(f", ({e}) AS {quote(c)}" for c, e in self.exprs.items())
        cond = f" WHERE {self.where}" if self.where else ""
        return SQLTransformer(statement=f"SELECT {star}{adds} FROM __THIS__{cond}")

    def summary(self, spark: SparkSession) -> DataFrame:
        """One row per (column, parameter) of the fitted state."""
        rows = [
            (column, name, None if value is None else str(value))
            for column, values in self.state.items()
            for name, value in values.items()
        ]
        return local_rows(spark, rows, "column string, parameter string, value string")

    def to_json(self) -> str:
        return json.dumps(self.__dict__, default=str)

    @staticmethod
    def from_json(text: str) -> "ColumnStep":
        return ColumnStep(**json.loads(text))


def fitted(df: DataFrame, exprs: dict[str, str], drop: Sequence[str] = (), state=None, where=None) -> ColumnStep:
    return ColumnStep(
        exprs=dict(exprs),
        drop=list(drop),
        replaces=[c for c in exprs if c in df.columns],
        where=where,
        state=state or {},
    )
