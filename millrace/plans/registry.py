"""Registry of runnable queries and the SQL that states the same result."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The parquet tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def _rounded(df: DataFrame, digits: dict[str, int], default: int) -> DataFrame:
    # adding zero turns -0.0 into 0.0
    picks = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            picks.append(
                (F.round(col(f.name).cast("double"), digits.get(f.name, default)) + F.lit(0.0)).alias(f.name)
            )
        else:
            picks.append(col(f.name))
    return df.select(*picks)


def query(
    name: str,
    sql: str | None = None,
    doubles: str | list[str] = "",
    digits: int = 6,
    per_column: dict[str, int] | None = None,
):
    """Register ``fn(tables)``; doubles are rounded alike on both sides so hashes can be compared."""
    per_column = per_column or {}

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return _rounded(fn(Tables(spark, folder)), per_column, digits)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            names = doubles.split() if isinstance(doubles, str) else doubles
            if names:
                swaps = ", ".join(
                    f'round(CAST("{c}" AS DOUBLE), {per_column.get(c, digits)}) + 0.0 AS "{c}"' for c in names
                )
                ORACLES[name] = f"SELECT * REPLACE ({swaps}) FROM ({sql}) AS result"
            else:
                ORACLES[name] = sql
        return fn

    return register
