"""Column helpers shared by every operator: quoting, typing and the missing-value rule.

A value is missing when it is NULL *or* NaN.  Operators never read a raw floating point column in
an aggregate; they go through :func:`num`, which turns NaN into NULL, so aggregates skip it.
"""

from __future__ import annotations

import math
from typing import Any, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quote(name))


def is_float(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_datetime(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))


def columns_of(df: DataFrame, *kinds: str, exclude: Iterable[str] = ()) -> list[str]:
    """Names of the columns whose storage type is one of numeric, boolean, string, datetime."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if f.name not in skip and storage_kind(f.dataType) in kinds]


def storage_kind(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if is_numeric(dtype):
        return "numeric"
    if isinstance(dtype, T.StringType):
        return "string"
    if is_datetime(dtype):
        return "datetime"
    return "other"


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def num_sql(df: DataFrame, name: str) -> str:
    """SQL text for a column as double with NaN folded into NULL."""
    dtype = dtype_of(df, name)
    if is_float(dtype):
        return f"nanvl(CAST({quote(name)} AS DOUBLE), CAST(NULL AS DOUBLE))"
    if isinstance(dtype, T.BooleanType):
        return f"CAST(CAST({quote(name)} AS INT) AS DOUBLE)"
    return f"CAST({quote(name)} AS DOUBLE)"


def num(df: DataFrame, name: str) -> Column:
    return F.expr(num_sql(df, name))


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN folded into NULL, keeping its own type."""
    if is_float(dtype_of(df, name)):
        return F.nanvl(col(name), F.lit(None).cast(dtype_of(df, name)))
    return col(name)


def missing(df: DataFrame, name: str) -> Column:
    return present(df, name).isNull()


def lit_sql(value: Any) -> str:
    """A Python scalar as a Spark SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return f"{value}L"
    if isinstance(value, float):
        if math.isnan(value) or math.isinf(value):
            return f"CAST('{'NaN' if math.isnan(value) else 'Infinity' if value > 0 else '-Infinity'}' AS DOUBLE)"
        return f"{value!r}D"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Numeric columns stacked as (keep..., column, value); one row per cell, still distributed."""
    stacked = df.select(*[col(k) for k in keep], *[num(df, c).alias(c) for c in columns])
    return stacked.unpivot([col(k) for k in keep], [col(c) for c in columns], "column", "value")


def to_double(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[col(k) for k in keep], *[num(df, c).alias(c) for c in columns])


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over the rows where both are present; null for a constant column.

    The built-in aggregate divides by zero on a constant column under ANSI rules.
    """
    xs, ys = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(xs)) * F.sqrt(F.var_pop(ys)))


def local_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A result table whose size is bounded by the number of columns, tests or bins."""
    return spark.createDataFrame(rows, schema).coalesce(1)


def spread(row_df: DataFrame, names: Sequence[str], key: str, fields: dict[str, Sequence[Column]]) -> DataFrame:
    """Turn a one-row wide aggregate into one row per name without leaving Spark."""
    entries = []
    for i, name in enumerate(names):
        entries.append(F.struct(F.lit(name).alias(key), *[fields[f][i].alias(f) for f in fields]))
    return row_df.select(F.inline(F.array(*entries)))
