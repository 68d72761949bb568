"""Fused moment aggregates: one scan gives every statistic of every column."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import long_form, num

# Above this many columns the fused aggregate is built on the stacked form, so that generated code
# does not grow with the width of the table.
WIDE = 24


def adjusted_skew(x: Column) -> Column:
    n = F.count(x).cast("double")
    raw = F.when(F.count(x) > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))
    return F.when(F.count(x) > 2, F.coalesce(F.nanvl(raw, F.lit(None).cast("double")), F.lit(0.0)))


def adjusted_kurtosis(x: Column) -> Column:
    n = F.count(x).cast("double")
    scale = F.try_divide(n - 1, (n - 2) * (n - 3))
    raw = F.nanvl(scale * ((n + 1) * F.kurtosis(x) + 6.0), F.lit(None).cast("double"))
    return F.when(F.count(x) > 3, F.coalesce(raw, F.lit(0.0)))


MEASURES = {
    "n_rows": lambda x: F.count(F.lit(1)),
    "n": lambda x: F.count(x),
    "mean": lambda x: F.avg(x),
    "min": lambda x: F.min(x),
    "max": lambda x: F.max(x),
    "sum": lambda x: F.sum(x),
    "std": lambda x: F.stddev_samp(x),
    "std_pop": lambda x: F.stddev_pop(x),
    "var": lambda x: F.var_samp(x),
    "var_pop": lambda x: F.var_pop(x),
    "skew": adjusted_skew,
    "kurt": adjusted_kurtosis,
    "skew_pop": lambda x: F.skewness(x),
    "kurt_pop": lambda x: F.kurtosis(x),
}


def moments(df: DataFrame, columns: Sequence[str], measures: Sequence[str]) -> dict[str, dict[str, float]]:
    """{column: {measure: value}} from a single scan; only one row per column reaches the driver."""
    columns = list(columns)
    if not columns:
        return {}
    if len(columns) <= WIDE:
        # alias by position so that any column name is usable
        narrow = df.select(*[num(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
        aggs = [
            MEASURES[m](F.col(f"c{i}")).alias(f"{m}_{i}") for i in range(len(columns)) for m in measures
        ]
        row = narrow.agg(*aggs).collect()[0]
        return {c: {m: row[f"{m}_{i}"] for m in measures} for i, c in enumerate(columns)}
    stacked = long_form(df, columns)
    rows = stacked.groupBy("column").agg(*[MEASURES[m](F.col("value")).alias(m) for m in measures]).collect()
    found = {r["column"]: {m: r[m] for m in measures} for r in rows}
    empty = {m: (0 if m in ("n", "n_rows") else None) for m in measures}
    return {c: found.get(c, dict(empty)) for c in columns}


def row_count(df: DataFrame) -> int:
    return df.count()
