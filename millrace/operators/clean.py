"""Missing values, constant columns, duplicates and outliers."""

from __future__ import annotations

from typing import Any, Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    col,
    columns_of,
    dtype_of,
    is_numeric,
    lit_sql,
    local_rows,
    missing,
    num,
    num_sql,
    present,
    quote,
    spread,
)
from ..functions.modes import exact_modes
from ..functions.moments import moments
from ..functions.quantiles import exact_quantiles
from ..functions.steps import ColumnStep, fitted


def missing_counts(df: DataFrame) -> tuple[int, dict[str, int]]:
    row = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(missing(df, c)).alias(f"c{i}") for i, c in enumerate(df.columns)]
    ).collect()[0]
    return row["n"], {c: row[f"c{i}"] for i, c in enumerate(df.columns)}


def missing_info(df: DataFrame, only_missing: bool = False, digits: int | None = 2) -> DataFrame:
    """Missing count and percentage per column, most missing first; a single scan."""
    names = df.columns
    one = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(missing(df, c)).alias(f"c{i}") for i, c in enumerate(names)]
    )
    share = [F.try_divide(F.col(f"c{i}") * 100.0, F.col("n")) for i in range(len(names))]
    if digits is not None:
        share = [F.round(s, digits) for s in share]
    out = spread(
        one,
        names,
        "column",
        {
            "missing_count": [F.col(f"c{i}") for i in range(len(names))],
            "missing_percentage": share,
            "dtype": [F.lit(df.schema[c].dataType.simpleString()) for c in names],
        },
    )
    if only_missing:
        out = out.where(F.col("missing_count") > 0)
    return out.orderBy(F.desc("missing_percentage"), "column")


def drop_high_missing(df: DataFrame, threshold: float = 30.0) -> DataFrame:
    """Drop columns whose missing percentage (rounded to two digits) exceeds the threshold."""
    n, counts = missing_counts(df)
    gone = [c for c in df.columns if n and round(counts[c] * 100.0 / n, 2) > threshold]
    return df.drop(*gone)


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def drop_constant(df: DataFrame) -> DataFrame:
    """Drop columns with at most one distinct value, a null counting as a value.

    A column is constant exactly when its smallest and largest values agree and nulls are all or
    nothing, so min, max and count answer it without any distinct aggregation.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(df.columns):
        x = present(df, c)
        aggs += [F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}"), F.count(x).alias(f"k{i}")]
    row = df.agg(*aggs).collect()[0]
    gone = []
    for i, c in enumerate(df.columns):
        distinct = 0 if row[f"k{i}"] == 0 else 1 if row[f"a{i}"] == row[f"b{i}"] else 2
        if distinct + (1 if row[f"k{i}"] < row["n"] else 0) <= 1:
            gone.append(c)
    return df.drop(*gone)


def _fill_expr(df: DataFrame, name: str, value: Any, keep_type: bool) -> str:
    if is_numeric(dtype_of(df, name)) and not keep_type:
        return f"coalesce({num_sql(df, name)}, {lit_sql(float(value))})"
    kind = dtype_of(df, name).simpleString()
    base = quote(name)
    if kind in ("double", "float"):
        base = f"nanvl({base}, CAST(NULL AS {kind.upper()}))"
    return f"coalesce({base}, CAST({lit_sql(value)} AS {kind.upper()}))"


def impute(
    df: DataFrame,
    strategy: str | Mapping[str, str] = "auto",
    custom_values: Mapping[str, Any] | None = None,
    columns: Sequence[str] | None = None,
) -> ColumnStep:
    """Fill missing values by mean, median, mode, constant, or a strategy per column.

    ``auto`` as the overall strategy chooses by skew; as a column's strategy, or for a column the
    mapping leaves out, it means mean for numbers and mode for the rest.  A mean or median asked of
    a non-numeric column falls back to the mode.
    """
    if strategy == "auto":
        return auto_impute(df, columns)
    custom_values = custom_values or {}
    _, gaps = missing_counts(df)
    todo = [c for c in (columns or df.columns) if gaps[c]]
    plan: dict[str, str] = {}
    for c in todo:
        want = strategy if isinstance(strategy, str) else strategy.get(c, "auto")
        numeric = is_numeric(dtype_of(df, c))
        if want == "auto":
            want = "mean" if numeric else "mode"
        if want in ("mean", "median") and not numeric:
            want = "mode"
        if want not in ("mean", "median", "mode", "constant"):
            raise ValueError(f"unknown strategy {want!r}")
        plan[c] = want
    return _imputed(df, plan, gaps, custom_values)


def auto_impute(df: DataFrame, columns: Sequence[str] | None = None) -> ColumnStep:
    """Median for numeric columns whose adjusted skew exceeds one, mean for other numbers, else mode."""
    _, gaps = missing_counts(df)
    todo = [c for c in (columns or df.columns) if gaps[c]]
    numeric = [c for c in todo if is_numeric(dtype_of(df, c))]
    skews = moments(df, numeric, ["skew"])
    plan = {}
    for c in todo:
        if c in skews:
            skew = skews[c]["skew"]
            plan[c] = "median" if skew is not None and abs(skew) > 1 else "mean"
        else:
            plan[c] = "mode"
    return _imputed(df, plan, gaps, {})


def _imputed(df: DataFrame, plan: dict[str, str], gaps: dict[str, int], constants: Mapping[str, Any]) -> ColumnStep:
    values: dict[str, Any] = {}
    means = [c for c, s in plan.items() if s == "mean"]
    medians = [c for c, s in plan.items() if s == "median"]
    values.update({c: m["mean"] for c, m in moments(df, means, ["mean"]).items()})
    values.update({c: q[0] for c, q in exact_quantiles(df, {c: [0.5] for c in medians}).items()})
    by_mode = [c for c, s in plan.items() if s == "mode"]
    numbers = [c for c in by_mode if is_numeric(dtype_of(df, c))]
    values.update(exact_modes(df, numbers))
    values.update(exact_modes(df, [c for c in by_mode if c not in numbers], as_text=True))
    values.update({c: constants.get(c) for c, s in plan.items() if s == "constant"})
    exprs, state = {}, {}
    for c, s in plan.items():
        state[c] = {"missing_count": gaps[c], "strategy": s, "imputed_value": values[c]}
        if values[c] is not None:
            exprs[c] = _fill_expr(df, c, values[c], keep_type=s not in ("mean", "median"))
    return fitted(df, exprs, state=state)


def custom_impute(df: DataFrame, rules: Mapping[str, Any | Callable[[Column], Column]]) -> DataFrame:
    """Fill nulls by a value or by ``Column -> Column`` (wrap a ``pandas_udf`` for arbitrary code)."""
    picks = []
    for c in df.columns:
        rule = rules.get(c)
        if rule is None:
            picks.append(col(c))
        else:
            fill = rule(col(c)) if callable(rule) else F.lit(rule)
            picks.append(F.coalesce(present(df, c), fill).alias(c))
    return df.select(*picks)


def imputation_summary(df: DataFrame, step: ColumnStep) -> DataFrame:
    rows = [
        (c, int(s["missing_count"]), s["strategy"], None if s["imputed_value"] is None else str(s["imputed_value"]))
        for c, s in step.state.items()
    ]
    return local_rows(
        df.sparkSession, rows, "column string, missing_count bigint, strategy string, imputed_value string"
    )


def iqr_bounds(df: DataFrame, columns: Sequence[str], threshold: float = 1.5) -> dict[str, dict[str, float]]:
    q = exact_quantiles(df, {c: [0.25, 0.75] for c in columns})
    out = {}
    for c, (q1, q3) in q.items():
        if q1 is None:
            continue
        spread_ = threshold * (q3 - q1)
        out[c] = {"q1": q1, "q3": q3, "iqr": q3 - q1, "lower": q1 - spread_, "upper": q3 + spread_}
    return out


def clip_iqr(df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 1.5) -> ColumnStep:
    """Cap values at the interquartile fences; nulls stay null."""
    columns = list(columns) if columns is not None else columns_of(df, "numeric")
    bounds = iqr_bounds(df, columns, threshold)
    exprs = {}
    for c, b in bounds.items():
        x = num_sql(df, c)
        exprs[c] = f"CASE WHEN {x} IS NOT NULL THEN greatest(least({x}, {lit_sql(b['upper'])}), {lit_sql(b['lower'])}) END"
    return fitted(df, exprs, state=bounds)


def clip_zscore(df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 1.5) -> ColumnStep:
    """Pull values further than ``threshold`` sample deviations from the mean back to that distance."""
    columns = list(columns) if columns is not None else columns_of(df, "numeric")
    stats = moments(df, columns, ["mean", "std"])
    exprs = {}
    for c, s in stats.items():
        if not s["std"]:
            continue
        x = num_sql(df, c)
        z = f"(({x} - {lit_sql(s['mean'])}) / {lit_sql(s['std'])})"
        reach = lit_sql(threshold * s["std"])
        exprs[c] = f"CASE WHEN abs({z}) > {lit_sql(float(threshold))} THEN {lit_sql(s['mean'])} + {reach} * sign({z}) ELSE {x} END"
    return fitted(df, exprs, state=stats)


def remove_outliers_iqr(df: DataFrame, columns: Sequence[str] | str, threshold: float = 1.5) -> ColumnStep:
    """Keep only rows inside the fences of every named column; rows with a null there go."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    bounds = iqr_bounds(df, columns, threshold)
    cond = " AND ".join(
        f"{num_sql(df, c)} BETWEEN {lit_sql(b['lower'])} AND {lit_sql(b['upper'])}" for c, b in bounds.items()
    )
    return fitted(df, {}, where=cond or None, state=bounds)


def outlier_report(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "iqr", threshold: float | None = None
) -> DataFrame:
    """Outlier counts per column by interquartile fences (1.5) or by z-score (2.0)."""
    columns = list(columns) if columns is not None else columns_of(df, "numeric")
    if method == "iqr":
        bounds = iqr_bounds(df, columns, 1.5 if threshold is None else threshold)
    elif method == "zscore":
        reach = 2.0 if threshold is None else threshold
        bounds = {}
        for c, s in moments(df, columns, ["mean", "std"]).items():
            if s["mean"] is None or s["std"] is None:
                continue
            bounds[c] = {"q1": None, "q3": None, "iqr": None}
            bounds[c].update(lower=s["mean"] - reach * s["std"], upper=s["mean"] + reach * s["std"])
    else:
        raise ValueError("method must be iqr or zscore")
    names = list(bounds)
    aggs = []
    for i, c in enumerate(names):
        x = num(df, c)
        outside = (x < F.lit(bounds[c]["lower"])) | (x > F.lit(bounds[c]["upper"]))
        aggs += [F.count_if(outside).alias(f"o{i}"), F.count(x).alias(f"n{i}")]
    if not names:
        aggs = [F.count(F.lit(1)).alias("n")]
    row = df.agg(*aggs).collect()[0]
    rows = []
    for i, c in enumerate(names):
        b, n = bounds[c], row[f"n{i}"]
        rows.append((c, b["q1"], b["q3"], b["iqr"], b["lower"], b["upper"], row[f"o{i}"], 100.0 * row[f"o{i}"] / n))
    return local_rows(
        df.sparkSession,
        rows,
        "column string, q1 double, q3 double, iqr double, lower_bound double, upper_bound double, "
        "n_outliers bigint, outlier_percentage double",
    )


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    return df.where(~missing(df, target))
