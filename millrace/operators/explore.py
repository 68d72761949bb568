"""Descriptive statistics and correlation."""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tails
from ..functions.columns import col, columns_of, correlation, is_numeric, dtype_of, local_rows, long_form, num, present
from ..functions.gram import EXPRESSION_WIDTH, pairwise_correlation
from ..functions.modes import exact_modes, value_profile
from ..functions.moments import moments
from ..functions.quantiles import exact_quantiles
from .clean import missing_counts, outlier_report
from .convert import column_kinds, distinct_counts
from .ranks import rank_correlations


def _numeric(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    return list(columns) if columns is not None else columns_of(df, "numeric")


PROFILE = ["n_rows", "n", "mean", "min", "max", "std", "var", "skew", "kurt", "skew_pop", "kurt_pop"]


def univariate_numeric(df: DataFrame, columns: Sequence[str] | None = None, outliers: bool = False) -> DataFrame:
    """Full profile of numeric columns, one row each.

    Three scans however many columns there are, on tables of many rows a few more for the mode: fused
    moments, exact quartiles, value counts; ``outliers`` adds one against the fences and makes the value
    counts exact to the last distinct value.
    """
    columns = _numeric(df, columns)
    m = moments(df, columns, PROFILE)
    columns = [c for c in columns if m[c]["n"]] + [c for c in columns if not m[c]["n"]]
    q = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns}, {c: m[c]["n"] for c in columns})
    if outliers:
        v = value_profile(df, columns)
    else:
        v = {c: (mode,) for c, mode in exact_modes(df, columns).items()}
    over = {}
    if outliers:
        over = {r["column"]: r for r in outlier_report(df, [c for c in columns if m[c]["n"]]).collect()}
    rows = []
    for c in columns:
        s, (q1, med, q3) = m[c], q[c]
        mode = None if v[c][0] is None else float(v[c][0])
        row = [c, s["n"], s["mean"], med, mode, s["min"], s["max"], s["std"], s["var"], s["skew"], s["kurt"]]
        row += [q1, q3, None if q1 is None else q3 - q1, s["n_rows"] - s["n"]]
        if outliers:
            r = over.get(c)
            row += [v[c][1]] + ([r["lower_bound"], r["upper_bound"], r["n_outliers"], r["outlier_percentage"]] if r else [None] * 4)
        rows.append(tuple(row))
    schema = (
        "column string, count bigint, mean double, median double, mode double, min double, max double, std double, "
        "variance double, skewness double, kurtosis double, q1 double, q3 double, iqr double, missing bigint"
    )
    if outliers:
        schema += ", unique bigint, lower_bound double, upper_bound double, n_outliers bigint, outlier_percentage double"
    return local_rows(df.sparkSession, rows, schema)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n, proportion) over non-missing values of any columns, as text."""
    stacked = df.select(*[present(df, c).cast("string").alias(c) for c in columns]).unpivot(
        [], [col(c) for c in columns], "column", "value"
    )
    counted = stacked.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(*[F.count(present(df, c)).alias(f"c{i}") for i, c in enumerate(columns)]).collect()[0]
    share = F.lit(None).cast("double")
    for i, c in enumerate(columns):
        share = F.when(F.col("column") == c, F.col("n") / F.lit(float(total[i] or 1))).otherwise(share)
    return counted.withColumn("proportion", share)


def univariate_categorical(df: DataFrame, columns: Sequence[str], top: int = 3) -> DataFrame:
    """Count, distinct values, mode and its share, missing, and the ``top`` most frequent values."""
    n_rows, gaps = missing_counts(df.select(*[col(c) for c in columns]))
    v = value_profile(df, columns, as_text=True)
    rows = []
    for c in columns:
        # top-k per column is a bounded sort on each task, never a full ordering of the values
        best = (
            df.where(col(c).isNotNull())
            .groupBy(col(c).cast("string").alias("value"))
            .agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "value")
            .limit(top)
            .collect()
        )
        best = sorted(best, key=lambda r: (-r["n"], r["value"]))
        n = n_rows - gaps[c]
        rows.append(
            (
                c,
                n,
                v[c][1],
                v[c][0],
                gaps[c],
                100.0 * best[0]["n"] / n if best else None,
                ", ".join(f"{r['value']}={r['n']}" for r in best),
            )
        )
    return local_rows(
        df.sparkSession,
        rows,
        "column string, count bigint, unique bigint, mode string, missing bigint, top_percentage double, top_values string",
    )


def univariate_boolean(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns) if columns is not None else columns_of(df, "boolean")
    row = df.agg(
        *[F.count_if(col(c)).alias(f"t{i}") for i, c in enumerate(columns)],
        *[F.count_if(~col(c)).alias(f"f{i}") for i, c in enumerate(columns)],
        *[F.count_if(col(c).isNull()).alias(f"m{i}") for i, c in enumerate(columns)],
    ).collect()[0]
    rows = [
        (c, row[f"t{i}"], row[f"f{i}"], row[f"m{i}"], row[f"t{i}"] / max(row[f"t{i}"] + row[f"f{i}"], 1))
        for i, c in enumerate(columns)
    ]
    return local_rows(
        df.sparkSession, rows, "column string, true_count bigint, false_count bigint, missing bigint, true_share double"
    )


def monthly_counts(df: DataFrame, column: str, periods: int | None = None) -> DataFrame:
    """Rows per calendar month, optionally only the first ``periods`` months."""
    months = (
        df.where(col(column).isNotNull())
        .groupBy(F.date_format(col(column), "yyyy-MM").alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return months.orderBy("month").limit(periods) if periods else months.orderBy("month")


def univariate_datetime(df: DataFrame, columns: Sequence[str], periods: int = 3) -> DataFrame:
    """First and last value, missing count and the row counts of the first months."""
    rows = []
    for c in columns:
        s = df.agg(
            F.min(col(c)).cast("string").alias("lo"),
            F.max(col(c)).cast("string").alias("hi"),
            F.count_if(col(c).isNull()).alias("m"),
        ).collect()[0]
        first = monthly_counts(df, c, periods).collect()
        first = ", ".join(f"{r['month']}={r['n']}" for r in sorted(first))
        rows.append((c, s["lo"], s["hi"], s["m"], first))
    return local_rows(
        df.sparkSession, rows, "column string, first string, last string, missing bigint, rows_per_month string"
    )


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Describe tables by kind: numeric, categorical (with text) and boolean."""
    columns = list(columns) if columns is not None else df.columns
    kinds = column_kinds(df.select(*[col(c) for c in columns]))
    spark = df.sparkSession
    out: dict[str, DataFrame] = {}
    numeric = [c for c in columns if kinds[c] == "numeric"]
    if numeric:
        m = moments(df, numeric, ["n", "mean", "std", "min", "max"])
        q = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in numeric}, {c: m[c]["n"] for c in numeric})
        rows = [(c, m[c]["n"], m[c]["mean"], m[c]["std"], m[c]["min"], *q[c], m[c]["max"]) for c in numeric]
        out["numeric"] = local_rows(
            spark,
            rows,
            "column string, count bigint, mean double, std double, min double, p25 double, p50 double, p75 double, max double",
        )
    texts = [c for c in columns if kinds[c] in ("categorical", "text")]
    if texts:
        out["categorical"] = univariate_categorical(df, texts, 1).select(
            "column", "count", "unique", F.col("mode").alias("top"), (F.col("top_percentage") * F.col("count") / 100).cast("bigint").alias("freq")
        )
    flags = [c for c in columns if kinds[c] == "boolean"]
    if flags:
        out["boolean"] = univariate_boolean(df, flags)
    return out


def basic_summary(df: DataFrame, target: str | None = None) -> DataFrame:
    """Describe figures, missing count and correlation with the target (default: last column), best first."""
    target = target or df.columns[-1]
    numeric = columns_of(df, "numeric")
    m = moments(df, numeric, ["n_rows", "n", "mean", "std", "min", "max"])
    row = df.agg(*[correlation(num(df, c), num(df, target)).alias(f"c{i}") for i, c in enumerate(numeric)]).collect()[0]
    rows = [
        (c, m[c]["n"], m[c]["n_rows"] - m[c]["n"], m[c]["mean"], m[c]["std"], m[c]["min"], m[c]["max"], row[i])
        for i, c in enumerate(numeric)
    ]
    rows.sort(key=lambda r: (r[-1] is None, -(r[-1] or 0)))
    return local_rows(
        df.sparkSession,
        rows,
        "column string, count bigint, missing bigint, mean double, std double, min double, max double, target_correlation double",
    )


PERCENTS = [0, 5, 10, 25, 50, 75, 90, 95, 99, 100]


def percentiles(df: DataFrame, columns: Sequence[str] | None = None, percents: Sequence[float] = PERCENTS) -> DataFrame:
    """Exact percentiles as columns P0...P100, one row per column."""
    columns = _numeric(df, columns)
    q = exact_quantiles(df, {c: [p / 100.0 for p in percents] for c in columns})
    names = ", ".join(f"P{p:g} double" for p in percents)
    return local_rows(df.sparkSession, [(c, *q[c]) for c in columns], f"column string, {names}")


def pearson_matrix(df: DataFrame, columns: Sequence[str]):
    if len(columns) <= EXPRESSION_WIDTH:
        return pairwise_correlation(df, columns, [0.0] * len(columns))
    # the matrix path sums raw products, so columns are centred first
    means = {c: m["mean"] or 0.0 for c, m in moments(df, columns, ["mean"]).items()}
    return pairwise_correlation(df, columns, [means[c] for c in columns])


def spearman_matrix(df: DataFrame, columns: Sequence[str]):
    """Rank correlation; pairs touched by nulls are ranked on their shared rows."""
    return rank_correlations(df, columns)


def _matrix(df: DataFrame, columns: Sequence[str], method: str):
    if method == "pearson":
        return pearson_matrix(df, columns)
    if method == "spearman":
        return spearman_matrix(df, columns)
    raise ValueError("method must be pearson or spearman")


def corr_matrix(
    df: DataFrame, method: str = "pearson", columns: Sequence[str] | None = None, lower_only: bool = False
) -> DataFrame:
    """Correlation matrix in long form over numeric and boolean columns, pairwise complete."""
    columns = list(columns) if columns is not None else columns_of(df, "numeric", "boolean")
    _, r = _matrix(df, columns, method)
    rows = [
        (a, b, None if math.isnan(r[i, j]) else float(r[i, j]))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
        if not lower_only or j < i
    ]
    return local_rows(df.sparkSession, rows, "column_1 string, column_2 string, correlation double")


def correlation_p_value(r: float, n: float) -> float | None:
    if r is None or math.isnan(r) or n < 3:
        return None
    if abs(r) >= 1.0:
        return 0.0
    r, n = float(r), float(n)
    return tails.student_two_sided(r * math.sqrt((n - 2) / (1 - r * r)), n - 2)


def corr_pairs(df: DataFrame, columns: Sequence[str] | None = None, methods: Sequence[str] = ("pearson", "spearman")) -> DataFrame:
    """Every numeric pair once: coefficient, two-sided p-value and rows used."""
    columns = _numeric(df, columns)
    rows = []
    for method in methods:
        n, r = _matrix(df, columns, method)
        for i, a in enumerate(columns):
            for j in range(i + 1, len(columns)):
                value = None if math.isnan(r[i, j]) else float(r[i, j])
                rows.append((a, columns[j], method, value, correlation_p_value(r[i, j], n[i, j]), int(n[i, j])))
    return local_rows(
        df.sparkSession,
        rows,
        "column_1 string, column_2 string, method string, correlation double, p_value double, n bigint",
    )


def high_corr_pairs(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "pearson", threshold: float = 0.8
) -> DataFrame:
    return corr_pairs(df, columns, [method]).where(F.abs("correlation") >= threshold)


def group_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    x = num(df, value)
    return (
        df.where(col(group).isNotNull())
        .groupBy(col(group))
        .agg(
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"),
            F.count(x).alias("count"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
        )
    )


def textlen_corr(df: DataFrame, text: str, numeric: Sequence[str]) -> DataFrame:
    """Spearman correlation of text length with each numeric column."""
    length = f"{text}_len"
    slim = df.select(F.length(col(text)).alias(length), *[num(df, c).alias(c) for c in numeric])
    n, r = spearman_matrix(slim, [length, *numeric])
    rows = [
        (length, c, float(r[0, i + 1]), correlation_p_value(r[0, i + 1], n[0, i + 1])) for i, c in enumerate(numeric)
    ]
    return local_rows(df.sparkSession, rows, "column_1 string, column_2 string, correlation double, p_value double")


def insights(
    df: DataFrame,
    missing_above: float = 30.0,
    skew_above: float = 1.0,
    outliers_above: float = 5.0,
    correlation_above: float = 0.8,
) -> DataFrame:
    """Flagged facts: high missing share, constant or skewed columns, many outliers, strong correlation."""
    rows = []
    n, gaps = missing_counts(df)
    for c in df.columns:
        share = 100.0 * gaps[c] / n if n else 0.0
        if share > missing_above:
            rows.append(("high_missing", c, None, share))
    numeric = columns_of(df, "numeric")
    m = moments(df, numeric, ["n", "min", "max", "skew"])
    usable = [c for c in numeric if m[c]["n"]]
    for c in usable:
        if m[c]["min"] == m[c]["max"]:
            rows.append(("constant", c, None, m[c]["min"]))
        elif abs(m[c]["skew"] or 0) > skew_above:
            rows.append(("skewed", c, None, m[c]["skew"]))
    for r in outlier_report(df, usable).collect():
        if r["outlier_percentage"] > outliers_above:
            rows.append(("outliers", r["column"], None, r["outlier_percentage"]))
    for r in high_corr_pairs(df, usable, threshold=correlation_above).collect():
        rows.append(("high_correlation", r["column_1"], r["column_2"], r["correlation"]))
    return local_rows(df.sparkSession, rows, "insight string, column string, other_column string, value double")


def bivariate(df: DataFrame, columns: Sequence[str] | None = None, method: str = "pearson", max_groups: int = 20) -> DataFrame:
    """Association of every pair of columns by kind: correlation, ANOVA or text-length correlation."""
    from .hypothesis import anova

    columns = list(columns) if columns is not None else df.columns
    numeric = [c for c in columns if is_numeric(dtype_of(df, c))]
    others = [c for c in columns if c in columns_of(df, "string", "boolean")]
    counts = distinct_counts(df, others)
    rows = []
    if len(numeric) > 1:
        for r in corr_pairs(df, numeric, [method]).collect():
            rows.append((r["column_1"], r["column_2"], method.capitalize(), r["correlation"], r["p_value"]))
    for c in others:
        if counts[c] <= max_groups:
            for y in numeric:
                got = anova(df, c, y)
                if got is not None:
                    rows.append((c, y, "ANOVA", got["statistic"], got["p_value"]))
        elif c in columns_of(df, "string"):
            for r in textlen_corr(df, c, numeric).collect():
                rows.append((r["column_1"], r["column_2"], "Spearman (TextLen)", r["correlation"], r["p_value"]))
    return local_rows(
        df.sparkSession, rows, "column_1 string, column_2 string, method string, statistic double, p_value double"
    )
