"""Derived, interaction, polynomial, date and binned features; principal components."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations, combinations_with_replacement
from typing import Any, Callable, Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame

from ..functions.columns import dtype_of, lit_sql, local_rows, num_sql, quote
from ..functions.gram import gram_matrix
from ..functions.moments import moments
from ..functions.quantiles import exact_quantiles
from ..functions.steps import ColumnStep, fitted


def _as_number(df: DataFrame, name: str) -> str:
    if dtype_of(df, name).simpleString() == "string":
        return f"try_cast({quote(name)} AS DOUBLE)"
    return num_sql(df, name)


def derive(df: DataFrame, operations: Mapping[str, Mapping[str, Any]] | Sequence[Mapping[str, Any]]) -> ColumnStep:
    """sum, mean, ratio, difference or product of columns under a new name.

    Nulls count as 0 in a sum, as 1 in a product and are left out of a mean; a ratio by zero is
    null.  Unknown columns are left out; ratio and difference then need exactly two.
    """
    if not isinstance(operations, Mapping):
        operations = {o["name"]: o for o in operations}
    exprs, state = {}, {}
    for name, spec in operations.items():
        given = spec.get("columns", [])
        cols = [c for c in ([given] if isinstance(given, str) else given) if c in df.columns]
        op = str(spec.get("operation", "")).lower()
        xs = [_as_number(df, c) for c in cols]
        if not xs:
            continue
        if op == "sum":
            expr = " + ".join(f"coalesce({x}, 0D)" for x in xs)
        elif op == "mean":
            total = " + ".join(f"coalesce({x}, 0D)" for x in xs)
            count = " + ".join(f"CAST({x} IS NOT NULL AS INT)" for x in xs)
            expr = f"try_divide({total}, {count})"
        elif op == "product":
            expr = " * ".join(f"coalesce({x}, 1D)" for x in xs)
        elif op == "ratio" and len(xs) == 2:
            expr = f"try_divide({xs[0]}, {xs[1]})"
        elif op == "difference" and len(xs) == 2:
            expr = f"{xs[0]} - {xs[1]}"
        else:
            continue
        exprs[name] = expr
        state[name] = {"type": "derived", "operation": op, "source_columns": ",".join(cols)}
    return fitted(df, exprs, state=state)


# operation name -> SQL shape
INTERACTIONS = {
    "multiplication": "{a} * {b}",
    "division": "try_divide({a}, {b})",
    "addition": "{a} + {b}",
    "subtraction": "{a} - {b}",
}


def interact(df: DataFrame, pairs: Sequence[Sequence[str]], interaction_type: str = "multiplication") -> ColumnStep:
    """``{a}_{type}_{b}`` for the named pairs."""
    shape = INTERACTIONS[interaction_type]
    exprs, state = {}, {}
    for pair in pairs:
        if len(pair) == 2 and all(c in df.columns for c in pair):
            a, b = pair
            name = f"{a}_{interaction_type}_{b}"
            exprs[name] = shape.format(a=_as_number(df, a), b=_as_number(df, b))
            state[name] = {"type": "interaction", "operation": interaction_type, "source_columns": f"{a},{b}"}
    return fitted(df, exprs, state=state)


def interact_all_pairs(df: DataFrame, columns: Sequence[str]) -> ColumnStep:
    """``{a}_x_{b}`` for every pair of the given columns."""
    exprs = {f"{a}_x_{b}": f"{_as_number(df, a)} * {_as_number(df, b)}" for a, b in combinations(columns, 2)}
    return fitted(df, exprs)


def polynomial(
    df: DataFrame, columns: Sequence[str], degree: int = 2, interaction_only: bool = False
) -> ColumnStep:
    """Powers and products up to ``degree`` as ``poly_a^2`` and ``poly_a b``; first powers are not repeated."""
    columns = [c for c in columns if c in df.columns]
    pick = combinations if interaction_only else combinations_with_replacement
    exprs, state = {}, {}
    for d in range(2, degree + 1):
        for combo in pick(columns, d):
            terms = []
            for c in dict.fromkeys(combo):
                k = combo.count(c)
                terms.append(c if k == 1 else f"{c}^{k}")
            name = "poly_" + " ".join(terms)
            exprs[name] = " * ".join(_as_number(df, c) for c in combo)
            state[name] = {"type": "polynomial", "operation": f"degree {d}", "source_columns": ",".join(combo)}
    return fitted(df, exprs, state=state)


@dataclass
class Components:
    step: ColumnStep
    columns: list[str]
    mean: list[float]
    loadings: np.ndarray
    explained_ratio: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.step.transform(df)

    def table(self, df: DataFrame) -> DataFrame:
        total, rows = 0.0, []
        for i, r in enumerate(self.explained_ratio):
            total += r
            rows.append((f"pca_component_{i + 1}", r, total))
        return local_rows(
            df.sparkSession, rows, "component string, explained_variance_ratio double, cumulative_variance_ratio double"
        )


def pca(
    df: DataFrame,
    columns: Sequence[str],
    n_components: int | None = None,
    variance_ratio: float = 0.95,
) -> Components:
    """Principal components as added columns.

    The covariance matrix is one aggregate over the rows complete in ``columns``; its eigenvectors
    are a p x p problem, and each component is a weighted sum evaluated by Spark.  The sign makes
    the largest loading positive.
    """
    columns = [c for c in columns if c in df.columns]
    means = [m["mean"] for m in moments(df.na.drop(subset=columns), columns, ["mean"]).values()]
    n, g = gram_matrix(df, columns, means)
    values, vectors = np.linalg.eigh(g / max(n - 1, 1))
    order = np.argsort(values)[::-1]
    values, vectors = np.clip(values[order], 0.0, None), vectors[:, order]
    ratios = values / values.sum() if values.sum() > 0 else np.zeros_like(values)
    if n_components is None:
        n_components = int(np.searchsorted(np.cumsum(ratios), variance_ratio - 1e-12) + 1)
    k = max(1, min(n_components, len(columns)))
    exprs, state = {}, {}
    for i in range(k):
        v = vectors[:, i]
        v = v if v[np.argmax(np.abs(v))] > 0 else -v
        vectors[:, i] = v
        parts = [
            f"({_as_number(df, c)} - {lit_sql(float(means[j]))}) * {lit_sql(float(v[j]))}" for j, c in enumerate(columns)
        ]
        exprs[f"pca_component_{i + 1}"] = " + ".join(parts)
        state[f"pca_component_{i + 1}"] = {
            "type": "pca",
            "operation": f"explained {float(ratios[i])!r}",
            "source_columns": ",".join(columns),
        }
    return Components(
        fitted(df, exprs, state=state), list(columns), means, vectors[:, :k], [float(r) for r in ratios[:k]]
    )


def custom_feature(df: DataFrame, definitions: Mapping[str, Callable[[DataFrame], Column]]) -> DataFrame:
    """Add columns computed by ``DataFrame -> Column`` callables."""
    return df.withColumns({name: make(df) for name, make in definitions.items()})


def datetime_parts(
    df: DataFrame, columns: Sequence[str] | str, prefix: bool = False, weekend: bool = True, drop: bool = True
) -> ColumnStep:
    """Year, month, day, weekday (Monday 0) and weekend flag of date columns, whose source goes."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    exprs = {}
    for c in columns:
        lead = f"{c}_" if prefix or len(columns) > 1 else ""
        q = quote(c)
        exprs[f"{lead}year"] = f"year({q})"
        exprs[f"{lead}month"] = f"month({q})"
        exprs[f"{lead}day"] = f"day({q})"
        exprs[f"{lead}dayofweek"] = f"weekday({q})"
        if weekend:
            exprs[f"{lead}is_weekend"] = f"CAST(weekday({q}) >= 5 AS INT)"
    return fitted(df, exprs, drop=columns if drop else [])


def bin_expr(x: str, edges: Sequence[float], labels: Sequence[Any] | None = None, lowest: bool = True) -> str:
    """SQL for right-closed bins: code i when edges[i] < x <= edges[i+1]; outside is null."""
    n = len(edges) - 1
    names = [lit_sql(v) for v in labels] if labels is not None else [str(i) for i in range(n)]
    first = ">=" if lowest else ">"
    cases = "".join(f" WHEN {x} <= {lit_sql(float(edges[i + 1]))} THEN {names[i]}" for i in range(n))
    return f"CASE WHEN {x} IS NULL OR NOT {x} {first} {lit_sql(float(edges[0]))} THEN NULL{cases} END"


def cut_edges(df: DataFrame, column: str, bins: int) -> list[float]:
    """Equal-width edges, the leftmost moved out by a thousandth of the range so the minimum is inside."""
    s = moments(df, [column], ["min", "max"])[column]
    lo, hi = s["min"], s["max"]
    if lo == hi:
        pad = 0.001 * abs(lo) if lo else 0.001
        lo, hi = lo - pad, hi + pad
        return [lo + (hi - lo) * i / bins for i in range(bins + 1)]
    edges = [lo + (hi - lo) * i / bins for i in range(bins)] + [hi]
    edges[0] -= 0.001 * (hi - lo)
    return edges


def cut_bins(
    df: DataFrame,
    column: str,
    bins: int | Sequence[float],
    labels: Sequence[Any] | None = None,
    output: str | None = None,
) -> ColumnStep:
    """Right-closed bins: equal width by count, or explicit edges."""
    edges = cut_edges(df, column, bins) if isinstance(bins, int) else [float(b) for b in bins]
    output = output or f"{column}_binned"
    return fitted(
        df,
        {output: bin_expr(num_sql(df, column), edges, labels, lowest=False)},
        state={output: {"edges": edges}},
    )


def quantile_edges(df: DataFrame, column: str, bins: int, duplicates: str = "raise") -> list[float]:
    edges = exact_quantiles(df, {column: [i / bins for i in range(bins + 1)]})[column]
    if edges[0] is None:
        raise ValueError(f"{column} has no values")
    unique = [e for i, e in enumerate(edges) if i == 0 or e != edges[i - 1]]
    if len(unique) != len(edges) and duplicates == "raise":
        raise ValueError(f"bin edges of {column} repeat; pass duplicates='drop'")
    return unique


def quantile_bins(
    df: DataFrame,
    column: str,
    bins: int,
    labels: Sequence[Any] | None = None,
    output: str | None = None,
    duplicates: str = "raise",
) -> ColumnStep:
    """Right-closed bins between exact linear quantiles, lowest value included."""
    edges = quantile_edges(df, column, bins, duplicates)
    output = output or f"{column}_bin"
    return fitted(df, {output: bin_expr(num_sql(df, column), edges, labels)}, state={output: {"edges": edges}})


def feature_info(df: DataFrame, *steps: ColumnStep) -> DataFrame:
    """Catalogue of created features."""
    rows = [
        (name, s.get("type"), s.get("operation"), s.get("source_columns"))
        for step in steps
        for name, s in step.state.items()
        if "type" in s
    ]
    return local_rows(df.sparkSession, rows, "feature string, type string, operation string, source_columns string")

