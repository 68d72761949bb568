"""Scaling and monotone transforms; each fit is one fused aggregate."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame

from ..functions.columns import columns_of, lit_sql, num_sql, quote
from ..functions.moments import moments
from ..functions.quantiles import exact_quantiles
from ..functions.steps import ColumnStep, fitted


def _numeric(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    return list(columns) if columns is not None else columns_of(df, "numeric")


def _base_state(method: str, s: dict) -> dict:
    return {
        "method": method,
        "original_mean": s["mean"],
        "original_std": s["std_pop"],
        "original_min": s["min"],
        "original_max": s["max"],
    }


def _affine(df: DataFrame, params: dict[str, tuple[float, float]], state: dict) -> ColumnStep:
    """x -> (x - centre) / scale, with the parameters kept so the step can be undone."""
    exprs = {}
    for c, (centre, scale) in params.items():
        state[c].update(centre=centre, scale=scale)
        exprs[c] = f"({num_sql(df, c)} - {lit_sql(centre)}) / {lit_sql(scale)}"
    return fitted(df, exprs, state=state)


def scale_minmax(
    df: DataFrame, columns: Sequence[str] | None = None, feature_range: tuple[float, float] = (0.0, 1.0)
) -> ColumnStep:
    """Map each column onto ``feature_range``; a constant column lands on its lower end."""
    low, high = map(float, feature_range)
    if not low < high:
        raise ValueError("feature_range must be increasing")
    stats = moments(df, _numeric(df, columns), ["mean", "std_pop", "min", "max"])
    exprs, state = {}, {}
    for c, s in stats.items():
        if s["min"] is None:
            continue
        width = s["max"] - s["min"]
        factor = (high - low) / (width if width else 1.0)
        state[c] = _base_state("minmax", s)
        # the inverse reads centre and scale: x = y * scale + centre
        state[c].update(scale_factor=factor, offset=low - s["min"] * factor)
        state[c].update(scale=1.0 / factor, centre=s["min"] - low / factor)
        exprs[c] = f"({num_sql(df, c)} - {lit_sql(s['min'])}) * {lit_sql(factor)} + {lit_sql(low)}"
    return fitted(df, exprs, state=state)


def scale_robust(df: DataFrame, columns: Sequence[str] | None = None) -> ColumnStep:
    """(x - median) / interquartile range, from exact quantiles."""
    names = _numeric(df, columns)
    stats = moments(df, names, ["n", "mean", "std_pop", "min", "max"])
    names = [c for c in names if stats[c]["n"]]
    q = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in names}, {c: stats[c]["n"] for c in names})
    state = {c: _base_state("robust", stats[c]) for c in names}
    return _affine(df, {c: (q[c][1], (q[c][2] - q[c][0]) or 1.0) for c in names}, state)


def scale_standard(
    df: DataFrame, columns: Sequence[str] | None = None, with_mean: bool = True, with_std: bool = True
) -> ColumnStep:
    """(x - mean) / population deviation; a constant column is only centred."""
    stats = moments(df, _numeric(df, columns), ["n", "mean", "std_pop", "min", "max"])
    stats = {c: s for c, s in stats.items() if s["n"]}
    state = {c: _base_state("standardization", s) for c, s in stats.items()}
    params = {
        c: (s["mean"] if with_mean else 0.0, (s["std_pop"] or 1.0) if with_std else 1.0) for c, s in stats.items()
    }
    return _affine(df, params, state)


def zscore_sample(df: DataFrame, columns: Sequence[str]) -> ColumnStep:
    """Add ``{col}_standardized`` (sample deviation) and ``{col}_normalized`` (min-max) columns."""
    stats = moments(df, columns, ["mean", "std", "min", "max"])
    exprs = {}
    for c, s in stats.items():
        x = num_sql(df, c)
        exprs[f"{c}_standardized"] = f"try_divide({x} - {lit_sql(s['mean'])}, {lit_sql(s['std'])})"
        exprs[f"{c}_normalized"] = f"try_divide({x} - {lit_sql(s['min'])}, {lit_sql(s['max'])} - {lit_sql(s['min'])})"
    return fitted(df, exprs, state=stats)


def log_transform(
    df: DataFrame, columns: Sequence[str] | None = None, add_constant: bool = True, suffix: str | None = None
) -> ColumnStep:
    """ln(1 + x) or ln(x), in place or as ``{col}{suffix}``; undefined logarithms are null."""
    fn = "log1p" if add_constant else "ln"
    return fitted(df, {f"{c}{suffix or ''}": f"{fn}({num_sql(df, c)})" for c in _numeric(df, columns)})


def log_skewed(df: DataFrame, columns: Sequence[str] | None = None, skew_threshold: float = 0.75) -> ColumnStep:
    """ln(1 + x) for columns that are all positive and skewed beyond the threshold."""
    stats = moments(df, _numeric(df, columns), ["min", "skew"])
    chosen = {
        c: s for c, s in stats.items() if s["min"] is not None and s["min"] > 0 and abs(s["skew"] or 0) > skew_threshold
    }
    return fitted(df, {c: f"log1p({num_sql(df, c)})" for c in chosen}, state=chosen)


def scaling_summary(df: DataFrame, step: ColumnStep) -> DataFrame:
    from ..functions.columns import local_rows

    rows = [
        (
            c,
            s["method"],
            s["original_mean"],
            s["original_std"],
            s["original_min"],
            s["original_max"],
            float(s["centre"]),
            float(s["scale"]),
        )
        for c, s in step.state.items()
    ]
    return local_rows(
        df.sparkSession,
        rows,
        "column string, method string, original_mean double, original_std double, original_min double, "
        "original_max double, centre double, scale double",
    )


def inverse_scale(df: DataFrame, step: ColumnStep, columns: Sequence[str] | None = None) -> DataFrame:
    """Undo a fitted scaling on the given (default: all scaled) columns."""
    names = [c for c in (columns or step.state) if c in step.state and c in df.columns]
    exprs = {
        c: f"{quote(c)} * {lit_sql(float(step.state[c]['scale']))} + {lit_sql(float(step.state[c]['centre']))}"
        for c in names
    }
    return fitted(df, exprs).transform(df)
