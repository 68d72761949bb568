"""Ridge, lasso and elastic net from sufficient statistics.

All that least squares needs of a table is one cross-product matrix of (1, features, target), here one per
fold, made in one scan after one for the means that keep the products small.  Training sets of a
cross-validation are differences of those matrices, every penalty is solved on p x p numbers, and squared errors
of held-out folds are quadratic forms.  So a whole search reads the table twice, whatever the number of
candidates and folds.

Lasso and elastic net go down the penalty path by coordinate descent, each point started from the last one.
The objectives are ``|y - Xb|^2 + alpha |b|^2`` for ridge, and ``|y - Xb|^2 / 2n + alpha (r |b|_1 + (1 - r) / 2
|b|^2)`` for elastic net, of which lasso is r = 1.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import lit_sql, num, quote
from ..functions.treesum import rows_of, tree_sum

PENALISED = ("ridge", "lasso", "elastic_net")
METRICS = ("mse", "rmse", "r2", "mae")
SWEEPS = 100_000
EXACT = 1e-13  # relative change of a coefficient at which a path point is done


@dataclass
class LinearModel:
    """A linear formula; applying it is one projection."""

    features: list[str]
    weights: list[float]
    intercept: float

    @property
    def coefficients(self) -> DenseVector:
        return Vectors.dense(self.weights)

    def formula(self) -> str:
        terms = [f"{lit_sql(w)} * CAST({quote(c)} AS DOUBLE)" for c, w in zip(self.features, self.weights)]
        return " + ".join([lit_sql(self.intercept), *terms])

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select("*", F.expr(self.formula()).alias("prediction"))

    def stage(self) -> SQLTransformer:
        return SQLTransformer(statement=f"SELECT *, {self.formula()} AS prediction FROM __THIS__")


@dataclass
class Statistics:
    """Cross products of (1, features - shift, target - shift) per fold."""

    features: list[str]
    shift: np.ndarray
    folds: dict[int, np.ndarray]

    def all(self) -> np.ndarray:
        return sum(self.folds.values())


def _laid(df: DataFrame, columns: Sequence[str], fold: str | None) -> DataFrame:
    each = F.array(*[num(df, c).cast("double") for c in columns])
    return df.select(each.alias("v"), (F.col(fold).cast("int") if fold else F.lit(0)).alias("fold"))


def _split(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    x = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
    folds = batch.column("fold").to_numpy()
    for f in np.unique(folds).tolist():
        yield f, x[folds == f]


def statistics(df: DataFrame, features: Sequence[str], target: str, fold: str | None = None, means: Mapping[str, float] | None = None) -> Statistics:
    """Two scans, or one where the means are known; rows with missing values are refused."""
    columns = [*features, target]
    if means is None:
        row = df.agg(*[F.avg(num(df, c)).alias(f"m{i}") for i, c in enumerate(columns)]).collect()[0]
        means = {c: row[f"m{i}"] for i, c in enumerate(columns)}
    shift = np.array([means[c] or 0.0 for c in columns])
    width = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for f, x in _split(batch, width):
                gone = np.isnan(x).any(axis=1)
                z = np.column_stack([np.ones(len(x)), x - shift])[~gone]
                for name, value in ((str(f), (z.T @ z).ravel()), ("missing", np.array([gone.sum()], float))):
                    sums[name] = sums[name] + value if name in sums else value
        if sums:
            yield rows_of(sums)

    got = tree_sum(_laid(df, columns, fold).mapInArrow(run, "block string, v array<double>"))
    if got.pop("missing", np.zeros(1))[0]:
        raise ValueError("rows with missing features or target: impute or drop them first")
    return Statistics(list(features), shift, {int(f): g.reshape(width + 1, -1) for f, g in got.items()})


def _penalties(name: str, params: Mapping[str, Any], n: float) -> tuple[float, float]:
    """Weights of |b|_1 and |b|^2 / 2 beside the mean squared error / 2."""
    alpha = float(params.get("alpha", 1.0))
    if name == "ridge":
        return 0.0, alpha / n
    ratio = 1.0 if name == "lasso" else float(params.get("l1_ratio", 0.5))
    return alpha * ratio, alpha * (1.0 - ratio)


def _descend(q: np.ndarray, c: np.ndarray, l1: float, l2: float, start: np.ndarray) -> np.ndarray:
    """Coordinate descent for b'Qb/2 - c'b + l1 |b|_1 + l2 |b|^2 / 2, cycling over the moving coordinates."""
    b, weight = start.copy(), np.diag(q) + l2
    usable = np.flatnonzero(weight > 0)
    gradient = c - q @ b
    some = usable
    for _ in range(SWEEPS):
        moved = 0.0
        for j in some:
            pull = gradient[j] + q[j, j] * b[j]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / weight[j]
            if new != b[j]:
                moved = max(moved, abs(new - b[j]) / max(abs(new), abs(b[j])))
                gradient -= q[:, j] * (new - b[j])
                b[j] = new
        if moved <= EXACT:
            if len(some) == len(usable):
                break
            some = usable  # a full round confirms the rest
        else:
            some = np.flatnonzero(b) if b.any() else usable
    return b


def solve(stats: Statistics, gram: np.ndarray, name: str, params: Mapping[str, Any], start: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) for the rows that ``gram`` sums up."""
    n, p = gram[0, 0], len(stats.features)
    if not n:
        raise ValueError("no rows to learn from")
    low = gram[0, 1:] / n
    mean, second = low + stats.shift, gram[1:, 1:] / n
    if params.get("fit_intercept", True):
        second = second - np.outer(low, low)
    else:
        second = second + np.outer(stats.shift, low) + np.outer(low, stats.shift) + np.outer(stats.shift, stats.shift)
    q, c = second[:p, :p], second[:p, p]
    l1, l2 = _penalties(name, params, n)
    if l1:
        b = _descend(q, c, l1, l2, np.zeros(p) if start is None else start)
    else:
        b = np.linalg.lstsq(q + l2 * np.eye(p), c, rcond=None)[0]
    return b, float(mean[p] - b @ mean[:p]) if params.get("fit_intercept", True) else 0.0


def _errors(stats: Statistics, gram: np.ndarray, b: np.ndarray, intercept: float) -> tuple[float, float, float]:
    """(rows, squared error, squared deviation of the target) from a cross-product matrix."""
    p = len(b)
    w = np.concatenate([[stats.shift[p] - intercept - b @ stats.shift[:p]], -b, [1.0]])
    return gram[0, 0], max(0.0, float(w @ gram @ w)), float(gram[p + 1, p + 1] - gram[0, p + 1] ** 2 / gram[0, 0])


def fit(df: DataFrame, features: Sequence[str], target: str, name: str, params: Mapping[str, Any] | None = None) -> LinearModel:
    return from_statistics(statistics(df, features, target), name, params or {})


def from_statistics(stats: Statistics, name: str, params: Mapping[str, Any]) -> LinearModel:
    b, intercept = solve(stats, stats.all(), name, params)
    return LinearModel(list(stats.features), [float(x) for x in b], intercept)


def _solved(stats: Statistics, gram: np.ndarray, name: str, candidates: Sequence[Mapping[str, Any]]) -> list[tuple[np.ndarray, float]]:
    """All candidates, strongest penalty first so that each starts from its neighbour on the path."""
    rest = lambda i: str(sorted((k, v) for k, v in candidates[i].items() if k != "alpha"))
    order = sorted(range(len(candidates)), key=lambda i: (rest(i), -float(candidates[i].get("alpha", 1.0))))
    out: list = [None] * len(candidates)
    start, before = None, None
    for i in order:
        start = start if rest(i) == before else None
        out[i] = solve(stats, gram, name, candidates[i], start)
        start, before = out[i][0], rest(i)
    return out


def cross_validated(df: DataFrame, stats: Statistics, target: str, name: str, candidates: Sequence[Mapping[str, Any]], metric: str, fold: str) -> list[float]:
    """Mean over the folds of a metric of every candidate.  Only absolute errors read the table once more."""
    total = stats.all()
    found = {f: _solved(stats, total - g, name, candidates) for f, g in stats.folds.items()}
    if metric == "mae":
        sums = _absolute(df, stats, target, found, fold)
        each = [[sums[f][i] / g[0, 0] for f, g in stats.folds.items()] for i in range(len(candidates))]
    else:
        score = {"mse": lambda n, e, d: e / n, "rmse": lambda n, e, d: (e / n) ** 0.5, "r2": lambda n, e, d: 1 - e / d if d else 0.0}[metric]
        each = [[score(*_errors(stats, g, *found[f][i])) for f, g in stats.folds.items()] for i in range(len(candidates))]
    return [sum(v) / len(v) for v in each]


def _absolute(df: DataFrame, stats: Statistics, target: str, found: Mapping[int, list], fold: str) -> dict[int, np.ndarray]:
    """Per fold: the sum of absolute errors of every candidate."""
    columns = [*stats.features, target]
    weights = {f: (np.stack([b for b, _ in each], axis=1), np.array([i for _, i in each])) for f, each in found.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for f, x in _split(batch, len(columns)):
                b, intercept = weights[f]
                value = np.abs(x[:, -1:] - x[:, :-1] @ b - intercept).sum(axis=0)
                sums[str(f)] = sums[str(f)] + value if str(f) in sums else value
        if sums:
            yield rows_of(sums)

    return {int(f): v for f, v in tree_sum(_laid(df, columns, fold).mapInArrow(run, "block string, v array<double>")).items()}
