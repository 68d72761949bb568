"""Feature selection."""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass, field
from typing import Any, Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import tails
from ..functions.columns import col, columns_of, correlation, dtype_of, is_float, local_rows, num, num_sql
from ..functions.gram import gram_matrix
from ..functions.lineage import bounded, materialise
from ..functions.moments import moments
from . import penalised
from .engineer import bin_expr, quantile_edges
from .models import VECTOR, assembler, fit_model, importances
from .ordered import ordered_scan
from .scale import scale_standard


@dataclass
class Selection:
    method: str
    scores: dict[str, float | None]
    selected: list[str]
    p_values: dict[str, float | None] = field(default_factory=dict)
    extra: dict[str, Any] = field(default_factory=dict)

    @property
    def removed(self) -> list[str]:
        return [c for c in self.scores if c not in self.selected]

    def apply(self, df: DataFrame, *keep: str) -> DataFrame:
        """Project any table (for example the test set) onto the chosen columns."""
        return df.select(*[col(c) for c in [*self.selected, *keep]])

    def table(self, spark) -> DataFrame:
        rows = [
            (self.method, c, None if s is None else float(s), self.p_values.get(c), c in self.selected)
            for c, s in self.scores.items()
        ]
        return local_rows(spark, rows, "method string, feature string, score double, p_value double, selected boolean")


def selection_summary(spark, *selections: Selection) -> DataFrame:
    out = selections[0].table(spark)
    for s in selections[1:]:
        out = out.unionByName(s.table(spark))
    return out


def numeric_features(df: DataFrame, target: str | None, features: Sequence[str] | None) -> list[str]:
    return list(features) if features is not None else columns_of(df, "numeric", exclude=[target] if target else [])


def _top(scores: dict[str, float | None], k: int) -> list[str]:
    known = [c for c, s in scores.items() if s is not None and not math.isnan(s)]
    best = set(sorted(known, key=lambda c: (-scores[c], c))[: max(1, min(k, len(scores)))])
    return [c for c in scores if c in best]


# ---------------------------------------------------------------- univariate scores


def f_regression(df: DataFrame, features: Sequence[str], target: str) -> dict[str, tuple[float | None, float | None]]:
    """F and p of each single-feature regression, from one aggregate of correlations."""
    y = num(df, target)
    row = df.agg(
        *[correlation(num(df, c), y).alias(f"r{i}") for i, c in enumerate(features)],
        *[F.count(num(df, c) + y).alias(f"n{i}") for i, c in enumerate(features)],
    ).collect()[0]
    out = {}
    for i, c in enumerate(features):
        r, n = row[f"r{i}"], row[f"n{i}"]
        if r is None or math.isnan(r) or n < 3:
            out[c] = (None, None)
            continue
        f = r * r / (1.0 - r * r) * (n - 2) if abs(r) < 1.0 else math.inf
        out[c] = (f, tails.f_upper(f, 1, n - 2) if math.isfinite(f) else 0.0)
    return out


def f_classif(df: DataFrame, features: Sequence[str], target: str) -> dict[str, tuple[float | None, float | None]]:
    """One-way ANOVA of every feature over the classes, all features in one grouped aggregate."""
    from .hypothesis import anova_from

    aggs = []
    for i, c in enumerate(features):
        x = num(df, c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
    rows = df.where(col(target).isNotNull()).groupBy(col(target)).agg(*aggs).collect()
    out = {}
    for i, c in enumerate(features):
        groups = [{"n": r[f"n{i}"], "mean": r[f"m{i}"], "var_pop": r[f"v{i}"]} for r in rows if r[f"n{i}"]]
        got = anova_from(groups)
        out[c] = (got["statistic"], got["p_value"]) if got else (None, None)
    return out


def chi2(df: DataFrame, features: Sequence[str], target: str) -> dict[str, tuple[float | None, float | None]]:
    """Class sums of non-negative features against the sums expected from class shares."""
    aggs = [F.count(F.lit(1)).alias("n")] + [F.sum(num(df, c)).alias(f"s{i}") for i, c in enumerate(features)]
    low = df.agg(*[F.min(num(df, c)).alias(f"c{i}") for i, c in enumerate(features)]).collect()[0]
    if any(v is not None and v < 0 for v in low):
        raise ValueError("chi2 needs non-negative features")
    rows = df.where(col(target).isNotNull()).groupBy(col(target)).agg(*aggs).collect()
    n = sum(r["n"] for r in rows)
    out = {}
    for i, c in enumerate(features):
        total = sum(r[f"s{i}"] or 0.0 for r in rows)
        if not total:
            out[c] = (None, None)
            continue
        stat = 0.0
        for r in rows:
            expected = total * r["n"] / n
            stat += ((r[f"s{i}"] or 0.0) - expected) ** 2 / expected
        out[c] = (stat, tails.chi2_upper(stat, len(rows) - 1))
    return out


def mutual_info(df: DataFrame, features: Sequence[str], target: str, bins: int = 10) -> dict[str, tuple[float | None, float | None]]:
    """Mutual information of quantile-binned features with the target (binned when floating point)."""
    def coded(c: str):
        if dtype_of(df, c).simpleString() in ("string", "boolean"):
            return col(c).cast("string")
        return F.expr(bin_expr(num_sql(df, c), quantile_edges(df, c, bins, duplicates="drop"))).cast("string")

    y = coded(target) if is_float(dtype_of(df, target)) else col(target).cast("string")
    names = [f"c{i}" for i in range(len(features))]
    wide = df.select(y.alias("y"), *[coded(c).alias(n) for c, n in zip(features, names)]).where(F.col("y").isNotNull())
    cells = (
        wide.unpivot(["y"], names, "column", "x")
        .where(F.col("x").isNotNull())
        .groupBy("column", "x", "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cells = materialise(cells)

    def weighted(*keys: str) -> DataFrame:
        """Sum of n log n over the margin of the cells on ``keys``, per feature."""
        margin = cells.groupBy("column", *keys).agg(F.sum("n").alias("n"))
        return margin.groupBy("column").agg(F.sum(F.col("n") * F.log("n")).alias("s"))

    # n * MI = sum over cells - sum over each margin + n log n
    sides = {}
    for name, keys in (("cells", ("x", "y")), ("x", ("x",)), ("y", ("y",))):
        sides[name] = {r["column"]: r["s"] for r in weighted(*keys).collect()}
    totals = {r["column"]: r["n"] for r in cells.groupBy("column").agg(F.sum("n").alias("n")).collect()}
    found = {
        c: max((sides["cells"][c] - sides["x"][c] - sides["y"][c]) / n + math.log(n), 0.0) for c, n in totals.items() if n
    }
    return {c: (found.get(n_), None) for c, n_ in zip(features, names)}


SCORES = {"f_regression": f_regression, "f_classif": f_classif, "chi2": chi2, "mutual_info": mutual_info}


def kbest(df: DataFrame, target: str, k: int = 10, score: str = "f_regression", features: Sequence[str] | None = None, **options) -> Selection:
    """The k best features by a univariate score."""
    features = numeric_features(df, target, features)
    got = SCORES[score](df, features, target, **options)
    scores = {c: s for c, (s, _) in got.items()}
    return Selection(f"kbest_{score}", scores, _top(scores, k), {c: p for c, (_, p) in got.items()})


def variance_threshold(df: DataFrame, threshold: float = 0.0, features: Sequence[str] | None = None) -> Selection:
    features = numeric_features(df, None, features)
    scores = {c: m["var_pop"] for c, m in moments(df, features, ["var_pop"]).items()}
    return Selection("variance_threshold", scores, [c for c, v in scores.items() if v is not None and v > threshold])


# ---------------------------------------------------------------- model based


def lasso_select(
    df: DataFrame, target: str, alpha: float | None = 0.1, threshold: float = 1e-5, features: Sequence[str] | None = None, key: str | None = None
) -> Selection:
    """Features whose lasso coefficient on standardised inputs is not negligible, at least one.

    ``alpha=None`` chooses it by 5-fold cross-validation over a falling path (needs ``key``).
    """
    features = numeric_features(df, target, features)
    step = scale_standard(df, features)
    scaled = step.transform(df)
    if alpha is None:
        from .tuning import FOLD, with_folds

        scaled = with_folds(scaled, key, 5, 42)
        # scaled features have mean zero; the target is shifted by one of its values, which costs no scan
        stats = penalised.statistics(scaled, features, target, FOLD, {**dict.fromkeys(features, 0.0), target: _some_value(df, target)})
        total = stats.all()
        centred = total[1:, 1:] - total[1:, :1] * total[:1, 1:] / total[0, 0]
        peak = float(np.abs(centred[:-1, -1]).max() / total[0, 0])
        path = [{"alpha": peak * 10 ** (-3 * i / 9)} for i in range(10)]
        scores = penalised.cross_validated(scaled, stats, target, "lasso", path, "mse", FOLD)
        alpha = path[int(np.argmin(scores))]["alpha"]
    else:
        stats = penalised.statistics(scaled, features, target, means={**dict.fromkeys(features, 0.0), target: _some_value(df, target)})
    weight = dict(importances(penalised.from_statistics(stats, "lasso", {"alpha": alpha}), features))
    chosen = [c for c in features if weight[c] > threshold] or [max(features, key=lambda c: weight[c])]
    return Selection("lasso", weight, chosen, extra={"alpha": alpha})


def _some_value(df: DataFrame, column: str) -> float:
    """Any value of the column; products of differences from it stay small."""
    row = df.select(num(df, column).alias("y")).where(F.col("y").isNotNull()).limit(1).collect()
    return float(row[0]["y"]) if row else 0.0


def ridge_select(df: DataFrame, target: str, alpha: float = 1.0, features: Sequence[str] | None = None) -> Selection:
    """Features whose ridge coefficient is at least the mean coefficient in size."""
    features = numeric_features(df, target, features)
    weight = dict(importances(fit_model(df, features, target, "ridge", {"alpha": alpha}), features))
    mean = sum(weight.values()) / len(weight)
    return Selection("ridge", weight, [c for c in features if weight[c] >= mean], extra={"alpha": alpha})


def rfe(
    df: DataFrame, target: str, n_features: int = 5, step: int = 1, features: Sequence[str] | None = None, estimator=None
) -> Selection:
    """Drop the least important features round by round; a failed fit falls back to the F score.

    Rank 1 marks the kept features, larger ranks those dropped earlier.
    """
    features = numeric_features(df, target, features)
    estimator = estimator or RandomForestRegressor(numTrees=50, maxDepth=5, seed=42)
    vectors = bounded(assembler(features).transform(df).select(VECTOR, num(df, target).alias("y")))
    vectors = vectors.persist(StorageLevel.DISK_ONLY)  # memory is left to the trees
    left, dropped = list(range(len(features))), []
    try:
        while len(left) > n_features:
            rows = VectorSlicer(inputCol=VECTOR, outputCol="__cut", indices=left).transform(vectors)
            model = estimator.copy({estimator.featuresCol: "__cut", estimator.labelCol: "y"}).fit(rows)
            weight = importances(model, [str(i) for i in left])
            worst = sorted(weight, key=lambda r: (r[1], -int(r[0])))[: min(step, len(left) - n_features)]
            dropped.append([int(i) for i, _ in worst])
            left = [i for i in left if i not in dropped[-1]]
    except Exception as failure:  # the fallback of the method, not of a bug: any estimator may be passed in
        warnings.warn(f"recursive elimination failed, ranking by F score instead: {failure}", stacklevel=2)
        return kbest(df, target, n_features, features=features)
    finally:
        vectors.unpersist()
    ranks = {features[i]: 1 for i in left}
    for r, gone in enumerate(reversed(dropped)):
        ranks.update({features[i]: r + 2 for i in gone})
    return Selection("rfe", {c: float(ranks[c]) for c in features}, [features[i] for i in left])


def forest_select(
    df: DataFrame, target: str, n_features: int | None = None, features: Sequence[str] | None = None, **params
) -> Selection:
    """The most important features of a random forest, half of them by default."""
    features = numeric_features(df, target, features)
    model = fit_model(df, features, target, "random_forest", {"n_estimators": 100, "random_state": 42, **params})
    weight = dict(importances(model, features))
    return Selection("random_forest", weight, _top(weight, n_features or max(1, len(features) // 2)))


def model_select(
    df: DataFrame, target: str, task: str = "regression", features: Sequence[str] | None = None, **params
) -> Selection:
    """Features at or above the median importance of boosted trees."""
    features = numeric_features(df, target, features)
    weight = dict(importances(fit_model(df, features, target, "gbt", params, task), features))
    middle = float(np.median(list(weight.values())))
    return Selection("model", weight, [c for c in features if weight[c] >= middle])


# ---------------------------------------------------------------- collinearity


def _vif(g: np.ndarray) -> np.ndarray:
    scale = np.sqrt(np.diag(g))
    scale[scale == 0] = 1.0
    unit = g / np.outer(scale, scale)
    try:
        inverse = np.linalg.inv(unit)
    except np.linalg.LinAlgError:
        # an exactly dependent column has an infinite factor
        out = np.full(len(g), np.inf)
        for i in range(len(g)):
            rest = [j for j in range(len(g)) if j != i]
            b = unit[np.ix_(rest, [i])]
            fit = float((b.T @ np.linalg.pinv(unit[np.ix_(rest, rest)]) @ b)[0, 0])
            out[i] = 1.0 / (1.0 - fit) if fit < 1.0 - 1e-12 else np.inf
        return out
    return np.diag(inverse)


def vif_scores(df: DataFrame, features: Sequence[str], standardise: bool = False) -> dict[str, float]:
    """Variance inflation factors from one cross-product matrix, without an added constant."""
    shift = [m["mean"] for m in moments(df, features, ["mean"]).values()] if standardise else None
    _, g = gram_matrix(df, features, shift)
    return {c: float(v) for c, v in zip(features, _vif(g))}


def vif_select(
    df: DataFrame, threshold: float = 5.0, target: str | None = None, features: Sequence[str] | None = None, one_pass: bool = False
) -> Selection:
    """Remove the most collinear feature until all factors are within the threshold.

    The cross-product matrix is computed once; every later round only drops a row and a column of it.
    ``one_pass`` instead keeps the features below the threshold on standardised data.
    """
    features = numeric_features(df, target, features)
    if one_pass:
        scores = vif_scores(df, features, standardise=True)
        return Selection("vif", scores, [c for c in features if scores[c] < threshold])
    _, g = gram_matrix(df, features)
    left = list(range(len(features)))
    initial = _vif(g)
    removed, current = {}, initial
    while len(left) > 1 and current.max() > threshold:
        # equal factors (always the case for the last two) are told apart by position, not by rounding noise
        worst = int(np.argmax([float(f"{v:.9g}") for v in current]))
        removed[features[left[worst]]] = float(current[worst])
        left.pop(worst)
        current = _vif(g[np.ix_(left, left)])
    return Selection(
        "vif",
        {c: float(v) for c, v in zip(features, initial)},
        [features[i] for i in left],
        extra={"final_vif": {features[i]: float(v) for i, v in zip(left, current)}, "removed_vif": removed},
    )


# ---------------------------------------------------------------- one-feature neighbours


def knn_feature_score(df: DataFrame, feature: str, target: str, key: str, k: int = 5) -> float | None:
    """R2 of a k-nearest-neighbour fit on one feature, scored on its own rows (a row is its own neighbour).

    Rows of equal feature value share their neighbours, so everything happens on the table of distinct
    values: each keeps its k first rows by key, meets the k values on either side of it in order, and
    the error follows from its row count, sum and sum of squares of the target.
    """
    slim = df.select(num(df, feature).alias("x"), num(df, target).alias("y"), col(key).alias("key")).na.drop()
    total = slim.agg(F.count(F.lit(1)).alias("n"), F.var_pop("y").alias("v"), F.avg("y").alias("m")).collect()[0]
    if not total["n"] or not total["v"]:
        return None
    slim = slim.withColumn("y", F.col("y") - F.lit(total["m"]))
    sums = slim.groupBy("x").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("ss")
    )
    # the row_number limit is applied inside each task before the shuffle, so a hot value sends k rows per task
    w = Window.partitionBy("x").orderBy("key")
    heads = slim.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k)
    heads = heads.groupBy("x").agg(F.collect_list(F.struct("x", "key", "y")).alias("head"))
    indexed = ordered_scan(sums.join(heads, "x"), [F.col("x")], index="i")
    offers = indexed.select(
        F.explode(F.sequence(F.col("i") - k, F.col("i") + k)).alias("i"), "head"
    ).groupBy("i").agg(F.flatten(F.collect_list("head")).alias("near"))
    met = indexed.select("i", "x", "n", "s", "ss").join(offers, "i")
    ordered = F.array_sort(
        F.transform("near", lambda e: F.struct(F.abs(e["x"] - F.col("x")).alias("d"), e["key"].alias("key"), e["y"].alias("y")))
    )
    best = F.slice(ordered, 1, k)
    guess = F.aggregate(best, F.lit(0.0), lambda a, e: a + e["y"]) / F.size(best)
    error = met.withColumn("p", guess).agg(
        F.sum(F.col("ss") - 2.0 * F.col("p") * F.col("s") + F.col("n") * F.col("p") * F.col("p")).alias("e")
    ).collect()[0]["e"]
    return 1.0 - error / (total["v"] * total["n"])


def knn_score_select(
    df: DataFrame, target: str, key: str, n_features: int = 10, n_neighbors: int = 5, features: Sequence[str] | None = None
) -> Selection:
    features = [c for c in numeric_features(df, target, features) if c != key]
    scores = {c: knn_feature_score(df, c, target, key, n_neighbors) for c in features}
    return Selection("knn", scores, _top(scores, n_features))


def select_features(df: DataFrame, target: str, method: str, key: str | None = None, **params) -> Selection:
    """Dispatch by name: k_best, lasso, rfe, random_forest, vif or knn."""
    if method in ("k_best", "k-best"):
        return kbest(df, target, params.pop("k", 10), params.pop("score_func", "f_regression"), **params)
    if method == "lasso":
        return lasso_select(df, target, key=key, **params)
    if method == "rfe":
        return rfe(df, target, params.pop("n_features_to_select", 5), **params)
    if method == "random_forest":
        return forest_select(df, target, **params)
    if method == "vif":
        return vif_select(df, target=target, **params)
    if method == "knn":
        if key is None:
            raise ValueError("knn selection needs the key column")
        return knn_score_select(df, target, key, **params)
    raise ValueError(f"unknown selection method {method!r}")
