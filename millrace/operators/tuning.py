"""Hyper-parameter search, cross-validation and learning diagnostics.

Folds come from the deterministic hash split, so every candidate sees the same ones.  Models with a
Spark ML estimator go through ``CrossValidator``; the others through a loop whose fold predictions are
scored in one aggregate.
"""

from __future__ import annotations

import itertools
import random
from dataclasses import dataclass
from typing import Any, Callable, Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, local_rows, num
from ..functions.hashing import hash_hex, hash_unit, poisson_times
from ..functions.lineage import bounded
from . import penalised
from .evaluate import regression_aggregates
from .models import VECTOR, assembler, canonical, drop_unset, fit_model, native_estimator, predict, spark_params
from .split import kfold, parts, split_random

FOLD = "__fold"
PARALLEL = 4
LOOP_MODELS = ("adaboost", "bagging", "knn", "rbf_regression", *penalised.PENALISED, "logistic", "linear_svc")

# Default search spaces by model, for parameters that act on a Spark model.
DEFAULT_GRIDS: dict[str, dict[str, list]] = {
    "linear": {"fit_intercept": [True, False]},
    "ridge": {"alpha": [0.0001, 0.001, 0.01, 0.1, 1, 10], "fit_intercept": [True, False]},
    "lasso": {"alpha": [0.0001, 0.001, 0.01, 0.1, 1, 10], "fit_intercept": [True, False]},
    "elastic_net": {"alpha": [0.0001, 0.001, 0.01, 0.1, 1, 10], "l1_ratio": [0.1, 0.3, 0.5, 0.7, 0.9], "fit_intercept": [True, False]},
    "logistic": {"penalty": ["l1", "l2", "elasticnet", "none"], "C": [0.0001, 0.001, 0.01, 0.1, 1, 10, 100]},
    "random_forest": {"n_estimators": [100, 200, 500], "max_depth": [10, 20, 30], "min_samples_leaf": [1, 2, 4]},
    "gbt": {"n_estimators": [100, 200, 500], "max_depth": [3, 5, 7], "learning_rate": [0.01, 0.05, 0.1], "subsample": [0.6, 0.8, 1.0]},
    "rbf_regression": {"C": [0.1, 1, 10, 100], "gamma": ["scale", 0.001, 0.01, 0.1, 1]},
    "linear_svc": {"C": [0.1, 1, 10, 100]},
    "knn": {"n_neighbors": [3, 5, 7, 9, 11], "weights": ["uniform", "distance"], "p": [1, 2, 3]},
    "adaboost": {"n_estimators": [50, 100, 200], "learning_rate": [0.01, 0.1, 0.5, 1.0], "loss": ["linear", "square", "exponential"]},
    "bagging": {"n_estimators": [10, 20, 50], "max_samples": [0.5, 0.7, 1.0], "max_features": [0.5, 0.7, 1.0]},
}


def default_metric(task: str) -> str:
    return "roc_auc" if task == "classification" else "mse"


def larger_is_better(metric: str) -> bool:
    return metric not in ("mse", "mae", "rmse")


def evaluator(metric: str, target: str):
    if metric in ("mse", "mae", "rmse", "r2"):
        return RegressionEvaluator(labelCol=target, predictionCol="prediction", metricName=metric)
    if metric == "roc_auc":
        return BinaryClassificationEvaluator(labelCol=target, rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=0)
    name = {"precision": "weightedPrecision", "recall": "weightedRecall"}.get(metric, metric)
    return MulticlassClassificationEvaluator(labelCol=target, predictionCol="prediction", metricName=name)


@dataclass
class Search:
    best_params: dict[str, Any]
    best_score: float
    table: DataFrame
    model: Any


def combinations_of(grid: Mapping[str, Sequence]) -> list[dict[str, Any]]:
    names = list(grid)
    return [dict(zip(names, values)) for values in itertools.product(*[grid[n] for n in names])]


def sample_candidates(space: Mapping[str, Any], n_iter: int, seed: int = 42) -> list[dict[str, Any]]:
    """Draws from lists, ``("uniform", low, width)`` or ``("int", low, high)`` ranges, without repeats of a finite grid."""
    rng = random.Random(seed)
    finite = all(not isinstance(v, tuple) for v in space.values())
    if finite:
        everything = combinations_of(space)
        return everything if len(everything) <= n_iter else rng.sample(everything, n_iter)
    out = []
    for _ in range(n_iter):
        draw = {}
        for k, v in space.items():
            if isinstance(v, tuple):
                kind, a, b = v
                draw[k] = rng.uniform(a, a + b) if kind == "uniform" else rng.randrange(int(a), int(b))
            else:
                draw[k] = rng.choice(list(v))
        out.append(draw)
    return out


def with_folds(df: DataFrame, key: str | None, cv: int, seed: int, stratify: str | None = None) -> DataFrame:
    if key is None:
        # without a key the row itself is hashed; equal rows then share a fold
        return df.withColumn(FOLD, (F.pmod(F.xxhash64(F.struct(*[col(c) for c in df.columns])), F.lit(cv))).cast("int"))
    return kfold(df, key, cv, stratify, seed, output=FOLD)


def _fold_predictions(df: DataFrame, cv: int, fit: Callable[[DataFrame], Any], target: str) -> DataFrame:
    out = None
    for f in range(cv):
        train = df.where(F.col(FOLD) != f)
        model = fit(train)
        scored = predict(model, df.where(F.col(FOLD) == f))
        keep = [F.col(FOLD), num(scored, target).alias("y"), F.col("prediction").cast("double").alias("p")]
        if "score" in scored.columns:
            keep.append(F.col("score").alias("s"))
        scored = scored.select(*keep)
        out = scored if out is None else out.unionByName(scored)
    return out


def _loop_score(preds: DataFrame, metric: str) -> list[float]:
    if metric == "roc_auc":
        # one aggregate over all folds: ties share the mean rank through the grouped scores
        from .evaluate import roc_auc

        folds = sorted(r[0] for r in preds.select(FOLD).distinct().collect())
        return [roc_auc(preds.where(F.col(FOLD) == f), "y", "s").collect()[0][0] for f in folds]
    if metric in WEIGHTED:
        return _weighted_scores(preds, WEIGHTED[metric])
    if metric == "accuracy":
        value = F.avg((F.col("y") == F.col("p")).cast("double"))
    else:
        value = regression_aggregates(F.col("y"), F.col("p"))[metric]
    return [r["v"] for r in preds.groupBy(FOLD).agg(value.alias("v")).orderBy(FOLD).collect()]


# Metrics averaged over the classes, weighted by their true rows.
WEIGHTED = {
    "f1": "f1", "weightedPrecision": "precision", "precision": "precision", "weightedRecall": "recall", "recall": "recall",
}


def _weighted_scores(preds: DataFrame, kind: str) -> list[float]:
    """Per fold: the class measure from the counts of (true, predicted), weighted by class size."""
    cells = preds.groupBy(FOLD, "y", "p").agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    true = cells.groupBy(FOLD, F.col("y").alias("label")).agg(F.sum("n").alias("size"), F.sum(hit).alias("hits"))
    said = cells.groupBy(FOLD, F.col("p").alias("label")).agg(F.sum("n").alias("named"))
    both = true.join(said, [FOLD, "label"], "left").fillna(0, ["named"])
    precision = F.coalesce(F.try_divide(F.col("hits"), F.col("named")), F.lit(0.0))
    recall = F.col("hits") / F.col("size")
    measure = {"precision": precision, "recall": recall, "f1": 2.0 * F.col("hits") / (F.col("size") + F.col("named"))}[kind]
    value = F.sum(measure * F.col("size")) / F.sum("size")
    return [r["v"] for r in both.groupBy(FOLD).agg(value.alias("v")).orderBy(FOLD).collect()]


def _one_vs_rest(df: DataFrame, target: str, task: str, name: str) -> bool:
    """Boosted trees of several classes are wrapped, and the wrapper hides their parameters from a search."""
    return task == "classification" and name == "gbt" and df.select(num(df, target)).distinct().limit(3).count() > 2


def search(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    name: str,
    candidates: Sequence[Mapping[str, Any]],
    cv: int = 5,
    task: str = "regression",
    metric: str | None = None,
    key: str | None = None,
    seed: int = 42,
    refit: bool = True,
    resample: Callable[[DataFrame], DataFrame] | None = None,
) -> Search:
    """Score every candidate on the same folds and refit the best on all rows.

    ``resample`` rebalances the training part of every fold (and the rows of the final fit); the
    held-out part is never touched.
    """
    prepare = resample or (lambda t: t)
    metric = metric or default_metric(task)
    folded = with_folds(df, key, cv, seed, target if task == "classification" and key else None)
    name_ = canonical(name)
    if task == "regression" and name_ in penalised.PENALISED and metric in penalised.METRICS and resample is None:
        return _penalised_search(folded, features, target, name_, candidates, metric, refit)
    folded = bounded(folded).persist()
    scores: list[float] = []
    try:
        if name_ in LOOP_MODELS or resample is not None or _one_vs_rest(folded, target, task, name_):
            for c in candidates:
                preds = _fold_predictions(folded, cv, lambda t: fit_model(prepare(t), features, target, name, c, task, key), target)
                got = _loop_score(preds, metric)
                scores.append(sum(got) / len(got))
        else:
            est = native_estimator(name, {}, task, target)
            maps = []
            for c in candidates:
                settings = spark_params(name, c, task)
                maps.append({est.getParam(k): v for k, v in settings.items()})
            validator = CrossValidator(
                estimator=Pipeline(stages=[assembler(features), est]),
                estimatorParamMaps=maps,
                evaluator=evaluator(metric, target),
                numFolds=cv,
                foldCol=FOLD,
                parallelism=PARALLEL,
            )
            scores = list(validator.fit(folded).avgMetrics)
    finally:
        folded.unpersist()
    found = _ranked(df, candidates, scores, metric)
    if refit:
        found.model = fit_model(prepare(df), features, target, name, found.best_params, task, key)
    return found


def _ranked(df: DataFrame, candidates: Sequence[Mapping[str, Any]], scores: Sequence[float], metric: str) -> Search:
    order = sorted(range(len(scores)), key=lambda i: (-scores[i] if larger_is_better(metric) else scores[i], i))
    rows = [(rank + 1, {k: str(v) for k, v in candidates[i].items()}, metric, float(scores[i])) for rank, i in enumerate(order)]
    table = local_rows(df.sparkSession, rows, "rank int, params map<string,string>, metric string, score double")
    return Search(dict(candidates[order[0]]), float(scores[order[0]]), table, None)


def _penalised_search(folded: DataFrame, features, target: str, name: str, candidates, metric: str, refit: bool) -> Search:
    """All candidates, folds and the final fit from cross products: two scans, a third for absolute errors."""
    candidates = [drop_unset(c) for c in candidates]
    stats = penalised.statistics(folded, features, target, FOLD)
    scores = penalised.cross_validated(folded, stats, target, name, candidates, metric, FOLD)
    found = _ranked(folded, candidates, scores, metric)
    if refit:
        found.model = penalised.from_statistics(stats, name, found.best_params)
    return found


def grid_search(df, features, target, name, grid: Mapping[str, Sequence] | None = None, **options) -> Search:
    return search(df, features, target, name, combinations_of(grid or DEFAULT_GRIDS[canonical(name)]), **options)


def random_search(df, features, target, name, space: Mapping[str, Any] | None = None, n_iter: int = 100, seed: int = 42, **options) -> Search:
    picks = sample_candidates(space or DEFAULT_GRIDS[canonical(name)], n_iter, seed)
    return search(df, features, target, name, picks, seed=seed, **options)


def narrowed_grid(best: Mapping[str, Any]) -> dict[str, list]:
    """A grid around a found point: 20 trees and one level either way, the rate by a fifth."""
    grid: dict[str, list] = {k: [v] for k, v in best.items()}
    if "n_estimators" in best:
        n = int(best["n_estimators"])
        grid["n_estimators"] = sorted({max(1, n - 20), n, n + 20})
    if "learning_rate" in best:
        # Spark's boosting takes rates up to 1
        grid["learning_rate"] = sorted({min(1.0, best["learning_rate"] * f) for f in (0.8, 1.0, 1.2)})
    if "max_depth" in best:
        d = int(best["max_depth"])
        grid["max_depth"] = sorted({max(1, d - 1), d, d + 1})
    return grid


def narrowed_search(df, features, target, name, space: Mapping[str, Any], n_iter: int = 20, seed: int = 42, **options) -> Search:
    """Random search over the space, then a grid around its best point."""
    first = random_search(df, features, target, name, space, n_iter, seed, refit=False, **options)
    return grid_search(df, features, target, name, narrowed_grid(first.best_params), seed=seed, **options)


def joint_search(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    name: str,
    components: Sequence[int],
    grid: Mapping[str, Sequence],
    cv: int = 3,
    task: str = "regression",
    metric: str | None = None,
    key: str | None = None,
    seed: int = 42,
) -> Search:
    """Tune scaling, principal components and the model together as one Spark ML ``Pipeline``."""
    metric = metric or default_metric(task)
    est = native_estimator(name, {}, task, target)
    if est is None:
        raise ValueError(f"{name} is not a Spark ML estimator")
    scaler = StandardScaler(inputCol=VECTOR, outputCol="__scaled", withMean=True, withStd=True)
    reduce = PCA(inputCol="__scaled", outputCol="__components")
    est.setFeaturesCol("__components")
    chain = Pipeline(stages=[assembler(features), scaler, reduce, est])
    builder = ParamGridBuilder().addGrid(reduce.k, list(components))
    names = {}
    for k, values in grid.items():
        translated = [spark_params(name, {k: v}, task) for v in values]
        param = next(p for p in translated[0] if p != "maxDepth" or k in ("max_depth", "depth"))
        builder = builder.addGrid(est.getParam(param), [t[param] for t in translated])
        names[param] = k
    maps = builder.build()
    folded = bounded(with_folds(df, key, cv, seed)).persist()
    try:
        fitted = CrossValidator(
            estimator=chain, estimatorParamMaps=maps, evaluator=evaluator(metric, target), numFolds=cv, foldCol=FOLD, parallelism=PARALLEL
        ).fit(folded)
    finally:
        folded.unpersist()
    found = [({("n_components" if p.name == "k" else names[p.name]): v for p, v in m.items()}, s) for m, s in zip(maps, fitted.avgMetrics)]
    found.sort(key=lambda r: -r[1] if larger_is_better(metric) else r[1])
    rows = [(i + 1, {k: str(v) for k, v in c.items()}, metric, float(s)) for i, (c, s) in enumerate(found)]
    table = local_rows(df.sparkSession, rows, "rank int, params map<string,string>, metric string, score double")
    return Search(found[0][0], float(found[0][1]), table, fitted.bestModel)


# ---------------------------------------------------------------- diagnostics


def cv_evaluate(df, features, target, name, params=None, cv: int = 5, key: str | None = None, seed: int = 42) -> DataFrame:
    """Regression metrics of every fold and their mean and population deviation."""
    folded = with_folds(df, key, cv, seed)
    preds = _fold_predictions(folded, cv, lambda t: fit_model(t, features, target, name, params, "regression", key), target)
    wanted = ["mse", "rmse", "mae", "r2", "explained_variance"]
    aggs = regression_aggregates(F.col("y"), F.col("p"))
    rows = [r.asDict() for r in preds.groupBy(FOLD).agg(*[aggs[m].alias(m) for m in wanted]).orderBy(FOLD).collect()]
    out = [(str(r[FOLD]), *[r[m] for m in wanted]) for r in rows]
    means = [sum(r[m] for r in rows) / len(rows) for m in wanted]
    out.append(("mean", *means))
    out.append(("std", *[(sum((r[m] - mu) ** 2 for r in rows) / len(rows)) ** 0.5 for m, mu in zip(wanted, means)]))
    return local_rows(df.sparkSession, out, "fold string, " + ", ".join(f"{m} double" for m in wanted))


def _curve(runs: list[tuple[Any, DataFrame, DataFrame]], label: str) -> DataFrame:
    """Mean and deviation of train and validation MSE per setting, all runs scored in one aggregate."""
    out = None
    for value, train, valid in runs:
        for side, frame in (("train", train), ("validation", valid)):
            part = frame.select(F.lit(value).alias(label), F.lit(side).alias("side"), FOLD, ((F.col("y") - F.col("p")) ** 2).alias("e"))
            out = part if out is None else out.unionByName(part)
    folds = out.groupBy(label, "side", FOLD).agg(F.avg("e").alias("mse"))
    table = folds.groupBy(label).pivot("side", ["train", "validation"]).agg(F.avg("mse").alias("mse"), F.stddev_pop("mse").alias("std"))
    return table.orderBy(label)


def _scored(model, rows: DataFrame, target: str, fold: int) -> DataFrame:
    s = predict(model, rows)
    return s.select(F.lit(fold).alias(FOLD), num(s, target).alias("y"), F.col("prediction").cast("double").alias("p"))


def learning_curve(
    df, features, target, name, key: str, params=None, sizes: Sequence[float] | None = None, cv: int = 5, seed: int = 42
) -> DataFrame:
    """MSE at growing training sizes; a smaller sample is a hash prefix of the larger one."""
    sizes = list(sizes) if sizes is not None else [round(0.1 + 0.1 * i, 2) for i in range(10)]
    folded = with_folds(df, key, cv, seed)
    runs = []
    for share in sizes:
        for f in range(cv):
            train = folded.where(F.col(FOLD) != f)
            if share < 1.0:
                train = train.where(hash_unit(key, f"{seed}sample") < F.lit(share))
            model = fit_model(train, features, target, name, params, "regression", key)
            runs.append((share, _scored(model, train, target, f), _scored(model, folded.where(F.col(FOLD) == f), target, f)))
    return _curve(runs, "train_share")


def validation_curve(
    df, features, target, name, key: str, param: str, values: Sequence, params=None, cv: int = 5, seed: int = 42
) -> DataFrame:
    """MSE over the values of one parameter."""
    folded = with_folds(df, key, cv, seed)
    runs = []
    for v in values:
        for f in range(cv):
            train = folded.where(F.col(FOLD) != f)
            model = fit_model(train, features, target, name, {**(params or {}), param: v}, "regression", key)
            runs.append((v, _scored(model, train, target, f), _scored(model, folded.where(F.col(FOLD) == f), target, f)))
    return _curve(runs, param)


def bootstrap(df: DataFrame, key: str, seed: object) -> DataFrame:
    """Rows repeated a Poisson(1) number of times drawn from the hash: a bootstrap with no shuffle."""
    times = poisson_times(hash_unit(key, seed))
    return df.withColumn("__copy", F.explode(F.sequence(F.lit(0), times))).where(F.col("__copy") > 0).drop("__copy")


def bias_variance(
    df, features, target, name, key: str, params=None, n_iterations: int = 100, test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Squared bias, variance and their sum over bootstrap fits, on one fixed test set."""
    train, test = parts(split_random(df, key, test_size, seed))
    out = None
    for b in range(n_iterations):
        model = fit_model(bootstrap(train, key, f"{seed}boot{b}"), features, target, name, params, "regression", key)
        s = predict(model, test)
        s = s.select(col(key).alias("id"), num(s, target).alias("y"), F.col("prediction").cast("double").alias("p"))
        out = s if out is None else out.unionByName(s)
    rows = out.groupBy("id").agg(F.first("y").alias("y"), F.avg("p").alias("m"), F.var_pop("p").alias("v"))
    return rows.agg(
        F.avg((F.col("y") - F.col("m")) ** 2).alias("bias"),
        F.avg("v").alias("variance"),
        (F.avg((F.col("y") - F.col("m")) ** 2) + F.avg("v")).alias("total_error"),
    )


def model_compare(
    train: DataFrame, test: DataFrame, features, target, models: Mapping[str, Mapping[str, Any] | None], key: str | None = None
) -> DataFrame:
    """Train every model, score it on the test rows, best R2 first; a failure stays as a row."""
    rows = []
    for name, params in models.items():
        try:
            s = predict(fit_model(train, features, target, name, params, "regression", key), test)
            aggs = regression_aggregates(num(s, target), F.col("prediction"))
            r = s.agg(*[aggs[m].alias(m) for m in ("r2", "mse", "rmse", "mae", "explained_variance")]).collect()[0]
            rows.append((name, *r, None))
        except Exception as e:  # one model's failure must not stop the comparison
            rows.append((name, None, None, None, None, None, f"{type(e).__name__}: {e}"[:500]))
    rows.sort(key=lambda r: (r[1] is None, -(r[1] or 0.0)))
    return local_rows(
        train.sparkSession,
        rows,
        "model string, r2 double, mse double, rmse double, mae double, explained_variance double, error string",
    )


def permutation_importance(model, df: DataFrame, features, target: str, key: str, n_repeats: int = 10, seed: int = 42) -> DataFrame:
    """Mean loss of R2 when one feature is shuffled.

    A shuffle gives every row the value of the row before it in a random (hash) order, so one ordered
    pass per repeat serves all features, and the original and every shuffled copy are scored together.
    """
    from .ordered import lagged

    slim = df.select(col(key).alias("__key"), *[num(df, f).alias(f) for f in features], num(df, target).alias("__y"))
    out = None
    for r in range(n_repeats):
        shuffled = slim.withColumn("__h", hash_hex("__key", f"{seed}shuffle{r}")).withColumn(
            "__all", F.struct(*[col(f) for f in features])
        )
        stepped = lagged(shuffled, [F.col("__h"), F.col("__key")], [1], "__all")
        # the first row of the order takes the values of the last
        last = shuffled.orderBy(F.desc("__h"), F.desc("__key")).limit(1).select("__all").collect()[0][0]
        wrap = F.struct(*[F.lit(last[f]).alias(f) for f in features])
        partner = F.coalesce(F.col("__all_lag1"), wrap)
        copies = F.explode(
            F.array(
                F.struct(F.lit("").alias("feature"), *[col(f).alias(f"v{i}") for i, f in enumerate(features)]),
                *[
                    F.struct(F.lit(g).alias("feature"), *[(partner[f] if f == g else col(f)).alias(f"v{i}") for i, f in enumerate(features)])
                    for g in features
                ],
            )
        ).alias("c")
        rows = stepped.select("__y", copies).select(
            "__y", F.lit(r).alias("repeat"), "c.feature", *[F.col(f"c.v{i}").alias(f) for i, f in enumerate(features)]
        )
        out = rows if out is None else out.unionByName(rows)
    scored = predict(model, out)
    r2 = regression_aggregates(F.col("__y"), F.col("prediction"))["r2"]
    table = scored.groupBy("repeat", "feature").agg(r2.alias("r2"))
    base = table.where(F.col("feature") == "").select("repeat", F.col("r2").alias("base"))
    drops = table.where(F.col("feature") != "").join(base, "repeat").withColumn("drop", F.col("base") - F.col("r2"))
    return drops.groupBy("feature").agg(F.avg("drop").alias("importance"), F.stddev_pop("drop").alias("std"))

