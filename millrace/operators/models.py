"""Model training on Spark ML behind familiar model and parameter names.

``fit_model`` returns an object whose ``transform`` adds ``prediction`` (and ``score``, the positive
class probability or margin, for binary classifiers).  Everything that is a Spark ML estimator comes
back as a ``PipelineModel``; penalised regressions are solved from cross products; boosting, bagging and
nearest neighbours that Spark ML lacks are small loops over its trees or over the neighbour join.  All of
them can be saved.
"""

from __future__ import annotations

import math
import random
import warnings
from dataclasses import dataclass, field
from typing import Any, Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col, lit_sql, local_rows, num, num_sql
from ..functions.hashing import hash_unit, poisson_times
from ..functions.lineage import bounded, materialise
from ..functions.moments import moments
from . import penalised
from .neighbours import knn_predict
from .scale import scale_standard

VECTOR = "__features"
DEEPEST = 12  # depth of forests and bagged trees for which none is given; Spark grows trees to 30 levels at most
MAX_CLASSES = 10_000  # labels that a vote may be between

# Other names of the same model.
ALIASES = {
    "gradient_boosting": "gbt",
    "xgboost": "gbt",
    "lightgbm": "gbt",
    "catboost": "gbt",
    "svr": "rbf_regression",
    "svc": "linear_svc",
    "decision_tree": "tree",
}

# Parameter names of the source models and the Spark ML parameter each one becomes.
LINEAR_PARAMS = {"fit_intercept": "fitIntercept", "max_iter": "maxIter", "tol": "tol"}
FOREST_PARAMS = {
    "n_estimators": "numTrees",
    "max_depth": "maxDepth",
    "min_samples_leaf": "minInstancesPerNode",
    "min_impurity_decrease": "minInfoGain",
    "max_features": "featureSubsetStrategy",
    "max_samples": "subsamplingRate",
    "bootstrap": "bootstrap",
    "max_bins": "maxBins",
    "random_state": "seed",
}
BOOSTING_PARAMS = {
    "n_estimators": "maxIter",
    "iterations": "maxIter",
    "learning_rate": "stepSize",
    "max_depth": "maxDepth",
    "depth": "maxDepth",
    "subsample": "subsamplingRate",
    "bagging_fraction": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy",
    "feature_fraction": "featureSubsetStrategy",
    "max_features": "featureSubsetStrategy",
    "min_child_weight": "minInstancesPerNode",
    "min_samples_leaf": "minInstancesPerNode",
    "gamma": "minInfoGain",
    "min_impurity_decrease": "minInfoGain",
    "loss": "lossType",
    "max_bins": "maxBins",
    "random_state": "seed",
}
TREE_PARAMS = {k: v for k, v in FOREST_PARAMS.items() if v in ("maxDepth", "minInstancesPerNode", "minInfoGain", "maxBins", "seed")}

HELD = "__held"
REGRESSORS = ("linear", "ridge", "lasso", "elastic_net", "random_forest", "gbt", "adaboost", "bagging", "knn", "rbf_regression", "tree")
CLASSIFIERS = ("logistic", "random_forest", "gbt", "adaboost", "bagging", "linear_svc", "tree")


def canonical(name: str) -> str:
    return ALIASES.get(name, name)


def drop_unset(params: Mapping[str, Any] | None) -> dict[str, Any]:
    """Parameters without None values and mode settings."""
    return {k: v for k, v in (params or {}).items() if v is not None and not k.startswith("mode.") and k != "use_inf_as_null"}


def spark_params(name: str, params: Mapping[str, Any], task: str) -> dict[str, Any]:
    """Translate parameters; those without a counterpart are left out."""
    name = canonical(name)
    table = {"random_forest": FOREST_PARAMS, "gbt": BOOSTING_PARAMS, "tree": TREE_PARAMS}.get(name, LINEAR_PARAMS)
    out: dict[str, Any] = {}
    for k, v in drop_unset(params).items():
        target = table.get(k)
        if target is None:
            continue
        if target == "featureSubsetStrategy":
            v = {"auto": "all" if task == "regression" else "sqrt"}.get(v, str(v)) if isinstance(v, str) else ("all" if v == 1 else str(v))
        elif target == "lossType":
            v = {"squared_error": "squared", "absolute_error": "absolute"}.get(v)
            if v is None or task != "regression":
                continue
        elif target == "maxDepth":
            v = int(v)
            if v > 30:
                warnings.warn(f"Spark grows trees to at most 30 levels, {v} were asked for", stacklevel=2)
                v = 30
        elif target in ("minInstancesPerNode", "maxIter", "numTrees", "maxBins"):
            v = max(1, int(v))
        elif target == "subsamplingRate":
            v = float(v)
        out[target] = v
    if name == "random_forest" and "maxDepth" not in out:
        out["maxDepth"] = DEEPEST
    return out


def native_estimator(name: str, params: Mapping[str, Any] | None = None, task: str = "regression", target: str = "target", classes: int = 2, n: int | None = None, sd: float | None = None):
    """The Spark ML estimator of a model that has one, with translated parameters.

    The penalised regressions convert the penalty weight so that the minimised objective is the
    textbook one; ridge and elastic net need the row count and the target's sample deviation for it.
    """
    name, given = canonical(name), drop_unset(params)
    common = {"featuresCol": VECTOR, "labelCol": target}
    set_ = spark_params(name, given, task)
    if task == "regression":
        if name == "linear":
            return LinearRegression(**common, **set_)
        if name in ("ridge", "lasso", "elastic_net"):
            alpha = float(given.get("alpha", 1.0))
            if name == "lasso":
                reg, mix = alpha, 1.0
            elif name == "ridge":
                reg, mix = alpha / n * sd, 0.0
            else:
                l1 = float(given.get("l1_ratio", 0.5))
                reg = alpha * (l1 + (1.0 - l1) * sd)
                mix = alpha * l1 / reg if reg else 0.0
            set_ = {"maxIter": 1000, "tol": 1e-9, **{k: v for k, v in set_.items() if k != "tol"}}
            return LinearRegression(**common, regParam=reg, elasticNetParam=mix, standardization=False, solver="l-bfgs", **set_)
        if name == "random_forest":
            return RandomForestRegressor(**common, **{"seed": 42, **set_})
        if name == "gbt":
            return GBTRegressor(**common, **{"seed": 42, **set_})
        if name == "tree":
            return DecisionTreeRegressor(**common, **{"seed": 42, **set_})
    else:
        if name == "logistic":
            penalty = given.get("penalty", "l2")
            reg = 0.0 if penalty in ("none", None) else 1.0 / (float(given.get("C", 1.0)) * (n or 1))
            mix = {"l1": 1.0, "elasticnet": float(given.get("l1_ratio", 0.5))}.get(penalty, 0.0)
            return LogisticRegression(**common, regParam=reg, elasticNetParam=mix, standardization=False, **{"maxIter": 200, **set_})
        if name == "random_forest":
            return RandomForestClassifier(**common, **{"seed": 42, **set_})
        if name == "gbt":
            boost = GBTClassifier(**common, **{"seed": 42, **set_})
            return boost if classes <= 2 else OneVsRest(classifier=boost, **common)
        if name == "linear_svc":
            margin = LinearSVC(**common, regParam=1.0 / (float(given.get("C", 1.0)) * (n or 1)), **{"maxIter": 200, **set_})
            return margin if classes <= 2 else OneVsRest(classifier=margin, **common)
        if name == "tree":
            return DecisionTreeClassifier(**common, **{"seed": 42, **set_})
    return None


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR)


def with_score(df: DataFrame) -> DataFrame:
    """Add ``score`` from the class probability or, for a margin classifier, from the raw value."""
    if "probability" in df.columns:
        return df.withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    if "rawPrediction" in df.columns:
        return df.withColumn("score", F.get(vector_to_array("rawPrediction"), F.lit(1)))
    return df


@dataclass
class AveragedTrees:
    """Bagged or boosted trees: each tree predicts a column and the columns are combined."""

    features: list[str]
    trees: list[Any]
    slices: list[list[int] | None]
    weights: list[float]
    combine: str
    classes: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        keep = df.columns
        out = assembler(self.features).transform(df)
        for i, (tree, cut) in enumerate(zip(self.trees, self.slices)):
            vector = VECTOR
            if cut is not None:
                vector = f"__cut{i}"
                out = VectorSlicer(inputCol=VECTOR, outputCol=vector, indices=cut).transform(out)
            probe = tree.copy({tree.getParam("predictionCol"): f"__p{i}", tree.getParam("featuresCol"): vector})
            if hasattr(tree, "numClasses"):
                probe = probe.copy({tree.getParam("rawPredictionCol"): "", tree.getParam("probabilityCol"): ""})
            out = probe.transform(out)
        preds = [F.col(f"__p{i}") for i in range(len(self.trees))]
        picks = [self._combined(preds).alias("prediction")]
        if self.combine == "vote" and len(self.classes) == 2:
            picks.append((self._votes(preds, self.classes[1]) / F.lit(sum(self.weights))).alias("score"))
        return out.select(*[col(c) for c in keep], *picks)

    def _votes(self, preds: list[Column], k: float) -> Column:
        return sum((F.when(p == k, F.lit(w)).otherwise(F.lit(0.0)) for p, w in zip(preds, self.weights)), F.lit(0.0))

    def _combined(self, preds: list[Column]) -> Column:
        if self.combine == "mean":
            return sum(preds, F.lit(0.0)) / F.lit(float(len(preds)))
        if self.combine == "vote":
            ballots = F.array(*[F.struct(self._votes(preds, k).alias("v"), F.lit(-k).alias("k")) for k in self.classes])
            return -F.array_max(ballots)["k"]
        # weighted median: the first prediction, in order, at which half of the weight is reached
        half = F.lit(0.5 * sum(self.weights))
        pairs = F.array_sort(F.array(*[F.struct(p.alias("p"), F.lit(w).alias("w")) for p, w in zip(preds, self.weights)]))
        start = F.struct(F.lit(0.0).alias("cum"), F.lit(None).cast("double").alias("pick"))
        walked = F.aggregate(
            pairs,
            start,
            lambda a, e: F.struct(
                (a["cum"] + e["w"]).alias("cum"),
                F.coalesce(a["pick"], F.when(a["cum"] + e["w"] >= half, e["p"])).alias("pick"),
            ),
        )
        return walked["pick"]


def _adaboost_reg(df: DataFrame, features: Sequence[str], target: str, p: Mapping[str, Any]) -> AveragedTrees:
    """AdaBoost.R2: reweight rows by their loss relative to the largest one."""
    rounds, rate, loss = int(p.get("n_estimators", 50)), float(p.get("learning_rate", 1.0)), p.get("loss", "linear")
    base = assembler(features).transform(df).select(VECTOR, num(df, target).alias("y"))
    n = base.count()
    state = materialise(bounded(base).withColumn("w", F.lit(1.0 / n)))
    trees, weights = [], []
    for i in range(rounds):
        tree = DecisionTreeRegressor(
            featuresCol=VECTOR, labelCol="y", weightCol="w", maxDepth=int(p.get("max_depth", 3)), maxBins=int(p.get("max_bins", 32)), seed=int(p.get("random_state") or 42) + i
        ).fit(state)
        scored = tree.transform(state).withColumn("e", F.abs(F.col("y") - F.col("prediction")))
        top = scored.agg(F.max("e")).collect()[0][0]
        if not top:
            trees, weights = trees + [tree], weights + [1.0]
            break
        e = F.col("e") / F.lit(top)
        e = {"linear": e, "square": e * e, "exponential": 1.0 - F.exp(-e)}[loss]
        mean = scored.agg((F.sum(F.col("w") * e) / F.sum("w")).alias("m")).collect()[0]["m"]
        if mean >= 0.5:
            if not trees:
                trees, weights = [tree], [1.0]
            break
        beta = mean / (1.0 - mean)
        trees.append(tree)
        weights.append(rate * math.log(1.0 / beta) if beta > 0 else 1.0)
        raised = F.col("w") * F.pow(F.lit(beta), (1.0 - e) * rate)
        total = scored.agg(F.sum(raised)).collect()[0][0]
        # each round reads the rows the previous one wrote, so plans do not grow with the rounds
        state = materialise(scored.select(VECTOR, "y", (raised / F.lit(total)).alias("w")))
    return AveragedTrees(list(features), trees, [None] * len(trees), weights, "median")


def _classes(rows: DataFrame) -> list[float]:
    """All labels ``y``, sorted; more than MAX_CLASSES are refused, none is left out."""
    found = sorted(r["y"] for r in rows.select("y").distinct().limit(MAX_CLASSES + 1).collect())
    if len(found) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    return found


def _copies(rows: DataFrame, seed: int, share: float, replace: bool) -> DataFrame:
    """A row sample that depends on the rows alone, not on how they are partitioned.

    With replacement every row is repeated a Poisson(share) number of times drawn from its hash.
    Equal rows are drawn apart by their number among their equals.
    """
    twin = F.row_number().over(Window.partitionBy("__hash").orderBy("y"))
    rows = rows.withColumn("__hash", F.xxhash64(F.hash(vector_to_array(VECTOR)), vector_to_array(VECTOR), F.col("y")))
    u = hash_unit(F.concat_ws(":", F.col("__hash").cast("string"), twin.cast("string")), seed)
    drawn = rows.withColumn("__u", u).drop("__hash")
    if not replace:
        return drawn.where(F.col("__u") < share).drop("__u")
    times = poisson_times(F.col("__u"), share)
    return drawn.withColumn("__copy", F.explode(F.sequence(F.lit(0), times))).where("__copy > 0").drop("__copy", "__u")


def _adaboost_cls(df: DataFrame, features: Sequence[str], target: str, p: Mapping[str, Any]) -> AveragedTrees:
    """SAMME: misclassified rows gain weight, each tree votes with its log odds."""
    rounds, rate = int(p.get("n_estimators", 50)), float(p.get("learning_rate", 1.0))
    base = assembler(features).transform(df).select(VECTOR, num(df, target).alias("y"))
    classes = _classes(base)
    state = materialise(bounded(base).withColumn("w", F.lit(1.0 / base.count())))
    trees, weights = [], []
    for i in range(rounds):
        tree = DecisionTreeClassifier(
            featuresCol=VECTOR, labelCol="y", weightCol="w", maxDepth=int(p.get("max_depth", 1)), maxBins=int(p.get("max_bins", 32)), seed=int(p.get("random_state") or 42) + i
        ).fit(state)
        miss = (F.col("prediction") != F.col("y")).cast("double")
        scored = tree.transform(state)
        err = scored.agg((F.sum(F.col("w") * miss) / F.sum("w")).alias("m")).collect()[0]["m"]
        if err <= 0:
            trees, weights = trees + [tree], weights + [1.0]
            break
        if err >= 1.0 - 1.0 / len(classes):
            if not trees:
                trees, weights = [tree], [1.0]
            break
        alpha = rate * (math.log((1.0 - err) / err) + math.log(len(classes) - 1.0))
        trees.append(tree)
        weights.append(alpha)
        raised = F.col("w") * F.exp(F.lit(alpha) * miss)
        total = scored.agg(F.sum(raised)).collect()[0][0]
        state = materialise(scored.select(VECTOR, "y", (raised / F.lit(total)).alias("w")))
    return AveragedTrees(list(features), trees, [None] * len(trees), weights, "vote", classes)


def _bagging(df: DataFrame, features: Sequence[str], target: str, p: Mapping[str, Any], task: str) -> AveragedTrees:
    """Independent trees on row samples, each on its own subset of the features."""
    count, share, width = int(p.get("n_estimators", 10)), float(p.get("max_samples", 1.0)), float(p.get("max_features", 1.0))
    seed = int(p.get("random_state") or 42)
    rng = random.Random(seed)
    base = materialise(bounded(assembler(features).transform(df).select(VECTOR, num(df, target).alias("y"))))
    classes = _classes(base) if task != "regression" else []
    take = max(1, round(width * len(features)))
    trees, slices = [], []
    for i in range(count):
        cut = None
        rows = base
        if p.get("bootstrap", True):
            rows = _copies(rows, seed + i, share, True)
        elif share < 1.0:
            rows = _copies(rows, seed + i, share, False)
        vector = VECTOR
        if take < len(features) or p.get("bootstrap_features"):
            pool = range(len(features))
            # a repeated feature adds nothing to a tree, so a bootstrap of features is its distinct set
            cut = sorted(set(rng.choices(pool, k=take)) if p.get("bootstrap_features") else rng.sample(pool, take))
            vector = "__cut"
            rows = VectorSlicer(inputCol=VECTOR, outputCol=vector, indices=cut).transform(rows)
        kind = DecisionTreeRegressor if task == "regression" else DecisionTreeClassifier
        depth = int(p.get("max_depth", DEEPEST))
        trees.append(kind(featuresCol=vector, labelCol="y", maxDepth=depth, maxBins=int(p.get("max_bins", 32)), seed=seed + i).fit(rows))
        slices.append(cut)
    return AveragedTrees(list(features), trees, slices, [1.0] * count, "mean" if task == "regression" else "vote", classes)


@dataclass
class NeighbourModel:
    """Nearest-neighbour regression; the training rows are the model."""

    train: DataFrame
    key: str
    features: list[str]
    target: str
    params: dict[str, Any]

    def transform(self, df: DataFrame) -> DataFrame:
        p = self.params
        if p.get("metric") == "manhattan":
            power = 1.0
        elif p.get("metric") == "euclidean":
            power = 2.0
        else:
            power = float(p.get("p", 2))
        found = knn_predict(
            self.train, df, self.key, self.key, self.features, self.target, int(p.get("n_neighbors", 5)),
            p.get("weights", "uniform"), power, mode=p.get("mode", "exact"),
        )
        return df.join(found, self.key, "left")


def fourier_stage(df: DataFrame, features: Sequence[str], gamma: float | str = "scale", width: int = 64, seed: int = 42) -> tuple[SQLTransformer, list[str]]:
    """Random Fourier features of the standardised inputs, as SQL columns approximating an RBF kernel."""
    stats = moments(df, features, ["mean", "std_pop"])
    used = [c for c in features if stats[c]["std_pop"]]
    g = 1.0 / max(len(used), 1) if gamma in ("scale", "auto") else float(gamma)
    rng = random.Random(seed)
    names, picks = [], []
    for i in range(width):
        parts = []
        for c in used:
            w = rng.gauss(0.0, math.sqrt(2.0 * g))
            parts.append(f"{lit_sql(w / stats[c]['std_pop'])} * ({num_sql(df, c)} - {lit_sql(stats[c]['mean'])})")
        names.append(f"__rff{i}")
        phase = rng.uniform(0.0, 2.0 * math.pi)
        picks.append(f"{lit_sql(math.sqrt(2.0 / width))} * cos({' + '.join(parts) or '0D'} + {lit_sql(phase)}) AS `__rff{i}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(picks)} FROM __THIS__"), names


def fit_model(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    name: str,
    params: Mapping[str, Any] | None = None,
    task: str = "regression",
    key: str | None = None,
):
    """Train a model by name.  Nearest neighbours need ``key``, the unique row id."""
    name, p = canonical(name), drop_unset(params)
    if name not in (REGRESSORS if task == "regression" else CLASSIFIERS):
        raise ValueError(f"unknown {task} model {name!r}")
    if name == "knn":
        if key is None:
            raise ValueError("knn needs the key column")
        return NeighbourModel(df, key, list(features), target, p)
    if name == "adaboost":
        return (_adaboost_reg if task == "regression" else _adaboost_cls)(df, features, target, p)
    if name == "bagging":
        return _bagging(df, features, target, p, task)
    if name == "rbf_regression":
        stage, names = fourier_stage(df, features, p.get("gamma", "scale"), int(p.get("width", 64)))
        n = df.count()
        huber = LinearRegression(
            featuresCol=VECTOR, labelCol=target, loss="huber", regParam=1.0 / (float(p.get("C", 1.0)) * n), maxIter=int(p.get("max_iter", 200)) if int(p.get("max_iter", 200)) > 0 else 200
        )
        return Pipeline(stages=[stage, assembler(names), huber]).fit(df)
    if name in penalised.PENALISED:
        return penalised.fit(df, features, target, name, p)
    n = sd = None
    classes = 2
    if name in ("logistic", "linear_svc"):
        row = df.agg(F.count(num(df, target)).alias("n"), F.stddev_samp(num(df, target)).alias("sd")).collect()[0]
        n, sd = row["n"], row["sd"]
    if task != "regression" and name in ("gbt", "linear_svc"):
        classes = df.select(target).distinct().limit(3).count()
    est = native_estimator(name, p, task, target, classes, n, sd)
    if isinstance(est, (GBTRegressor, GBTClassifier)) and (p.get("n_iter_no_change") or p.get("early_stopping_rounds")):
        df = df.withColumn(HELD, _held(df, features, target, float(p.get("validation_fraction", 0.1))))
        est.setParams(validationIndicatorCol=HELD, validationTol=float(p.get("tol", 1e-4)))
    if name in ("random_forest", "gbt", "tree"):
        # trees read nothing else, so nothing else is dealt
        df = bounded(df.select(*[col(c) for c in dict.fromkeys([*features, target, *([HELD] if HELD in df.columns else [])])]))
    return Pipeline(stages=[assembler(features), est]).fit(df)


def _held(df: DataFrame, features: Sequence[str], target: str, fraction: float):
    """Marks rows that boosting watches instead of learning from, by a hash of their values: the same in
    every layout, with equal rows on one side.  Boosting ends when their error falls by less than ``tol``."""
    draw = F.pmod(F.xxhash64(F.lit(42), *[col(c) for c in (*features, target)]), F.lit(1 << 30))
    return draw < F.lit(int(fraction * (1 << 30)))


def predict(model, df: DataFrame) -> DataFrame:
    """Rows with ``prediction`` and, for classifiers, ``score``; helper columns are removed."""
    out = with_score(model.transform(df))
    keep = [*df.columns, "prediction"] + (["score"] if "score" in out.columns else [])
    return out.select(*[col(c) for c in keep])


def cluster_labels(df: DataFrame, features: Sequence[str], k: int, seed: int, output: str) -> DataFrame:
    """k-means cluster of the standardised features."""
    scaled = scale_standard(df, features)
    renamed = {f"__z{i}": scaled.exprs[c] for i, c in enumerate(features) if c in scaled.exprs}
    wide = df.withColumns({n: F.expr(e) for n, e in renamed.items()})
    stages = [assembler(list(renamed)), KMeans(featuresCol=VECTOR, predictionCol=output, k=k, seed=seed)]
    return Pipeline(stages=stages).fit(wide).transform(wide).drop(VECTOR, *renamed)


def inner_model(model):
    if isinstance(model, PipelineModel):
        return model.stages[-1]
    return inner_model(model.model) if hasattr(model, "chain") else model


def importances(model, features: Sequence[str]) -> list[tuple[str, float]]:
    """Feature importances (trees) or coefficient magnitudes (linear models)."""
    last = inner_model(model)
    if isinstance(last, AveragedTrees):
        total = [0.0] * len(features)
        for tree, cut, w in zip(last.trees, last.slices, last.weights):
            for i, v in enumerate(tree.featureImportances.toArray()):
                total[cut[i] if cut else i] += w * float(v)
        s = sum(total) or 1.0
        return [(f, v / s) for f, v in zip(features, total)]
    if hasattr(last, "featureImportances"):
        return [(f, float(v)) for f, v in zip(features, last.featureImportances.toArray())]
    if hasattr(last, "coefficients"):
        return [(f, abs(float(v))) for f, v in zip(features, last.coefficients.toArray())]
    raise ValueError("the model has no importances")


def feature_importance(model, features: Sequence[str], spark, top: int | None = None) -> DataFrame:
    rows = sorted(importances(model, features), key=lambda r: (-r[1], r[0]))
    return local_rows(spark, rows[:top] if top else rows, "feature string, importance double")


def coefficients(model, features: Sequence[str], spark) -> DataFrame:
    last = inner_model(model)
    rows = [("(intercept)", float(last.intercept))] + [(f, float(v)) for f, v in zip(features, last.coefficients.toArray())]
    return local_rows(spark, rows, "term string, coefficient double")


def save_model(model, path: str) -> None:
    """Write any fitted model, with the steps before it if it is chained; see :mod:`.persist`."""
    from .persist import save

    save(model, path)


def load_model(path: str):
    from .persist import load

    return load(path)
