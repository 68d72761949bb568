"""Whole runs: exploration, preprocessing, feature work, regression, classification, saved models.

Everything data-dependent is fitted on the training rows and applied to both sides, and the fitted
preprocessing is saved inside the model.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, columns_of, local_rows, num
from ..functions.lineage import materialise, spread_out
from ..functions.steps import ColumnStep
from ..operators import clean, convert, encode, engineer, evaluate, explore, models, resample, scale, tuning
from ..operators.neighbours import NeighbourFill
from ..operators.persist import Chain, ChainedModel
from ..operators.select import Selection, kbest, select_features
from ..operators.split import parts, split_random
from ..sources.sinks import results_table


# ---------------------------------------------------------------- exploration


def run_eda(df: DataFrame) -> dict[str, DataFrame]:
    """Profile of all columns and all numeric pairs."""
    numeric = columns_of(df, "numeric")
    texts = columns_of(df, "string")
    out = {"univariate": explore.univariate_numeric(df, numeric), "missing": clean.missing_info(df)}
    if texts:
        out["categorical"] = explore.univariate_categorical(df, texts)
    if len(numeric) > 1:
        out["pairs"] = explore.corr_pairs(df, numeric)
    return out


# ---------------------------------------------------------------- preprocessing


@dataclass
class Preprocessor:
    """Infinity handling, imputation, optional label encoding, and scaling, fitted on one table."""

    chain: Chain
    imputation: ColumnStep
    scaler: ColumnStep

    def transform(self, df: DataFrame) -> DataFrame:
        return self.chain.transform(df)

    def feature_names(self, df: DataFrame) -> list[str]:
        return self.transform(df).columns

    def scalers(self) -> dict[str, dict]:
        return dict(self.scaler.state)


def fit_preprocessor(
    df: DataFrame,
    strategy: str | Mapping[str, str] = "auto",
    scaling: str = "standard",
    target_range: tuple[float, float] = (-1.0, 1.0),
    exclude: Sequence[str] = (),
    inf_as_null: bool = False,
    encode_labels: bool = False,
    custom_values: Mapping[str, Any] | None = None,
) -> Preprocessor:
    """``exclude`` names columns (key, target) that are neither encoded nor scaled."""
    chain = Chain()
    if inf_as_null:
        df = chain.add(df, convert.replace_inf(df))
    columns = [c for c in df.columns if c not in exclude]
    imputation = clean.impute(df, strategy, custom_values, columns)
    df = chain.add(df, imputation)
    if encode_labels:
        for step in encode.label_steps(df, [c for c in columns_of(df, "string") if c in columns]):
            df = chain.add(df, step)
    numeric = [c for c in columns_of(df, "numeric") if c in columns]
    if scaling == "standard":
        scaler = scale.scale_standard(df, numeric)
    elif scaling == "minmax":
        scaler = scale.scale_minmax(df, numeric, target_range)
    elif scaling == "robust":
        scaler = scale.scale_robust(df, numeric)
    elif scaling in ("none", None):
        scaler = ColumnStep()
    else:
        raise ValueError(f"unknown scaling {scaling!r}")
    chain.add(df, scaler)
    return Preprocessor(chain, imputation, scaler)


def fit_features(df: DataFrame, config: Mapping[str, Any], exclude: Sequence[str] = ()) -> Chain:
    """Derived features, interactions, components and polynomials of the first two numeric columns."""
    chain = Chain()

    def on(section: str) -> Mapping[str, Any] | None:
        part = config.get(section)
        return part if part and part.get("enable", True) else None

    if on("derived_features"):
        df = chain.add(df, engineer.derive(df, config["derived_features"].get("operations", [])))
    if on("interactions"):
        part = config["interactions"]
        df = chain.add(df, engineer.interact(df, part.get("feature_pairs", []), part.get("interaction_type", "multiplication")))
    base = [c for c in columns_of(df, "numeric") if c not in exclude]
    if on("pca"):
        part = config["pca"]
        comps = engineer.pca(df, part.get("columns", base), part.get("n_components"), part.get("variance_ratio", 0.95))
        df = chain.add(df, comps.step)
    if on("polynomial"):
        part = config["polynomial"]
        df = chain.add(df, engineer.polynomial(df, part.get("columns", base[:2]), part.get("degree", 2), part.get("interaction_only", False)))
    return chain


# ---------------------------------------------------------------- regression


@dataclass
class Run:
    model: Any
    predictions: DataFrame
    results: DataFrame
    selection: Selection | None
    best_params: dict[str, Any]
    evaluation: DataFrame | None = None


def _metrics(scored: DataFrame, target: str) -> dict[str, float]:
    aggs = evaluate.regression_aggregates(num(scored, target), F.col("prediction"))
    return scored.agg(*[aggs[m].alias(m) for m in ("r2", "mse", "mae", "explained_variance")]).collect()[0].asDict()


def regression_run(
    df: DataFrame,
    target: str,
    key: str,
    model: str = "linear",
    params: Mapping[str, Any] | None = None,
    grid: Mapping[str, Sequence] | None = None,
    tune: str | None = None,
    selection: str | None = None,
    selection_params: Mapping[str, Any] | None = None,
    features: Mapping[str, Any] | None = None,
    strategy: str | Mapping[str, str] = "auto",
    scaling: str = "standard",
    test_size: float = 0.2,
    cv: int = 5,
    n_iter: int = 20,
    seed: int = 42,
    run_id: str = "run",
    full_evaluation: bool = False,
) -> Run:
    """Split, preprocess, engineer, select, tune, train and evaluate one model."""
    # every fitting step below reads these rows again; a lost executor recomputes only its share
    df = spread_out(clean.drop_null_target(df, target)).persist()
    train, test = parts(split_random(df, key, test_size, seed))
    prep = fit_preprocessor(train, strategy, scaling, exclude=[target, key], encode_labels=True)
    chain = Chain(list(prep.chain.steps))
    ready = chain.transform(train)
    if features:
        extra = fit_features(ready, features, exclude=[target, key])
        chain.steps += extra.steps
        ready = extra.transform(ready)
    names = [c for c in columns_of(ready, "numeric", "boolean") if c not in (target, key)]
    chosen = None
    if selection:
        chosen = select_features(ready, target, selection, key, **{"features": names, **(selection_params or {})})
        names = chosen.selected
    ready = ready.select(col(key), *[col(c) for c in names], col(target))
    best = dict(params or {})
    if tune == "grid":
        best.update(tuning.grid_search(ready, names, target, model, grid, cv=cv, key=key, seed=seed, refit=False).best_params)
    elif tune == "random":
        best.update(tuning.random_search(ready, names, target, model, grid, n_iter, seed, cv=cv, key=key, refit=False).best_params)
    elif tune not in (None, "none"):
        raise ValueError("tune must be grid, random or none")
    fitted = models.fit_model(ready, names, target, model, best, "regression", key)
    held = chain.transform(test).select(col(key), *[col(c) for c in names], col(target))
    scored = models.predict(fitted, held)
    sides = {"train": _metrics(models.predict(fitted, ready), target), "test": _metrics(scored, target), "params": best}
    results = results_table(df.sparkSession, run_id, {model: sides})
    one = isinstance(fitted, PipelineModel) and chain.is_pipeline()
    whole = PipelineModel(chain.stages() + fitted.stages) if one else ChainedModel(chain, fitted)
    report = evaluate.complete_evaluation(scored, target, "prediction", key, names) if full_evaluation else None
    df.unpersist()
    return Run(whole, scored, results, chosen, best, report)


def compare_run(df: DataFrame, target: str, key: str, candidates: Mapping[str, Mapping[str, Any] | None], test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Train every candidate on one prepared split, best R2 first; only finite metrics stay."""
    train, test = parts(split_random(clean.drop_null_target(df, target), key, test_size, seed))
    prep = fit_preprocessor(train, exclude=[target, key], encode_labels=True)
    ready, held = prep.transform(train), prep.transform(test)
    names = [c for c in columns_of(ready, "numeric", "boolean") if c not in (target, key)]
    table = tuning.model_compare(ready, held, names, target, candidates, key)
    return table.where(F.col("r2").isNotNull() & ~F.isnan("r2"))


# ---------------------------------------------------------------- classification

RESAMPLERS = {
    "smote": lambda d, k, f, y, seed: resample.append_synthetic(d, resample.smote(d, k, f, y, seed=seed), k, f, y),
    "smote_tomek": lambda d, k, f, y, seed: resample.smote_tomek(d, k, f, y, seed=seed),
    "random_under": lambda d, k, f, y, seed: resample.undersample(d, k, y, seed),
}


def _rebalance(df: DataFrame, method: str | None, key: str, features: Sequence[str], label: str, seed: int) -> DataFrame:
    if method is None:
        return df
    if method == "adasyn":
        sizes = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
        rare = min(sizes, key=sizes.get)
        made = resample.adasyn(df, key, features, label, rare, seed=seed)
        return resample.append_synthetic(df, made, key, features, label)
    return RESAMPLERS[method](df, key, features, label, seed)


def classification_run(
    df: DataFrame,
    target: str,
    key: str,
    model: str = "gbt",
    params: Mapping[str, Any] | None = None,
    grid: Mapping[str, Sequence] | None = None,
    scaler: str = "standard",
    imputer: str = "simple",
    encoder: str = "target",
    n_features: int | None = 50,
    pca_components: int | None = None,
    imbalance: str | None = "smote",
    test_size: float = 0.2,
    cv: int = 3,
    seed: int = 42,
) -> tuple[Any, DataFrame, DataFrame]:
    """Dates, imputation, scaling, encoding, selection, components, resampling, tuning and report.

    Returns (model with its preprocessing, scored test rows, report).  Every later stage is fitted on the rows as the earlier
    ones left them, and resampling touches training rows only.
    """
    df = spread_out(df).persist()
    train, test = parts(split_random(df, key, test_size, seed))
    chain = Chain()
    dates = columns_of(train, "datetime", exclude=[key, target])
    if dates:
        train = chain.add(train, engineer.datetime_parts(train, dates, prefix=True, weekend=False))
    numeric = columns_of(train, "numeric", exclude=[key, target])
    texts = columns_of(train, "string", exclude=[key, target])
    flags = columns_of(train, "boolean", exclude=[key, target])
    if flags:
        train = chain.add(train, convert.bool_to_int(train, flags))
    plan = {**{c: "mean" for c in numeric}, **{c: "mode" for c in texts + flags}}
    if imputer == "knn":
        filled = clean.impute(train, {c: "mode" for c in texts + flags}, columns=texts + flags)
        train = chain.add(train, filled)
        train = chain.add(train, NeighbourFill(key, numeric, materialise(train)))
    else:
        train = chain.add(train, clean.impute(train, plan, columns=numeric + texts + flags))
    scalers = {"standard": scale.scale_standard, "robust": scale.scale_robust, "minmax": scale.scale_minmax}
    train = chain.add(train, scalers[scaler](train, numeric))
    for c in texts:
        if encoder == "count":
            made = encode.count_encode(train, c)
        else:
            made = {"target": encode.target_encode, "woe": encode.woe_encode}[encoder](train, c, target)
        train = chain.add(train, made)
    names = columns_of(train, "numeric", exclude=[key, target])
    if n_features and n_features < len(names):
        names = kbest(train, target, n_features, "mutual_info", names).selected
    if pca_components:
        comps = engineer.pca(train, names, pca_components)
        train = chain.add(train, comps.step)
        names = [c for c in train.columns if c.startswith("pca_component_")]
    # search, resampling and training all start from these rows
    slim = materialise(train.select(col(key), *[col(c) for c in names], num(train, target).cast("int").alias(target)))
    best = dict(params or {})
    if grid:
        best.update(
            tuning.grid_search(slim, names, target, model, grid, cv=cv, task="classification", key=key, seed=seed, refit=False).best_params
        )
    fitted = models.fit_model(_rebalance(slim, imbalance, key, names, target, seed), names, target, model, best, "classification", key)
    scored = models.predict(fitted, chain.transform(test).select(col(key), *[col(c) for c in names], col(target)))
    report = classification_summary(scored, target)
    df.unpersist()
    return ChainedModel(chain, fitted), scored, report


def classification_summary(scored: DataFrame, target: str) -> DataFrame:
    labelled = scored.withColumn("__label", num(scored, target))
    report = evaluate.classification_metrics(labelled, "__label", "prediction").collect()[0].asDict()
    if "score" in scored.columns:
        report["roc_auc"] = evaluate.roc_auc(labelled, "__label", "score").collect()[0][0]
    return local_rows(scored.sparkSession, [(k, v) for k, v in report.items()], "metric string, value double")


# ---------------------------------------------------------------- saved models


def evaluate_saved(path: str, df: DataFrame, target: str, order: str | None = None) -> DataFrame:
    """Load a saved run, which carries its preprocessing, and evaluate it on raw rows."""
    scored = models.load_model(path).transform(df)
    return evaluate.complete_evaluation(scored, target, "prediction", order)
