"""Regression and classification metrics and residual diagnostics."""

from __future__ import annotations

import math
from typing import Any, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, correlation, local_rows, num
from ..functions.quantiles import exact_quantiles
from .ordered import lagged, ordered_scan


# ---------------------------------------------------------------- regression


def regression_aggregates(y: Column, p: Column) -> dict[str, Column]:
    """The metric expressions over true and predicted columns, usable in any aggregation."""
    e = y - p
    n = F.count(e).cast("double")
    mse = F.avg(e * e)
    ss = F.var_pop(y)
    r2 = 1.0 - F.try_divide(mse, ss)
    return {
        "n": F.count(e),
        "mse": mse,
        "rmse": F.sqrt(mse),
        "mae": F.avg(F.abs(e)),
        "r2": r2,
        "emse": F.try_divide(n * mse, n - 1.0),
        "adjusted_r2": 1.0 - F.try_divide((1.0 - r2) * (n - 1.0), n - 2.0),
        "explained_variance": 1.0 - F.try_divide(F.var_pop(e), ss),
    }


def _scored(df: DataFrame, y_true: str, y_pred: str, *more: Column) -> DataFrame:
    return df.select(num(df, y_true).alias("y"), num(df, y_pred).alias("p"), *more).where(
        F.col("y").isNotNull() & F.col("p").isNotNull()
    )


def regression_metrics(df: DataFrame, y_true: str, y_pred: str, by: Sequence[str] = ()) -> DataFrame:
    """mse, rmse, mae, r2, emse, adjusted r2 (one parameter) and explained variance in one aggregate."""
    s = _scored(df, y_true, y_pred, *[col(b) for b in by])
    aggs = [c.alias(n) for n, c in regression_aggregates(F.col("y"), F.col("p")).items()]
    return s.groupBy(*[col(b) for b in by]).agg(*aggs) if by else s.agg(*aggs)


# ---------------------------------------------------------------- classification


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(col(label).alias("label"), col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, f1 and support per class, with macro and weighted averages."""
    cells = [(str(r["label"]), str(r["prediction"]), r["n"]) for r in confusion_matrix(df, label, prediction).collect()]
    classes = sorted({c[0] for c in cells} | {c[1] for c in cells})
    rows = []
    for k in classes:
        hit = sum(n for a, b, n in cells if a == k and b == k)
        said = sum(n for a, b, n in cells if b == k)
        support = sum(n for a, b, n in cells if a == k)
        p, r = (hit / said if said else 0.0), (hit / support if support else 0.0)
        rows.append((k, p, r, 2 * p * r / (p + r) if p + r else 0.0, support))
    total = sum(r[4] for r in rows)
    macro = tuple(sum(r[i] for r in rows) / len(rows) for i in (1, 2, 3))
    weighted = tuple(sum(r[i] * r[4] for r in rows) / total for i in (1, 2, 3))
    rows += [("macro avg", *macro, total), ("weighted avg", *weighted, total)]
    return local_rows(
        df.sparkSession, rows, "class string, precision double, recall double, f1 double, support bigint"
    )


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy with support-weighted precision, recall and f1."""
    report = {r["class"]: r for r in classification_report(df, label, prediction).collect()}
    w = report["weighted avg"]
    # weighted recall is the share of rows predicted right
    return local_rows(
        df.sparkSession,
        [(w["recall"], w["precision"], w["recall"], w["f1"])],
        "accuracy double, precision double, recall double, f1 double",
    )


def _score_scan(df: DataFrame, label: str, score: str) -> tuple[DataFrame, float, float]:
    """Distinct scores from high to low with running true and false positives."""
    counts = (
        df.select(num(df, label).alias("y"), num(df, score).alias("score"))
        .where(F.col("y").isNotNull() & F.col("score").isNotNull())
        .groupBy("score")
        .agg(F.sum("y").alias("pos"), F.sum(1.0 - F.col("y")).alias("neg"))
    )
    scan = ordered_scan(counts, [-F.col("score")], {"tp": F.col("pos"), "fp": F.col("neg")})
    totals = scan.agg(F.sum("pos"), F.sum("neg")).collect()[0]
    return scan, totals[0] or 0.0, totals[1] or 0.0


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact, tie-aware area under the ROC curve."""
    scan, pos, neg = _score_scan(df, label, score)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)) / F.lit(pos * neg if pos * neg else None)
    return scan.agg(area.alias("roc_auc"))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """False and true positive rate at every distinct threshold, with the empty start point."""
    scan, pos, neg = _score_scan(df, label, score)
    points = scan.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp"), F.lit(neg)).alias("fpr"),
        F.try_divide(F.col("tp"), F.lit(pos)).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points)


# ---------------------------------------------------------------- residuals


def _order_struct(order: str | Sequence[str]) -> Column:
    return F.struct(*[col(c) for c in ([order] if isinstance(order, str) else order)])


def prediction_correlation(df: DataFrame, y_true: str, y_pred: str, features: Sequence[str] = ()) -> DataFrame:
    """Correlation of truth with prediction, and of each feature with the residual."""
    e = num(df, y_true) - num(df, y_pred)
    row = df.agg(
        correlation(num(df, y_true), num(df, y_pred)).alias("p"),
        *[correlation(num(df, c), e).alias(f"c{i}") for i, c in enumerate(features)],
    ).collect()[0]
    rows = [("prediction", row["p"])] + [(c, row[f"c{i}"]) for i, c in enumerate(features)]
    return local_rows(df.sparkSession, rows, "column string, correlation double")


def breusch_pagan(df: DataFrame, y_true: str, y_pred: str) -> DataFrame:
    """Squared residual regressed on the prediction: LM = n r^2, one aggregate."""
    s = _scored(df, y_true, y_pred)
    e2 = (F.col("y") - F.col("p")) * (F.col("y") - F.col("p"))
    row = s.agg(F.count(F.lit(1)).alias("n"), correlation(e2, F.col("p")).alias("r")).collect()[0]
    lm = row["n"] * row["r"] * row["r"] if row["r"] is not None else 0.0
    p = breusch_pagan_p(lm)
    verdict = "Homoscedastic" if p > 0.05 else "Heteroscedastic"
    return local_rows(df.sparkSession, [(lm, p, verdict)], "statistic double, p_value double, interpretation string")


def breusch_pagan_p(lm: float) -> float:
    return math.erfc(math.sqrt(lm / 2.0))


def durbin_watson(df: DataFrame, y_true: str, y_pred: str, order: str | Sequence[str]) -> DataFrame:
    """Sum of squared steps between residuals over their sum of squares, in the order of one or more columns.

    ``order`` should end in a unique key; rows that it leaves equal follow each other by residual.
    """
    o = _order_struct(order)
    s = _scored(df, y_true, y_pred, o.alias("o")).select("o", (F.col("y") - F.col("p")).alias("e"))
    step = lagged(s, [F.col("o")], [1], "e")
    gap = F.col("e") - F.col("e_lag1")
    stat = F.try_divide(F.sum(gap * gap), F.sum(F.col("e") * F.col("e")))
    verdict = (
        F.when(F.col("statistic") < 1.5, "Positive autocorrelation")
        .when(F.col("statistic") > 2.5, "Negative autocorrelation")
        .otherwise("No significant autocorrelation")
    )
    return step.agg(stat.alias("statistic")).withColumn("interpretation", verdict)


def acf(df: DataFrame, value: str, order: str | Sequence[str], lags: int = 40) -> DataFrame:
    """Autocorrelation at lags 0..``lags``; all lags share one ordered pass.

    ``order`` should end in a unique key; rows that it leaves equal follow each other by value.
    """
    s = df.select(_order_struct(order).alias("o"), num(df, value).alias("e")).where(F.col("e").isNotNull())
    base = s.agg(F.avg("e").alias("m"), F.var_pop("e").alias("v"), F.count(F.lit(1)).alias("n")).collect()[0]
    if not base["n"] or not base["v"]:
        return local_rows(df.sparkSession, [], "lag int, autocorrelation double")
    stepped = lagged(s, [F.col("o")], list(range(1, lags + 1)), "e")
    mean = F.lit(base["m"])
    row = stepped.agg(
        *[F.sum((F.col("e") - mean) * (F.col(f"e_lag{k}") - mean)).alias(f"k{k}") for k in range(1, lags + 1)]
    ).collect()[0]
    total = base["v"] * base["n"]
    rows = [(0, 1.0)] + [(k, (row[f"k{k}"] or 0.0) / total) for k in range(1, lags + 1)]
    return local_rows(df.sparkSession, rows, "lag int, autocorrelation double")


def variance_analysis(df: DataFrame, y_true: str, y_pred: str) -> DataFrame:
    s = _scored(df, y_true, y_pred)
    e = F.col("y") - F.col("p")
    return s.agg(
        F.var_pop("p").alias("prediction_variance"),
        F.var_pop(e).alias("residual_variance"),
        F.var_pop("y").alias("total_variance"),
        (1.0 - F.try_divide(F.var_pop(e), F.var_pop("y"))).alias("explained_variance_ratio"),
    )


PERCENTS = [1, 5, 10, 25, 50, 75, 90, 95, 99]


def percentile_distribution(df: DataFrame, y_true: str, y_pred: str, percents: Sequence[float] = PERCENTS) -> DataFrame:
    """Percentiles of predictions, residuals and true values."""
    s = _scored(df, y_true, y_pred).select(
        F.col("p").alias("predictions"), (F.col("y") - F.col("p")).alias("residuals"), F.col("y").alias("true_values")
    )
    q = exact_quantiles(s, {c: [p / 100.0 for p in percents] for c in s.columns})
    rows = [(c, f"p{p:g}", v) for c in s.columns for p, v in zip(percents, q[c])]
    return local_rows(df.sparkSession, rows, "series string, percentile string, value double")


def residual_outliers(df: DataFrame, y_true: str, y_pred: str, threshold: float = 3.0) -> DataFrame:
    """Rows whose residual lies more than ``threshold`` population deviations from the mean residual."""
    e = num(df, y_true) - num(df, y_pred)
    s = df.agg(F.avg(e).alias("m"), F.stddev_pop(e).alias("s")).collect()[0]
    z = F.try_divide(F.col("residual") - F.lit(s["m"]), F.lit(s["s"]))
    out = df.withColumn("residual", e).withColumn("z", z)
    return out.where(F.abs("z") > F.lit(threshold))


# ---------------------------------------------------------------- everything at once


def complete_evaluation(
    df: DataFrame, y_true: str, y_pred: str, order: str | Sequence[str] | None = None, features: Sequence[str] = ()
) -> DataFrame:
    """One nested row: error metrics, variance, percentiles, correlation and residual tests."""
    spark = df.sparkSession

    def first(frame: DataFrame) -> dict[str, Any]:
        return frame.collect()[0].asDict()

    result: dict[str, Any] = {
        "error_metrics": first(regression_metrics(df, y_true, y_pred)),
        "variance": first(variance_analysis(df, y_true, y_pred)),
    }
    series: dict[str, dict[str, float]] = {}
    for r in percentile_distribution(df, y_true, y_pred).collect():
        series.setdefault(r["series"], {})[r["percentile"]] = r["value"]
    result["percentile_distribution"] = series
    result["correlation"] = {
        r["column"]: r["correlation"] for r in prediction_correlation(df, y_true, y_pred, features).collect()
    }
    result["homoscedasticity"] = first(breusch_pagan(df, y_true, y_pred))
    result["autocorrelation"] = first(durbin_watson(df, y_true, y_pred, order)) if order else None
    doubles = "map<string,double>"
    schema = (
        "error_metrics struct<n:bigint,mse:double,rmse:double,mae:double,r2:double,emse:double,adjusted_r2:double,"
        "explained_variance:double>, variance struct<prediction_variance:double,residual_variance:double,"
        "total_variance:double,explained_variance_ratio:double>, "
        f"percentile_distribution map<string,{doubles}>, correlation {doubles}, "
        "homoscedasticity struct<statistic:double,p_value:double,interpretation:string>, "
        "autocorrelation struct<statistic:double,interpretation:string>"
    )
    row = tuple(result[k] for k in ("error_metrics", "variance", "percentile_distribution", "correlation", "homoscedasticity", "autocorrelation"))
    return local_rows(spark, [row], schema)

