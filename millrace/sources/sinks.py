"""Result tables and where they are written."""

from __future__ import annotations

import json
from typing import Any, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import local_rows

RESULT_SCHEMA = (
    "run_id string, model string, train_r2 double, train_mse double, train_mae double, train_explained_variance double, "
    "test_r2 double, test_mse double, test_mae double, test_explained_variance double, params map<string,string>"
)
METRICS = ("r2", "mse", "mae", "explained_variance")


def results_table(spark: SparkSession, run_id: str, results: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """One row per model: metrics of the train and test sets and the parameters as a map.

    ``results`` is {model: {"train": {...}, "test": {...}, "params": {...}}}.
    """
    rows = []
    for model, r in results.items():
        row = [run_id, model]
        for side in ("train", "test"):
            row += [r.get(side, {}).get(m) for m in METRICS]
        rows.append((*row, {k: str(v) for k, v in (r.get("params") or {}).items()}))
    return local_rows(spark, rows, RESULT_SCHEMA)


def wide_params(results: DataFrame) -> DataFrame:
    """Parameters as ``param_*`` columns, for formats without maps."""
    names = sorted(r[0] for r in results.select(F.explode(F.map_keys("params"))).distinct().collect())
    return results.select(
        *[c for c in results.columns if c != "params"], *[F.col("params")[n].alias(f"param_{n}") for n in names]
    )


def write_results(results: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append the run, partitioned by its id; CSV gets its parameters as columns."""
    if fmt == "csv":
        wide_params(results).write.mode("append").partitionBy("run_id").option("header", True).csv(path)
    else:
        results.write.mode("append").partitionBy("run_id").format(fmt).save(path)


def run_record(spark: SparkSession, run_id: str, record: Mapping[str, Any]) -> DataFrame:
    """One row describing a run: chosen model, selection, tuning, parameters and metrics as JSON."""
    return local_rows(spark, [(run_id, json.dumps(record, default=str, sort_keys=True))], "run_id string, record string")


def write_run_record(spark: SparkSession, path: str, run_id: str, record: Mapping[str, Any]) -> None:
    run_record(spark, run_id, record).write.mode("append").json(path)


def write_evaluation(evaluation: DataFrame, path: str) -> None:
    """The nested evaluation as JSON text."""
    evaluation.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def metrics_report(spark: SparkSession, run_id: str, metrics: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Metrics per model in long form, appended to a run log; ``line`` is the report text."""
    rows = [
        (run_id, model, name, float(value), f"{name}: {value:.4f}")
        for model, values in metrics.items()
        for name, value in values.items()
        if value is not None
    ]
    return local_rows(spark, rows, "run_id string, model string, metric string, value double, line string")


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("append").partitionBy("run_id").parquet(path)
