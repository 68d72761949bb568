"""Registered queries against their SQL in DuckDB.

A spread of queries runs by default; MILLRACE_ALL=1 runs every one.
"""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check_queries import TABLES, normalise

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
SPREAD = (
    "univariate_numeric missing_info auto_impute clip_iqr scale_robust onehot target_encode derive quantile_bins category_codes "
    "corr_pairs kruskal two_sample_battery decile_lift gini_lorenz split_stratified kfold knn_join smote kbest_f_classif vif_select "
    "ridge cv_evaluate regression_metrics durbin_watson roc_auc histogram boxplot_stats preprocess regression_run"
).split()


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(ORACLES) if os.environ.get("MILLRACE_ALL") else SPREAD)
def test_query_equals_sql(spark, data, con, name):
    df = QUERIES[name](spark, data)
    rel = con.sql(ORACLES[name])
    want = normalise(rel.fetchall(), rel.columns)
    assert normalise([tuple(r) for r in df.collect()], df.columns) == want


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark, data):
    assert contract.entry(spark).count() == 4
