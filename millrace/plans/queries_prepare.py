"""Queries for conversion, cleaning, scaling, encoding and feature construction."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, convert, encode, engineer, scale, split
from ..sources import generate, tables
from . import inputs as I
from .registry import query


def hx(key: str, seed: str) -> str:
    """DuckDB text of the 52-bit hash integer used by the hash functions."""
    return f"('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 13))::BIGINT"


def hu(key: str, seed: str) -> str:
    return f"({hx(key, seed)}::DOUBLE / 4503599627370496)"


def hn(key: str, seed: str) -> str:
    return f"(sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {hu(key, seed + 'a')})) * cos(6.283185307179586::DOUBLE * {hu(key, seed + 'b')}))"


# ---------------------------------------------------------------- sources


@query("scan_table", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def scan_table(t):
    df = tables.scan_table(t.spark, f"{t.folder}/lineitem.parquet")
    return df.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


def _pick(levels, key, seed):
    return f"list_extract({levels!r}, CAST({hx(key, seed)} % {len(levels)} AS INT) + 1)"


_REG = f"""SELECT o_orderkey, {hn('o_orderkey', '42f0')} AS float_feature_0, {hn('o_orderkey', '42f1')} AS float_feature_1,
 {hx('o_orderkey', '42i0')} % 100 AS int_feature_0, {hx('o_orderkey', '42b0')} % 2 = 1 AS bool_feature_0,
 {_pick(generate.LETTERS, 'o_orderkey', '42c0')} AS cat_feature_0,
 {_pick(generate.TEXT_LEVELS, 'o_orderkey', '42t0')} AS text_feature_0,
 {hn('o_orderkey', '42noise')} AS noise FROM orders"""


@query(
    "gen_regression",
    f"""WITH b AS ({_REG}), m AS (SELECT *, 0.1 * noise + 2.0 * float_feature_0 + 0.5 * int_feature_0
   + 3.0 * CAST(bool_feature_0 AS INT) + CAST(cat_feature_0 = 'A' AS INT) + CAST(text_feature_0 = 'high' AS INT) AS raw FROM b),
 s AS (SELECT avg(raw) AS mu, stddev_pop(raw) AS sd FROM m)
 SELECT o_orderkey, float_feature_0, float_feature_1, int_feature_0, bool_feature_0, cat_feature_0, text_feature_0,
   (raw - mu) / sd * 10 + 50 AS target FROM m, s""",
    doubles="float_feature_0 float_feature_1 target",
    digits=5,
)
def gen_regression(t):
    return generate.gen_regression(t.orders, "o_orderkey", 2, 1, 1, 1, 1)


@query(
    "gen_mixed",
    f"""SELECT o_orderkey, {hx('o_orderkey', '42b0')} % 2 = 1 AS bool_col_0, {hx('o_orderkey', '42i0')} % 1000 AS int_col_0,
 {hu('o_orderkey', '42f0')} * 1000 AS float_col_0,
 {' || '.join(f"substr('{generate.ALPHABET}', CAST(('0x' || substr(md5('42t0:' || CAST(o_orderkey AS VARCHAR)), {3 * j + 1}, 3))::BIGINT % 52 AS INT) + 1, 1)" for j in range(10))} AS text_col_0,
 {_pick(generate.LETTERS[:4], 'o_orderkey', '42c0')} AS cat_col_0,
 CAST(date '2020-01-01' + CAST({hx('o_orderkey', '42d0')} % 3650 AS INT) AS TIMESTAMP) AS date_col_0,
 {hu('o_orderkey', '42y')} * 1000 AS target FROM orders""",
    doubles="float_col_0 target",
)
def gen_mixed(t):
    df = generate.gen_mixed(t.orders, "o_orderkey", per_kind=1)
    return df.withColumn("date_col_0", F.col("date_col_0").cast("timestamp_ntz"))


def _numeric_sql():
    import random

    rng = random.Random(42)
    cols, mix = [], hn("o_orderkey", "42noise")
    for i in range(2):
        cols.append((f"int_col_{i}", f"({hx('o_orderkey', f'42i{i}')} % 100 + {hn('o_orderkey', f'42in{i}')})"))
    for i in range(2):
        cols.append((f"float_col_{i}", f"(50 + 10 * {hn('o_orderkey', f'42f{i}')})"))
    for _, e in cols:
        mix += f" + {rng.uniform(-2.0, 2.0)!r}::DOUBLE * {e}"
    cats = [f"CASE WHEN {hu('o_orderkey', f'42c{i}')} < 0.4 THEN 'A' WHEN {hu('o_orderkey', f'42c{i}')} < 0.7 THEN 'B' ELSE 'C' END AS cat_col_{i}" for i in range(2)]
    return f"SELECT o_orderkey, {', '.join(f'{e} AS {n}' for n, e in cols)}, {', '.join(cats)}, {mix} AS target FROM orders"


@query("gen_numeric", _numeric_sql(), doubles="int_col_0 int_col_1 float_col_0 float_col_1 target")
def gen_numeric(t):
    return generate.gen_numeric(t.orders, "o_orderkey", per_kind=2)


def _classes_sql():
    key = "o_orderkey"
    mix = " + ".join(f"{(-1.0) ** i} * {hn(key, f'42n{i}')}" for i in range(3))
    cells = [(f"numeric_{i}", hn(key, f"42n{i}")) for i in range(3)]
    cells += [("category_0", _pick(generate.LETTERS[:4], key, "42c0")), ("boolean_0", f"{hx(key, '42b0')} % 2 = 1")]
    picks = ", ".join(f"CASE WHEN {hu(key, '42null' + n)} < 0.05 THEN NULL ELSE {e} END AS {n}" for n, e in cells)
    return f"SELECT {key}, {picks}, CASE WHEN {hu(key, '42y')} < 1 / (1 + exp(-({mix}))) THEN 1 ELSE 0 END AS target FROM orders"


@query("gen_classification", _classes_sql(), doubles="numeric_0 numeric_1 numeric_2")
def gen_classification(t):
    return generate.gen_classification(t.orders, "o_orderkey", n_numeric=3, n_category=1, n_boolean=1)


@query(
    "inject_missing",
    f"""SELECT o_orderkey, CASE WHEN {hu('o_orderkey', '42nullo_totalprice')} < 0.2 THEN NULL ELSE o_totalprice END AS o_totalprice,
 CASE WHEN {hu('o_orderkey', '42nullo_orderstatus')} < 0.1 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders""",
    doubles="o_totalprice",
)
def inject_missing(t):
    df = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    return generate.inject_missing(df, "o_orderkey", share={"o_totalprice": 0.2, "o_orderstatus": 0.1})


# ---------------------------------------------------------------- kinds and conversion


@query(
    "column_kinds",
    """SELECT 'o_orderkey' AS "column", 'numeric' AS kind UNION ALL SELECT 'o_custkey', 'numeric'
 UNION ALL SELECT 'o_orderstatus', CASE WHEN (SELECT count(DISTINCT o_orderstatus) FROM orders) < 10 THEN 'categorical' ELSE 'text' END
 UNION ALL SELECT 'o_totalprice', 'numeric' UNION ALL SELECT 'o_orderdate', 'datetime'
 UNION ALL SELECT 'o_orderpriority', CASE WHEN (SELECT count(DISTINCT o_orderpriority) FROM orders) < 10 THEN 'categorical' ELSE 'text' END
 UNION ALL SELECT 'big', 'boolean'
 UNION ALL SELECT 'tag', CASE WHEN (SELECT count(DISTINCT o_orderkey % 25) FROM orders) < 10 THEN 'categorical' ELSE 'text' END""",
)
def column_kinds(t):
    df = t.orders.selectExpr("*", "o_totalprice > 1000 AS big", "concat('t', o_orderkey % 25) AS tag")
    return convert.column_kind_table(df)


@query(
    "group_candidates",
    """SELECT c AS "column" FROM (SELECT 'o_orderstatus' AS c, count(DISTINCT o_orderstatus) AS n FROM orders
 UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM orders
 UNION ALL SELECT 'o_orderdate', count(DISTINCT o_orderdate) FROM orders) WHERE n <= 20""",
)
def group_candidates(t):
    names = convert.group_candidates(t.orders)
    return t.spark.createDataFrame([(c,) for c in names], "column string")


@query("select_kind", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders", doubles="o_totalprice")
def select_kind(t):
    return convert.select_kind(t.orders, "numeric")


@query(
    "to_numeric",
    f"SELECT event_id, try_cast(mixed_text AS DOUBLE) AS mixed_text, try_cast(value_text AS DOUBLE) AS value_text FROM {I.EV_STRINGS}",
    doubles="mixed_text value_text",
)
def to_numeric(t):
    df = I.ev_strings(t).select("event_id", "mixed_text", "value_text")
    return convert.to_numeric(df, errors="coerce").transform(df)


@query(
    "to_numeric_ignore",
    f"SELECT event_id, mixed_text, try_cast(value_text AS DOUBLE) AS value_text FROM {I.EV_STRINGS}",
    doubles="value_text",
)
def to_numeric_ignore(t):
    df = I.ev_strings(t).selectExpr(
        "event_id", "value_text", "CASE WHEN mixed_text = 'x' THEN 'x' ELSE value_text END AS mixed_text"
    )
    return convert.to_numeric(df, errors="ignore").transform(df)


@query(
    "parse_boolean",
    f"""SELECT event_id, lower(trim(flag_text)) IN ('true', 'yes', '1') AS flag_text, flag_number = 1 AS flag_number, padded
 FROM {I.EV_STRINGS}""",
)
def parse_boolean(t):
    df = I.ev_strings(t).select("event_id", "flag_text", "flag_number", "padded")
    return convert.parse_boolean(df).transform(df)


@query(
    "category_codes",
    f"""SELECT event_id, coalesce(r, -1)::BIGINT AS event_type FROM {I.EV_NULLS} e LEFT JOIN
 (SELECT event_type AS v, dense_rank() OVER (ORDER BY event_type) - 1 AS r FROM (SELECT DISTINCT event_type FROM {I.EV_NULLS} WHERE event_type IS NOT NULL))
 ON v = e.event_type""",
)
def category_codes(t):
    return convert.category_codes(I.ev_nulls(t).select("event_id", "event_type"), ["event_type"])


@query("date_to_epoch", "SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS o_orderdate FROM orders")
def date_to_epoch(t):
    df = t.orders.select("o_orderkey", "o_orderdate")
    return convert.date_to_epoch(df).transform(df)


@query(
    "bool_to_int",
    "SELECT o_orderkey, CAST(o_totalprice > 200000 AS INT) AS big FROM orders",
)
def bool_to_int(t):
    df = t.orders.selectExpr("o_orderkey", "o_totalprice > 200000 AS big")
    return convert.bool_to_int(df).transform(df)


@query("numeric_to_double", "SELECT CAST(p_partkey AS DOUBLE) AS p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_brand FROM part",
       doubles="p_partkey p_size")
def numeric_to_double(t):
    df = t.part.select("p_partkey", "p_size", "p_brand")
    return convert.numeric_to_double(df).transform(df)


@query("strip_strings", f"SELECT event_id, trim(padded) AS padded FROM {I.EV_STRINGS}")
def strip_strings(t):
    df = I.ev_strings(t).select("event_id", "padded")
    return convert.strip_strings(df).transform(df)


@query("lower_strings", f"SELECT event_id, lower(trim(padded)) AS padded FROM {I.EV_STRINGS}")
def lower_strings(t):
    df = I.ev_strings(t).select("event_id", "padded")
    return convert.lower_strings(df).transform(df)


@query(
    "replace_inf",
    "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS value FROM events",
    doubles="value",
)
def replace_inf(t):
    df = t.events.selectExpr(
        "event_id",
        "CASE WHEN event_id % 8 = 0 THEN CAST('Infinity' AS DOUBLE) WHEN event_id % 8 = 4 THEN CAST('-Infinity' AS DOUBLE) ELSE value END AS value",
    )
    return convert.replace_inf(df).transform(df)


_FF = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "float_features",
    "SELECT o_totalprice AS target, CAST(o_custkey AS DOUBLE) AS o_custkey, CAST(epoch(o_orderdate) AS DOUBLE) AS o_orderdate, "
    + ", ".join(f"CAST(o_orderpriority = '{v}' AS DOUBLE) AS \"o_orderpriority_{v}\"" for v in _FF)
    + " FROM orders",
    doubles="target o_custkey o_orderdate " ,
)
def float_features(t):
    df = t.orders.selectExpr("o_custkey", "o_orderdate", "o_orderpriority", "concat('t', o_orderkey) AS txt", "o_totalprice AS target", "o_orderkey")
    train, test = split.parts(split.split_random(df, "o_orderkey", mode="approx").drop("o_orderkey"))
    step = convert.float_features(train, test, "target")
    return step.transform(train).unionByName(step.transform(test))


# ---------------------------------------------------------------- cleaning


@query(
    "missing_info",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS missing_percentage, '{d}' AS dtype FROM {I.EV_NULLS}"
        for c, d in [("event_id", "bigint"), ("user_id", "bigint"), ("value", "double"), ("event_type", "string"), ("score", "bigint")]
    ),
    doubles="missing_percentage",
)
def missing_info(t):
    return clean.missing_info(I.ev_nulls(t))


@query("drop_high_missing", f"SELECT event_id, value, fixed FROM {I.EV_SPARSE}", doubles="value")
def drop_high_missing(t):
    return clean.drop_high_missing(I.ev_sparse(t))


@query("drop_duplicates", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def drop_duplicates(t):
    return clean.drop_duplicates(t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber"))


@query("drop_constant", f"SELECT event_id, value, sparse, nearly_fixed FROM {I.EV_SPARSE}", doubles="value sparse")
def drop_constant(t):
    return clean.drop_constant(I.ev_sparse(t))


_MODE = f"(SELECT min(v) FROM (SELECT event_type AS v, count(*) AS n FROM {I.EV_NULLS} WHERE event_type IS NOT NULL GROUP BY 1) WHERE n = (SELECT max(n) FROM (SELECT count(*) AS n FROM {I.EV_NULLS} WHERE event_type IS NOT NULL GROUP BY event_type)))"


@query(
    "impute",
    f"""SELECT event_id, user_id, coalesce(value, (SELECT avg(value) FROM {I.EV_NULLS})) AS value,
 coalesce(event_type, {_MODE}) AS event_type, coalesce(CAST(score AS DOUBLE), (SELECT quantile_cont(score, 0.5) FROM {I.EV_NULLS})) AS score
 FROM {I.EV_NULLS}""",
    doubles="value score",
)
def impute(t):
    df = I.ev_nulls(t)
    return clean.impute(df, {"value": "mean", "score": "median"}).transform(df)


@query(
    "impute_constant",
    f"SELECT event_id, coalesce(value, -1.5) AS value, coalesce(event_type, 'none') AS event_type FROM {I.EV_NULLS}",
    doubles="value",
)
def impute_constant(t):
    df = I.ev_nulls(t).select("event_id", "value", "event_type")
    return clean.impute(df, "constant", {"value": -1.5, "event_type": "none"}).transform(df)


@query(
    "auto_impute",
    f"""SELECT event_id, user_id,
 coalesce(value, (SELECT CASE WHEN abs(skewness(value)) > 1 THEN quantile_cont(value, 0.5) ELSE avg(value) END FROM {I.EV_NULLS})) AS value,
 coalesce(event_type, {_MODE}) AS event_type,
 coalesce(CAST(score AS DOUBLE), (SELECT CASE WHEN abs(skewness(score)) > 1 THEN quantile_cont(score, 0.5) ELSE avg(score) END FROM {I.EV_NULLS})) AS score
 FROM {I.EV_NULLS}""",
    doubles="value score",
)
def auto_impute(t):
    df = I.ev_nulls(t)
    return clean.auto_impute(df).transform(df)


@query(
    "custom_impute",
    f"SELECT event_id, coalesce(value, event_id * 0.5) AS value, coalesce(event_type, 'unknown') AS event_type FROM {I.EV_NULLS}",
    doubles="value",
)
def custom_impute(t):
    df = I.ev_nulls(t).select("event_id", "value", "event_type")
    return clean.custom_impute(df, {"value": lambda c: F.col("event_id") * 0.5, "event_type": "unknown"})


@query(
    "imputation_summary",
    f"""SELECT 'score' AS "column", count(*) - count(score) AS missing_count, 'mean' AS strategy, round(avg(score), 6) AS imputed FROM {I.EV_NULLS}
 UNION ALL SELECT 'value', count(*) - count(value), 'median', round(quantile_cont(value, 0.5), 6) FROM {I.EV_NULLS}""",
    doubles="imputed",
)
def imputation_summary(t):
    df = I.ev_nulls(t).select("value", "score")
    out = clean.imputation_summary(df, clean.auto_impute(df))
    return out.select("column", "missing_count", "strategy", F.col("imputed_value").cast("double").alias("imputed"))


_Q = "SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, avg(value) AS mu, stddev_samp(value) AS sd FROM " + I.EV_NULLS


@query(
    "clip_iqr",
    f"""SELECT event_id, CASE WHEN value IS NULL THEN NULL ELSE greatest(least(value, q3 + 1.5 * (q3 - q1)), q1 - 1.5 * (q3 - q1)) END AS value
 FROM {I.EV_NULLS}, ({_Q})""",
    doubles="value",
)
def clip_iqr(t):
    df = I.ev_nulls(t).select("event_id", "value")
    return clean.clip_iqr(df, ["value"]).transform(df)


@query(
    "clip_zscore",
    f"""SELECT event_id, CASE WHEN abs((value - mu) / sd) > 1.5 THEN mu + 1.5 * sd * sign((value - mu) / sd) ELSE value END AS value
 FROM {I.EV_NULLS}, ({_Q})""",
    doubles="value",
)
def clip_zscore(t):
    df = I.ev_nulls(t).select("event_id", "value")
    return clean.clip_zscore(df, ["value"]).transform(df)


@query(
    "remove_outliers_iqr",
    f"SELECT event_id, value FROM {I.EV_NULLS}, ({_Q}) WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)",
    doubles="value",
)
def remove_outliers_iqr(t):
    df = I.ev_nulls(t).select("event_id", "value")
    return clean.remove_outliers_iqr(df, "value").transform(df)


def _outlier_sql(c, table):
    return f"""SELECT '{c}' AS "column", q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound,
 (SELECT count(*) FROM {table} WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers,
 100.0::DOUBLE * (SELECT count(*) FROM {table} WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) / n AS outlier_percentage
 FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, count({c}) AS n FROM {table})"""


@query(
    "outlier_report",
    _outlier_sql("value", I.EV_NULLS) + " UNION ALL " + _outlier_sql("score", I.EV_NULLS),
    doubles="q1 q3 iqr lower_bound upper_bound outlier_percentage",
)
def outlier_report(t):
    return clean.outlier_report(I.ev_nulls(t), ["value", "score"])


@query(
    "outlier_report_zscore",
    f"""SELECT 'value' AS "column", mu - 2 * sd AS lower_bound, mu + 2 * sd AS upper_bound,
 (SELECT count(*) FROM {I.EV_NULLS} WHERE value < mu - 2 * sd OR value > mu + 2 * sd) AS n_outliers FROM ({_Q})""",
    doubles="lower_bound upper_bound",
)
def outlier_report_zscore(t):
    out = clean.outlier_report(I.ev_nulls(t), ["value"], method="zscore")
    return out.select("column", "lower_bound", "upper_bound", "n_outliers")


@query("drop_null_target", f"SELECT event_id, value FROM {I.EV_NULLS} WHERE value IS NOT NULL", doubles="value")
def drop_null_target(t):
    return clean.drop_null_target(I.ev_nulls(t).select("event_id", "value"), "value")


# ---------------------------------------------------------------- scaling


def _orders(t):
    return t.orders.select("o_orderkey", "o_totalprice")


@query(
    "scale_minmax",
    """SELECT o_orderkey, (o_totalprice - lo) / (hi - lo) * 2 - 1 AS o_totalprice
 FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)""",
    doubles="o_totalprice",
)
def scale_minmax(t):
    df = _orders(t)
    return scale.scale_minmax(df, ["o_totalprice"], (-1, 1)).transform(df)


@query(
    "scale_robust",
    """SELECT o_orderkey, (o_totalprice - q[2]) / (q[3] - q[1]) AS o_totalprice
 FROM orders, (SELECT quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) AS q FROM orders)""",
    doubles="o_totalprice",
)
def scale_robust(t):
    df = _orders(t)
    return scale.scale_robust(df, ["o_totalprice"]).transform(df)


@query(
    "scale_standard",
    """SELECT o_orderkey, (o_totalprice - mu) / sd AS o_totalprice
 FROM orders, (SELECT avg(o_totalprice) AS mu, stddev_pop(o_totalprice) AS sd FROM orders)""",
    doubles="o_totalprice",
)
def scale_standard(t):
    df = _orders(t)
    return scale.scale_standard(df, ["o_totalprice"]).transform(df)


@query(
    "zscore_sample",
    """SELECT o_orderkey, o_totalprice, (o_totalprice - mu) / sd AS o_totalprice_standardized, (o_totalprice - lo) / (hi - lo) AS o_totalprice_normalized
 FROM orders, (SELECT avg(o_totalprice) AS mu, stddev_samp(o_totalprice) AS sd, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)""",
    doubles="o_totalprice o_totalprice_standardized o_totalprice_normalized",
)
def zscore_sample(t):
    df = _orders(t)
    return scale.zscore_sample(df, ["o_totalprice"]).transform(df)


@query(
    "log_transform",
    "SELECT o_orderkey, o_totalprice, ln(1 + o_totalprice) AS o_totalprice_log FROM orders",
    doubles="o_totalprice o_totalprice_log",
)
def log_transform(t):
    df = _orders(t)
    return scale.log_transform(df, ["o_totalprice"], suffix="_log").transform(df)


@query(
    "log_skewed",
    """SELECT event_id, CASE WHEN lo > 0 AND abs(sk) > 0.75 THEN ln(1 + value) ELSE value END AS value
 FROM events, (SELECT min(value) AS lo, skewness(value) AS sk FROM events)""",
    doubles="value",
)
def log_skewed(t):
    df = t.events.select("event_id", "value")
    return scale.log_skewed(df, ["value"]).transform(df)


@query(
    "scaling_summary",
    """SELECT 'o_totalprice' AS "column", 'standardization' AS method, avg(o_totalprice) AS original_mean, stddev_pop(o_totalprice) AS original_std,
 min(o_totalprice) AS original_min, max(o_totalprice) AS original_max, avg(o_totalprice) AS centre, stddev_pop(o_totalprice) AS scale FROM orders""",
    doubles="original_mean original_std original_min original_max centre scale",
    digits=4,
)
def scaling_summary(t):
    df = _orders(t)
    return scale.scaling_summary(df, scale.scale_standard(df, ["o_totalprice"]))


@query("inverse_scale", "SELECT o_orderkey, o_totalprice FROM orders", doubles="o_totalprice", digits=4)
def inverse_scale(t):
    df = _orders(t)
    step = scale.scale_minmax(df, ["o_totalprice"])
    return scale.inverse_scale(step.transform(df), step)


# ---------------------------------------------------------------- encoding


@query(
    "onehot",
    "SELECT o_orderkey, " + ", ".join(f"CAST(o_orderpriority = '{v}' AS INT) AS \"o_orderpriority_{v}\"" for v in _FF[1:]) + " FROM orders",
)
def onehot(t):
    df = t.orders.select("o_orderkey", "o_orderpriority")
    return encode.onehot(df).transform(df)


@query(
    "label_encode",
    f"""WITH f AS (SELECT event_id, coalesce(event_type, 'nan') AS v FROM {I.EV_NULLS})
 SELECT event_id, r::BIGINT AS event_type FROM f JOIN (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS r FROM (SELECT DISTINCT v FROM f)) USING (v)""",
)
def label_encode(t):
    return encode.label_encode(I.ev_nulls(t).select("event_id", "event_type"))


@query(
    "frequency_encode",
    f"""SELECT event_id, f AS event_type FROM {I.EV_NULLS} e LEFT JOIN (SELECT event_type AS v, count(*)::DOUBLE / (SELECT count(*) FROM events) AS f
 FROM {I.EV_NULLS} WHERE event_type IS NOT NULL GROUP BY 1) ON v = e.event_type""",
    doubles="event_type",
)
def frequency_encode(t):
    df = I.ev_nulls(t).select("event_id", "event_type")
    return encode.frequency_encode(df, "event_type").transform(df)


@query(
    "count_encode",
    """SELECT event_id, c::DOUBLE AS user_id FROM events e JOIN (SELECT user_id AS v, count(*) AS c FROM events GROUP BY 1) ON v = e.user_id""",
    doubles="user_id",
)
def count_encode(t):
    df = t.events.select("event_id", "user_id")
    return encode.count_encode(df, "user_id").transform(df)


@query(
    "target_encode",
    f"""WITH s AS (SELECT event_type AS v, count(*) AS n, avg(value) AS m FROM {I.EV_NULLS} WHERE event_type IS NOT NULL GROUP BY 1),
 p AS (SELECT avg(value) AS prior FROM {I.EV_NULLS}), w AS (SELECT *, 1 / (1 + exp(-(n - 20) / 10.0::DOUBLE)) AS k FROM s)
 SELECT event_id, coalesce(k * m + (1 - k) * prior, prior) AS encoded FROM {I.EV_NULLS} e CROSS JOIN p LEFT JOIN w ON v = e.event_type""",
    doubles="encoded",
)
def target_encode(t):
    df = I.ev_nulls(t)
    return encode.target_encode(df, "event_type", "value", output="encoded").transform(df).select("event_id", "encoded")


@query(
    "woe_encode",
    f"""WITH d AS {I.SCORE_DOCS}, s AS (SELECT lang AS v, count(*) AS n, sum(label) AS p FROM d GROUP BY 1),
 g AS (SELECT sum(label) AS gp, count(*) - sum(label) AS gn FROM d)
 SELECT doc_id, ln(((p + 1) / (gp + 2)::DOUBLE) / ((n - p + 1) / (gn + 2)::DOUBLE)) AS lang FROM d JOIN s ON v = d.lang CROSS JOIN g""",
    doubles="lang",
)
def woe_encode(t):
    df = I.score_docs(t)
    return encode.woe_encode(df, "lang", "label").transform(df).select("doc_id", "lang")


@query(
    "tfidf",
    r"""WITH tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS token FROM documents),
 tf AS (SELECT doc_id, token, count(*) AS tf FROM tok GROUP BY ALL),
 df AS (SELECT token, count(*) AS df FROM tf GROUP BY 1),
 w AS (SELECT doc_id, token, tf * (ln((1.0::DOUBLE + (SELECT count(*) FROM documents)) / (1.0::DOUBLE + df)) + 1) AS w FROM tf JOIN df USING (token))
 SELECT doc_id, token, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS tfidf FROM w""",
    doubles="tfidf",
)
def tfidf(t):
    return encode.tfidf(t.documents, "doc_id", "text")


@query("text_length", "SELECT doc_id, length(text)::INT AS text_len FROM documents")
def text_length(t):
    df = t.documents.select("doc_id", "text")
    return encode.text_length(df).transform(df).drop("text")


# ---------------------------------------------------------------- features


@query(
    "derive",
    f"""SELECT event_id, coalesce(value, 0) + coalesce(score, 0) AS total, CASE WHEN value IS NULL AND score IS NULL THEN NULL ELSE
 (coalesce(value, 0) + coalesce(score, 0)) / (CASE WHEN value IS NULL THEN 0 ELSE 1 END + CASE WHEN score IS NULL THEN 0 ELSE 1 END) END AS average,
 CASE WHEN score = 0 THEN NULL ELSE value / score END AS rate, value - score AS gap, coalesce(value, 1) * coalesce(score, 1) AS product FROM {I.EV_NULLS}""",
    doubles="total average rate gap product",
    digits=9,
)
def derive(t):
    df = I.ev_nulls(t)
    ops = {
        "total": {"columns": ["value", "score"], "operation": "sum"},
        "average": {"columns": ["value", "score", "nowhere"], "operation": "mean"},
        "rate": {"columns": ["value", "score"], "operation": "ratio"},
        "gap": {"columns": ["value", "score"], "operation": "difference"},
        "product": {"columns": ["value", "score"], "operation": "product"},
        "ignored": {"columns": ["nowhere"], "operation": "sum"},
    }
    return engineer.derive(df, ops).transform(df).select("event_id", "total", "average", "rate", "gap", "product")


@query(
    "interact",
    "SELECT p_partkey, p_size * p_retailprice AS p_size_multiplication_p_retailprice, p_retailprice / p_size AS p_retailprice_division_p_size FROM part",
    doubles="p_size_multiplication_p_retailprice p_retailprice_division_p_size",
)
def interact(t):
    df = t.part.select("p_partkey", "p_size", "p_retailprice")
    out = engineer.interact(df, [["p_size", "p_retailprice"]]).transform(df)
    out = engineer.interact(out, [["p_retailprice", "p_size"]], "division").transform(out)
    return out.drop("p_size", "p_retailprice")


@query(
    "interact_all_pairs",
    """SELECT l_quantity * l_discount AS l_quantity_x_l_discount, l_quantity * l_tax AS l_quantity_x_l_tax, l_discount * l_tax AS l_discount_x_l_tax FROM lineitem""",
    doubles="l_quantity_x_l_discount l_quantity_x_l_tax l_discount_x_l_tax",
)
def interact_all_pairs(t):
    df = t.lineitem.select("l_quantity", "l_discount", "l_tax")
    return engineer.interact_all_pairs(df, df.columns).transform(df).drop(*df.columns)


@query(
    "polynomial",
    """SELECT p_partkey, CAST(p_size AS DOUBLE) * p_size AS "poly_p_size^2", p_size * p_retailprice AS "poly_p_size p_retailprice", p_retailprice * p_retailprice AS "poly_p_retailprice^2" FROM part""",
    doubles=["poly_p_size^2", "poly_p_size p_retailprice", "poly_p_retailprice^2"],
)
def polynomial(t):
    df = t.part.select("p_partkey", "p_size", "p_retailprice")
    return engineer.polynomial(df, ["p_size", "p_retailprice"]).transform(df).drop("p_size", "p_retailprice")


@query(
    "pca",
    """WITH c AS (SELECT var_samp(l_quantity) AS a, var_samp(l_linenumber) AS b, covar_samp(l_quantity, CAST(l_linenumber AS DOUBLE)) AS c FROM lineitem),
 e AS (SELECT (a + b) / 2 + sqrt((a - b) * (a - b) / 4 + c * c) AS l1, (a + b) / 2 - sqrt((a - b) * (a - b) / 4 + c * c) AS l2 FROM c)
 SELECT 'pca_component_1' AS component, l1 / (l1 + l2) AS explained_variance_ratio, l1 / (l1 + l2) AS cumulative_variance_ratio FROM e
 UNION ALL SELECT 'pca_component_2', l2 / (l1 + l2), 1.0 FROM e""",
    doubles="explained_variance_ratio cumulative_variance_ratio",
)
def pca(t):
    df = t.lineitem.select("l_quantity", "l_linenumber")
    return engineer.pca(df, df.columns, n_components=2).table(df)


def pca2_sql(a: str, b: str, source: str) -> str:
    """Two principal components in closed form, the largest loading positive."""
    return f"""(WITH m AS (SELECT avg({a}) AS ma, avg({b}) AS mb, var_samp({a}) AS va, var_samp({b}) AS vb, covar_samp({a}, {b}) AS c FROM {source}),
 l AS (SELECT *, (va + vb) / 2 + sqrt((va - vb) * (va - vb) / 4 + c * c) AS l1 FROM m),
 u AS (SELECT *, (l1 - vb) / sqrt((l1 - vb) * (l1 - vb) + c * c) AS x, c / sqrt((l1 - vb) * (l1 - vb) + c * c) AS y FROM l)
 SELECT s.*, ({a} - ma) * x + ({b} - mb) * y AS pca_component_1, ({b} - mb) * x - ({a} - ma) * y AS pca_component_2 FROM {source} s, u)"""


@query(
    "pca_scores",
    f"SELECT l_quantity, l_tax, pca_component_1, pca_component_2 FROM {pca2_sql('l_quantity', 'l_tax', '(SELECT l_quantity, l_tax FROM lineitem)')}",
    doubles="l_quantity l_tax pca_component_1 pca_component_2",
)
def pca_scores(t):
    df = t.lineitem.select("l_quantity", "l_tax")
    return engineer.pca(df, df.columns, n_components=2).transform(df)


@query(
    "custom_feature",
    "SELECT o_orderkey, o_totalprice / 1000 AS thousands, o_totalprice > 100000 AS large FROM orders",
    doubles="thousands",
)
def custom_feature(t):
    df = t.orders.select("o_orderkey", "o_totalprice")
    rules = {"thousands": lambda d: d["o_totalprice"] / 1000, "large": lambda d: d["o_totalprice"] > 100000}
    return engineer.custom_feature(df, rules).drop("o_totalprice")


@query(
    "datetime_parts",
    """SELECT o_orderkey, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, day(o_orderdate)::INT AS day,
 (isodow(o_orderdate) - 1)::INT AS dayofweek, CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM orders""",
)
def datetime_parts(t):
    df = t.orders.select("o_orderkey", "o_orderdate")
    return engineer.datetime_parts(df, "o_orderdate").transform(df)


@query(
    "cut_bins",
    """WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
 SELECT o_orderkey, CASE WHEN o_totalprice <= lo + (hi - lo) * 1 / 4 THEN 'low' WHEN o_totalprice <= lo + (hi - lo) * 2 / 4 THEN 'mid'
 WHEN o_totalprice <= lo + (hi - lo) * 3 / 4 THEN 'high' ELSE 'top' END AS o_totalprice_binned FROM orders, s""",
)
def cut_bins(t):
    df = t.orders.select("o_orderkey", "o_totalprice")
    return engineer.cut_bins(df, "o_totalprice", 4, ["low", "mid", "high", "top"]).transform(df).drop("o_totalprice")


@query(
    "quantile_bins",
    """WITH q AS (SELECT quantile_cont(o_totalprice, [0.2, 0.4, 0.6, 0.8]) AS e FROM orders)
 SELECT o_orderkey, CASE WHEN o_totalprice <= e[1] THEN 0 WHEN o_totalprice <= e[2] THEN 1 WHEN o_totalprice <= e[3] THEN 2
 WHEN o_totalprice <= e[4] THEN 3 ELSE 4 END AS o_totalprice_bin FROM orders, q""",
)
def quantile_bins(t):
    df = t.orders.select("o_orderkey", "o_totalprice")
    return engineer.quantile_bins(df, "o_totalprice", 5).transform(df).drop("o_totalprice")


@query(
    "feature_info",
    """SELECT 'p_size_multiplication_p_retailprice' AS feature, 'interaction' AS type, 'multiplication' AS operation, 'p_size,p_retailprice' AS source_columns
 UNION ALL SELECT 'poly_p_size^2', 'polynomial', 'degree 2', 'p_size,p_size'""",
)
def feature_info(t):
    df = t.part.select("p_size", "p_retailprice")
    pairs = engineer.interact(df, [["p_size", "p_retailprice"]])
    return engineer.feature_info(df, pairs, engineer.polynomial(df, ["p_size"]))
