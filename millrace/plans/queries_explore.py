"""Queries for description, tests, lift, evaluation, residual diagnostics and chart tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import charts, evaluate, explore, hypothesis, lift
from . import inputs as I
from .queries_prepare import hu
from .registry import query

LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PROFILE_DOUBLES = "mean median mode min max std variance skewness kurtosis q1 q3 iqr"


def _mode(c, t):
    return f"(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


def _profile_sql(c, t):
    return f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, quantile_cont({c}, 0.5) AS median, CAST({_mode(c, t)} AS DOUBLE) AS mode,
 CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, stddev_samp({c}) AS std, var_samp({c}) AS variance, skewness({c}) AS skewness, kurtosis({c}) AS kurtosis,
 quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS iqr, count(*) - count({c}) AS missing FROM {t}"""


@query(
    "univariate_numeric",
    " UNION ALL ".join(_profile_sql(c, "lineitem") for c in LI),
    doubles=PROFILE_DOUBLES,
    digits=5,
    per_column={"variance": 2, "std": 4},
)
def univariate_numeric(t):
    return explore.univariate_numeric(t.lineitem, LI)


@query(
    "univariate_numeric_outliers",
    f"""SELECT p.*, u AS unique, q1 - 1.5 * iqr AS lower_bound, q3 + 1.5 * iqr AS upper_bound,
 (SELECT count(*) FROM {I.EV_NULLS} WHERE value < q1 - 1.5 * iqr OR value > q3 + 1.5 * iqr) AS n_outliers,
 100.0::DOUBLE * (SELECT count(*) FROM {I.EV_NULLS} WHERE value < q1 - 1.5 * iqr OR value > q3 + 1.5 * iqr) / count AS outlier_percentage
 FROM ({_profile_sql('value', I.EV_NULLS)}) p, (SELECT count(DISTINCT value) AS u FROM {I.EV_NULLS})""",
    doubles=PROFILE_DOUBLES + " lower_bound upper_bound outlier_percentage",
    digits=5,
)
def univariate_numeric_outliers(t):
    return explore.univariate_numeric(I.ev_nulls(t), ["value"], outliers=True)


@query(
    "value_counts",
    f"""SELECT 'event_type' AS "column", event_type AS value, count(*) AS n, count(*)::DOUBLE / (SELECT count(event_type) FROM {I.EV_NULLS}) AS proportion
 FROM {I.EV_NULLS} WHERE event_type IS NOT NULL GROUP BY event_type""",
    doubles="proportion",
)
def value_counts(t):
    return explore.value_counts(I.ev_nulls(t), ["event_type"])


_TOP = f"SELECT event_type AS v, count(*) AS n FROM {I.EV_NULLS} WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 3"


@query(
    "univariate_categorical",
    f"""SELECT 'event_type' AS "column", count(event_type) AS count, count(DISTINCT event_type) AS unique, (SELECT v FROM ({_TOP}) ORDER BY n DESC, v LIMIT 1) AS mode,
 count(*) - count(event_type) AS missing, 100.0::DOUBLE * (SELECT max(n) FROM ({_TOP})) / count(event_type) AS top_percentage,
 (SELECT string_agg(v || '=' || n, ', ' ORDER BY n DESC, v) FROM ({_TOP})) AS top_values FROM {I.EV_NULLS}""",
    doubles="top_percentage",
)
def univariate_categorical(t):
    return explore.univariate_categorical(I.ev_nulls(t), ["event_type"])


@query(
    "univariate_boolean",
    """SELECT 'flag' AS "column", count(*) FILTER (value > 20 AND event_id % 7 > 0) AS true_count, count(*) FILTER (NOT value > 20 AND event_id % 7 > 0) AS false_count,
 count(*) FILTER (event_id % 7 = 0) AS missing, count(*) FILTER (value > 20 AND event_id % 7 > 0)::DOUBLE / count(*) FILTER (event_id % 7 > 0) AS true_share FROM events""",
    doubles="true_share",
)
def univariate_boolean(t):
    return explore.univariate_boolean(t.events.selectExpr("CASE WHEN event_id % 7 > 0 THEN value > 20 END AS flag"))


@query(
    "univariate_datetime",
    """SELECT 'o_orderdate' AS "column", strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') AS first, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS last,
 count(*) - count(o_orderdate) AS missing, (SELECT string_agg(m || '=' || n, ', ' ORDER BY m) FROM (SELECT strftime(o_orderdate, '%Y-%m') AS m, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1 LIMIT 3)) AS rows_per_month FROM orders""",
)
def univariate_datetime(t):
    return explore.univariate_datetime(t.orders, ["o_orderdate"])


def _describe_sql(c, t):
    return f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS p25,
 quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM {t}"""


@query(
    "describe",
    " UNION ALL ".join(_describe_sql(c, "part") for c in ["p_partkey", "p_size", "p_retailprice"]),
    doubles="mean std min p25 p50 p75 max",
    digits=5,
)
def describe(t):
    return explore.describe(t.part)["numeric"]


@query(
    "describe_categorical",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, count(DISTINCT {c}) AS unique, {_mode(c, 'part')} AS top,
 (SELECT max(n) FROM (SELECT count(*) AS n FROM part GROUP BY {c})) AS freq FROM part"""
        for c in ["p_name", "p_brand", "p_type"]
    ),
)
def describe_categorical(t):
    return explore.describe(t.part)["categorical"]


@query(
    "basic_summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, count(*) - count({c}) AS missing, avg({c}) AS mean, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min,
 CAST(max({c}) AS DOUBLE) AS max, corr({c}, p_retailprice) AS target_correlation FROM part"""
        for c in ["p_partkey", "p_size", "p_retailprice"]
    ),
    doubles="mean std min max target_correlation",
    digits=5,
)
def basic_summary(t):
    return explore.basic_summary(t.part)


@query(
    "percentiles",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", " + ", ".join(f'quantile_cont({c}, {p / 100}) AS "P{p}"' for p in explore.PERCENTS) + " FROM lineitem"
        for c in LI
    ),
    doubles=" ".join(f"P{p}" for p in explore.PERCENTS),
)
def percentiles(t):
    return explore.percentiles(t.lineitem, LI)


def _corr_sql(pairs, t, fn="corr({a}, {b})"):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_1, '{b}' AS column_2, {fn.format(a=a, b=b)} AS correlation FROM {t}" for a, b in pairs
    )


_CHARGE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "charge"]


@query(
    "corr_matrix_pearson",
    _corr_sql([(a, b) for a in _CHARGE for b in _CHARGE], I.LI_CHARGE),
    doubles="correlation",
)
def corr_matrix_pearson(t):
    return explore.corr_matrix(I.li_charge(t), "pearson")


_RANKS = "(SELECT " + ", ".join(
    f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE) AS {c}" for c in _CHARGE
)


@query(
    "corr_matrix_spearman",
    _corr_sql([(a, b) for a in _CHARGE for b in _CHARGE], f"{_RANKS} FROM {I.LI_CHARGE})"),
    doubles="correlation",
)
def corr_matrix_spearman(t):
    return explore.corr_matrix(I.li_charge(t), "spearman")


_RANK_PAIR = f"""(SELECT (rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0::DOUBLE) AS value,
 (rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE) AS score FROM {I.EV_NULLS} WHERE value IS NOT NULL AND score IS NOT NULL)"""


@query(
    "corr_pairs",
    f"""SELECT 'value' AS column_1, 'score' AS column_2, 'pearson' AS method, corr(value, score) AS correlation, count(value + score) AS n FROM {I.EV_NULLS}
 UNION ALL SELECT 'value', 'score', 'spearman', corr(value, score), count(*) FROM {_RANK_PAIR}""",
    doubles="correlation",
)
def corr_pairs(t):
    return explore.corr_pairs(I.ev_nulls(t), ["value", "score"]).drop("p_value")


@query(
    "high_corr_pairs",
    f"SELECT * FROM ({_corr_sql([(a, b) for i, a in enumerate(_CHARGE) for b in _CHARGE[i + 1:]], I.LI_CHARGE)}) WHERE abs(correlation) >= 0.8",
    doubles="correlation",
)
def high_corr_pairs(t):
    return explore.high_corr_pairs(I.li_charge(t)).select("column_1", "column_2", "correlation")


@query(
    "group_stats",
    """SELECT o_orderpriority, avg(o_totalprice) AS mean, stddev_samp(o_totalprice) AS std, count(o_totalprice) AS count, min(o_totalprice) AS min, max(o_totalprice) AS max
 FROM orders GROUP BY 1""",
    doubles="mean std min max",
    digits=4,
)
def group_stats(t):
    return explore.group_stats(t.orders, "o_orderpriority", "o_totalprice")


@query(
    "textlen_corr",
    """WITH d AS (SELECT length(text) AS l, doc_id % 97 AS v FROM documents), r AS (SELECT (rank() OVER (ORDER BY l) + (count(*) OVER (PARTITION BY l) - 1) / 2.0::DOUBLE) AS l,
 (rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0::DOUBLE) AS v FROM d)
 SELECT 'text_len' AS column_1, 'v' AS column_2, corr(l, v) AS correlation FROM r""",
    doubles="correlation",
)
def textlen_corr(t):
    return explore.textlen_corr(t.documents.selectExpr("text", "doc_id % 97 AS v"), "text", ["v"]).drop("p_value")


_EVX = """(SELECT event_id, value, CASE WHEN event_id % 10 < 6 THEN NULL ELSE value END AS sparse, value * 2 + 1 AS double_value, 5.0::DOUBLE AS fixed FROM events)"""


def _insight_outlier(c):
    return f"""SELECT 'outliers' AS insight, '{c}' AS "column", NULL AS other_column, 100.0::DOUBLE * count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) / count({c}) AS value
 FROM {_EVX}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {_EVX}) HAVING value > 5"""


@query(
    "insights",
    f"""SELECT 'high_missing' AS insight, 'sparse' AS "column", NULL::VARCHAR AS other_column, 100.0::DOUBLE * (count(*) - count(sparse)) / count(*) AS value FROM {_EVX}
 UNION ALL SELECT 'constant', 'fixed', NULL, 5.0
 UNION ALL SELECT 'skewed', c, NULL, s FROM (SELECT 'value' AS c, skewness(value) AS s FROM {_EVX} UNION ALL SELECT 'sparse', skewness(sparse) FROM {_EVX}
   UNION ALL SELECT 'double_value', skewness(double_value) FROM {_EVX} UNION ALL SELECT 'event_id', skewness(event_id) FROM {_EVX}) WHERE abs(s) > 1
 UNION ALL {" UNION ALL ".join(f'SELECT * FROM ({_insight_outlier(c)})' for c in ["value", "sparse", "double_value", "event_id"])}
 UNION ALL SELECT 'high_correlation', a, b, r FROM (SELECT 'value' AS a, 'sparse' AS b, corr(value, sparse) AS r FROM {_EVX} UNION ALL SELECT 'value', 'double_value', corr(value, double_value) FROM {_EVX}
   UNION ALL SELECT 'sparse', 'double_value', corr(sparse, double_value) FROM {_EVX} UNION ALL SELECT 'event_id', 'value', corr(event_id, value) FROM {_EVX}) WHERE abs(r) >= 0.8""",
    doubles="value",
    digits=5,
)
def insights(t):
    df = t.events.selectExpr(
        "event_id", "value", "CASE WHEN event_id % 10 < 6 THEN NULL ELSE value END AS sparse", "value * 2 + 1 AS double_value", "5.0D AS fixed"
    )
    return explore.insights(df)


def _anova_sql(t, g, x):
    """One row: n, k and F over the groups of t."""
    return f"""(SELECT (sum(n * (m - gm) * (m - gm)) / (count(*) - 1)) / (sum(n * vp) / (sum(n) - count(*))) AS f FROM
 (SELECT count(*) AS n, avg({x}) AS m, var_pop({x}) AS vp FROM {t} WHERE {g} IS NOT NULL AND {x} IS NOT NULL GROUP BY {g} HAVING count(*) > 1),
 (SELECT avg({x}) AS gm FROM {t} WHERE {g} IS NOT NULL AND {x} IS NOT NULL))"""


@query(
    "bivariate",
    f"""SELECT 'o_orderkey' AS column_1, 'o_totalprice' AS column_2, 'Pearson' AS method, corr(o_orderkey, o_totalprice) AS statistic FROM orders
 UNION ALL SELECT 'o_orderpriority', 'o_orderkey', 'ANOVA', f FROM {_anova_sql('orders', 'o_orderpriority', 'o_orderkey')}
 UNION ALL SELECT 'o_orderpriority', 'o_totalprice', 'ANOVA', f FROM {_anova_sql('orders', 'o_orderpriority', 'o_totalprice')}""",
    doubles="statistic",
)
def bivariate(t):
    return explore.bivariate(t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")).drop("p_value")


# ---------------------------------------------------------------- tests


def _k2(c, t):
    return f"""SELECT '{c}' AS "column", k2 AS statistic, exp(-k2 / 2) AS p_value, exp(-k2 / 2) > 0.05 AS is_normal FROM (
 SELECT z1 * z1 + z2 * z2 AS k2 FROM (
 SELECT ln(y / al + sqrt((y / al) * (y / al) + 1)) * dl AS z1, (1 - 2 / (9 * a) - sign(dn) * pow((1 - 2 / a) / abs(dn), 1.0::DOUBLE / 3)) / sqrt(2 / (9 * a)) AS z2 FROM (
 SELECT *, sqrt(2 / (w2 - 1)) AS al, 1 / sqrt(0.5 * ln(w2)) AS dl, 1 + x * sqrt(2 / (a - 4)) AS dn FROM (
 SELECT *, -1 + sqrt(2 * (b2 - 1)) AS w2, 6 + 8 / sb * (2 / sb + sqrt(1 + 4 / (sb * sb))) AS a FROM (
 SELECT g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
  3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS b2,
  (g2 + 3 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x,
  6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb FROM (
 SELECT n, sk * (n - 2) / sqrt(n * (n - 1)) AS g1, g2 FROM (
 SELECT count({c})::DOUBLE AS n, skewness({c}) AS sk, kurtosis_pop({c}) AS g2 FROM {t})))))))"""


@query(
    "normality",
    _k2("value", "events") + " UNION ALL " + _k2("event_id", "events"),
    doubles="statistic p_value",
    digits=4,
)
def normality(t):
    return hypothesis.normality(t.events, ["value", "event_id"])


_TG = f"""SELECT max(n) FILTER (grp = 'a') AS n1, max(n) FILTER (grp = 'b') AS n2, max(m) FILTER (grp = 'a') AS m1, max(m) FILTER (grp = 'b') AS m2,
 max(v) FILTER (grp = 'a') AS v1, max(v) FILTER (grp = 'b') AS v2 FROM (SELECT grp, count(*)::DOUBLE AS n, avg(price) AS m, var_samp(price) AS v FROM {I.TWO_GROUPS} GROUP BY grp)"""


@query(
    "ttest",
    f"SELECT 'ttest' AS test, (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)) AS statistic, n1 + n2 - 2 AS dof FROM ({_TG})",
    doubles="statistic dof",
)
def ttest(t):
    df = I.two_groups(t)
    return hypothesis.as_table(df, {"ttest": hypothesis.ttest(df, "grp", "price")}).drop("p_value")


@query(
    "ttest_welch",
    f"""SELECT 'welch' AS test, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS statistic,
 (v1 / n1 + v2 / n2) * (v1 / n1 + v2 / n2) / ((v1 / n1) * (v1 / n1) / (n1 - 1) + (v2 / n2) * (v2 / n2) / (n2 - 1)) AS dof FROM ({_TG})""",
    doubles="statistic dof",
)
def ttest_welch(t):
    df = I.two_groups(t)
    return hypothesis.as_table(df, {"welch": hypothesis.ttest_welch(df, "grp", "price")}).drop("p_value")


@query(
    "anova",
    f"SELECT 'anova' AS test, f AS statistic FROM {_anova_sql('orders', 'o_orderpriority', 'o_totalprice')}",
    doubles="statistic",
)
def anova(t):
    got = hypothesis.anova(t.orders, "o_orderpriority", "o_totalprice")
    return hypothesis.as_table(t.orders, {"anova": got}).select("test", "statistic")


def _ranked(t, g, x):
    return f"(SELECT {g} AS g, {x} AS x, rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0::DOUBLE AS r FROM {t} WHERE {g} IS NOT NULL AND {x} IS NOT NULL)"


def _ties(t, x):
    return f"(SELECT sum(n * n * n - n) AS ties FROM (SELECT count(*)::DOUBLE AS n FROM {t} WHERE {x} IS NOT NULL GROUP BY {x}))"


def _kruskal_sql(t, g, x):
    return f"""(SELECT (12 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - ties / (n * n * n - n)) AS h FROM
 (SELECT sum(ng)::DOUBLE AS n, sum(rs * rs / ng) AS s FROM (SELECT g, count(*) AS ng, sum(r) AS rs FROM {_ranked(t, g, x)} GROUP BY g)), {_ties(t, x)})"""


@query("kruskal", f"SELECT 'kruskal' AS test, h AS statistic FROM {_kruskal_sql('lineitem', 'l_returnflag', 'l_quantity')}", doubles="statistic")
def kruskal(t):
    got = hypothesis.kruskal(t.lineitem, "l_returnflag", "l_quantity")
    return hypothesis.as_table(t.lineitem, {"kruskal": got}).select("test", "statistic")


def _mw_sql(t, g, x, first):
    return f"(SELECT sum(r) FILTER (g = '{first}') - count(*) FILTER (g = '{first}')::DOUBLE * (count(*) FILTER (g = '{first}') + 1) / 2 AS u FROM {_ranked(t, g, x)})"


def _ks_sql(t, g, x, first):
    return f"""(SELECT max(abs(a / na - b / nb)) AS d FROM (SELECT sum(p) OVER (ORDER BY x) AS a, sum(q) OVER (ORDER BY x) AS b FROM
 (SELECT {x} AS x, count(*) FILTER ({g} = '{first}')::DOUBLE AS p, count(*) FILTER ({g} <> '{first}')::DOUBLE AS q FROM {t} GROUP BY {x})),
 (SELECT count(*) FILTER ({g} = '{first}') AS na, count(*) FILTER ({g} <> '{first}') AS nb FROM {t}))"""


@query("mannwhitney", f"SELECT 'mannwhitney' AS test, u AS statistic FROM {_mw_sql(I.TWO_GROUPS, 'grp', 'price', 'a')}", doubles="statistic")
def mannwhitney(t):
    df = I.two_groups(t)
    return hypothesis.as_table(df, {"mannwhitney": hypothesis.mannwhitney(df, "grp", "price")}).select("test", "statistic")


_W = f"""(WITH d AS (SELECT first_price - last_price AS d FROM {I.PRICE_PAIRS} WHERE first_price <> last_price),
 r AS (SELECT d, rank() OVER (ORDER BY abs(d)) + (count(*) OVER (PARTITION BY abs(d)) - 1) / 2.0::DOUBLE AS r FROM d)
 SELECT least(coalesce(sum(r) FILTER (d > 0), 0), coalesce(sum(r) FILTER (d < 0), 0)) AS w FROM r)"""


@query("wilcoxon", f"SELECT 'wilcoxon' AS test, w AS statistic FROM {_W}", doubles="statistic")
def wilcoxon(t):
    df = I.price_pairs(t)
    return hypothesis.as_table(df, {"wilcoxon": hypothesis.wilcoxon(df, "first_price", "last_price")}).select("test", "statistic")


@query("ks_2samp", f"SELECT 'ks' AS test, d AS statistic FROM {_ks_sql(I.TWO_GROUPS, 'grp', 'price', 'a')}", doubles="statistic", digits=8)
def ks_2samp(t):
    df = I.two_groups(t)
    return hypothesis.as_table(df, {"ks": hypothesis.ks_2samp(df, "grp", "price")}).select("test", "statistic")


_CELLS = """(SELECT a, b, coalesce(n, 0) AS observed, ra * rb::DOUBLE / (SELECT count(*) FROM part) AS expected FROM
 (SELECT p_brand AS a, count(*) AS ra FROM part GROUP BY 1) CROSS JOIN (SELECT p_type AS b, count(*) AS rb FROM part GROUP BY 1)
 LEFT JOIN (SELECT p_brand AS a, p_type AS b, count(*) AS n FROM part GROUP BY ALL) USING (a, b))"""


@query("contingency", f"SELECT a AS first, b AS second, observed, expected FROM {_CELLS}", doubles="expected")
def contingency(t):
    return hypothesis.contingency(t.part, "p_brand", "p_type")


@query(
    "chi2_contingency",
    f"SELECT 'chi2' AS test, sum((observed - expected) * (observed - expected) / expected) AS statistic, (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1)::DOUBLE AS dof FROM {_CELLS}",
    doubles="statistic dof",
)
def chi2_contingency(t):
    return hypothesis.as_table(t.part, {"chi2": hypothesis.chi2_contingency(t.part, "p_brand", "p_type")}).drop("p_value")


_LEV = f"""(SELECT 'r' AS g, abs(e - (SELECT quantile_cont(y_true - y_pred, 0.5) FROM {I.PRED_ORDERS})) AS x FROM (SELECT y_true - y_pred AS e FROM {I.PRED_ORDERS})
 UNION ALL SELECT 'p', abs(y_pred - (SELECT quantile_cont(y_pred, 0.5) FROM {I.PRED_ORDERS})) FROM {I.PRED_ORDERS})"""


@query("levene", f"SELECT 'levene' AS test, f AS statistic FROM {_anova_sql(_LEV, 'g', 'x')}", doubles="statistic", digits=4)
def levene(t):
    df = I.pred_orders(t).withColumn("residual", F.col("y_true") - F.col("y_pred"))
    return hypothesis.as_table(df, {"levene": hypothesis.levene(df, "residual", "y_pred")}).select("test", "statistic")


@query(
    "stats_analysis",
    f"""SELECT 'o_orderpriority' AS "column", 'ANOVA' AS method, round(f, 4) AS statistic FROM {_anova_sql('orders', 'o_orderpriority', 'o_totalprice')}
 UNION ALL SELECT 'o_orderpriority', 'Kruskal-Wallis', round(h, 4) FROM {_kruskal_sql('orders', 'o_orderpriority', 'o_totalprice')}
 UNION ALL SELECT 'half', 'T-Test', round(s, 4) FROM (SELECT (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)) AS s FROM ({_TG.replace('price', 'o_totalprice').replace(I.TWO_GROUPS.replace('price', 'o_totalprice'), "(SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS grp, o_totalprice FROM orders)")}))
 UNION ALL SELECT 'half', 'Mann-Whitney U', round(u, 4) FROM {_mw_sql("(SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS grp, o_totalprice FROM orders)", 'grp', 'o_totalprice', 'a')}
 UNION ALL SELECT 'o_custkey', 'Pearson', round(corr(o_custkey, o_totalprice), 4) FROM orders""",
    doubles="statistic",
)
def stats_analysis(t):
    df = t.orders.selectExpr("o_custkey", "o_orderpriority", "CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS half", "o_totalprice")
    methods = ["pearson", "anova", "kruskal", "ttest", "mannwhitneyu"]
    return hypothesis.stats_analysis(df, ["o_custkey", "o_orderpriority", "half"], "o_totalprice", methods).drop("p_value")


@query(
    "compare_distributions",
    f"""SELECT 'price' AS "column", grp AS label, avg(price) AS mean, quantile_cont(price, 0.5) AS median, stddev_pop(price) AS std,
 quantile_cont(price, 0.75) - quantile_cont(price, 0.25) AS iqr, (SELECT u FROM {_mw_sql(I.TWO_GROUPS, 'grp', 'price', 'a')}) AS mannwhitney,
 (SELECT d FROM {_ks_sql(I.TWO_GROUPS, 'grp', 'price', 'a')}) AS ks FROM {I.TWO_GROUPS} GROUP BY grp""",
    doubles="mean median std iqr mannwhitney ks",
    digits=5,
)
def compare_distributions(t):
    return hypothesis.compare_distributions(I.two_groups(t), "grp", ["price"]).drop("mannwhitney_p", "ks_p")


_MS = """(SELECT CASE WHEN value <= (SELECT quantile_cont(value, 0.5) FROM events) THEN 'a' ELSE 'b' END AS grp, value AS price FROM events)"""


@query(
    "median_split_tests",
    f"""SELECT 'value' AS "column", (SELECT quantile_cont(value, 0.5) FROM events) AS median, n1::BIGINT AS n_low, n2::BIGINT AS n_high,
 (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)) AS ttest,
 (SELECT u FROM {_mw_sql(_MS, 'grp', 'price', 'a')}) AS mannwhitney, (SELECT d FROM {_ks_sql(_MS, 'grp', 'price', 'a')}) AS ks FROM ({_TG.replace(I.TWO_GROUPS, _MS)})""",
    doubles="median ttest mannwhitney ks",
)
def median_split_tests(t):
    out = hypothesis.median_split_tests(t.events, ["value"])
    return out.select("column", "median", "n_low", "n_high", "ttest", "mannwhitney", "ks")


_PAIRED = f"""(SELECT a.price - b.price AS d FROM (SELECT price, row_number() OVER (ORDER BY o_orderkey) AS i FROM {I.TWO_GROUPS} WHERE grp = 'a') a
 JOIN (SELECT price, row_number() OVER (ORDER BY o_orderkey) AS i FROM {I.TWO_GROUPS} WHERE grp = 'b') b USING (i) WHERE a.price <> b.price)"""


@query(
    "two_sample_battery",
    f"""SELECT 'ttest' AS test, (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)) AS statistic FROM ({_TG})
 UNION ALL SELECT 'mannwhitney', u FROM {_mw_sql(I.TWO_GROUPS, 'grp', 'price', 'a')} UNION ALL SELECT 'ks', d FROM {_ks_sql(I.TWO_GROUPS, 'grp', 'price', 'a')}
 UNION ALL SELECT 'wilcoxon', CASE WHEN (SELECT count(*) FILTER (grp = 'a') = count(*) FILTER (grp = 'b') FROM {I.TWO_GROUPS}) THEN
 least(sum(r) FILTER (d > 0), sum(r) FILTER (d < 0)) END FROM (SELECT d, rank() OVER (ORDER BY abs(d)) + (count(*) OVER (PARTITION BY abs(d)) - 1) / 2.0::DOUBLE AS r FROM {_PAIRED})""",
    doubles="statistic",
)
def two_sample_battery(t):
    return hypothesis.two_sample_battery(I.two_groups(t), "grp", "price", "o_orderkey").select("test", "statistic")


# ---------------------------------------------------------------- lift


def _decile(table, score, n=10):
    cases = " ".join(f"WHEN {score} <= e[{i}] THEN {i - 1}" for i in range(1, n))
    probs = "[" + ", ".join(str(i / n) for i in range(1, n)) + "]"
    return f"(SELECT *, CASE {cases} ELSE {n - 1} END AS decile FROM {table}, (SELECT quantile_cont({score}, {probs}) AS e FROM {table}))"


@query(
    "decile_lift",
    f"""WITH d AS {_decile(I.PRED_ORDERS, 'y_pred')}, g AS (SELECT decile, count(y_true) AS count, round(avg(y_true), 3) AS target_mean, round(stddev_samp(y_true), 3) AS target_std,
 round(min(y_true), 3) AS target_min, round(max(y_true), 3) AS target_max, round(avg(y_pred), 3) AS prediction_mean, round(stddev_samp(y_pred), 3) AS prediction_std,
 round(min(y_pred), 3) AS prediction_min, round(max(y_pred), 3) AS prediction_max FROM d GROUP BY decile)
 SELECT *, target_mean / (SELECT avg(y_true) FROM {I.PRED_ORDERS}) AS lift,
 sum(target_mean / (SELECT avg(y_true) FROM {I.PRED_ORDERS})) OVER (ORDER BY decile) / (decile + 1) AS cumulative_lift FROM g""",
    doubles="target_mean target_std target_min target_max prediction_mean prediction_std prediction_min prediction_max lift cumulative_lift",
)
def decile_lift(t):
    return lift.decile_lift(I.pred_orders(t), "y_true", "y_pred")


@query(
    "gini_lorenz",
    f"""SELECT 1 - 2 * avg(c) / max(s) AS gini, count(*) AS n FROM (SELECT sum(y_true) OVER (ORDER BY y_pred DESC, o_orderkey ROWS UNBOUNDED PRECEDING) AS c, sum(y_true) OVER () AS s FROM {I.PRED_ORDERS})""",
    doubles="gini",
)
def gini_lorenz(t):
    return lift.gini_lorenz(I.pred_orders(t), "y_true", "y_pred", "o_orderkey")


@query(
    "response_lift",
    f"""WITH d AS {_decile(I.SCORE_DOCS, 'score', 4)}, g AS (SELECT decile, count(*) AS total, sum(label)::DOUBLE AS responders FROM d GROUP BY decile)
 SELECT decile, total, responders, responders / total AS response_rate, sum(responders) OVER (ORDER BY decile) AS cumulative_responders,
 sum(responders) OVER (ORDER BY decile) / sum(responders) OVER () AS cumulative_response_rate FROM g""",
    doubles="responders response_rate cumulative_responders cumulative_response_rate",
)
def response_lift(t):
    return lift.response_lift(I.score_docs(t), "label", "score", 4)


@query(
    "lorenz_curve",
    """SELECT row_number() OVER (ORDER BY l_quantity) AS rank, row_number() OVER (ORDER BY l_quantity) / (SELECT count(*) FROM lineitem)::DOUBLE AS population_share,
 sum(l_quantity) OVER (ORDER BY l_quantity ROWS UNBOUNDED PRECEDING) / (SELECT sum(l_quantity) FROM lineitem) AS cumulative_share FROM lineitem
 UNION ALL SELECT 0, 0, 0""",
    doubles="population_share cumulative_share",
)
def lorenz_curve(t):
    return lift.lorenz_curve(t.lineitem, "l_quantity")


# ---------------------------------------------------------------- evaluation


_METRICS = f"""SELECT n, mse, sqrt(mse) AS rmse, mae, 1 - mse / vy AS r2, n * mse / (n - 1) AS emse, 1 - (mse / vy) * (n - 1) / (n - 2) AS adjusted_r2, 1 - ve / vy AS explained_variance FROM
 (SELECT count(*) AS n, avg((y_true - y_pred) * (y_true - y_pred)) AS mse, avg(abs(y_true - y_pred)) AS mae, var_pop(y_true) AS vy, var_pop(y_true - y_pred) AS ve FROM {I.PRED_ORDERS})"""


@query("regression_metrics", _METRICS, doubles="mse rmse mae r2 emse adjusted_r2 explained_variance", digits=4)
def regression_metrics(t):
    return evaluate.regression_metrics(I.pred_orders(t), "y_true", "y_pred")


@query("confusion_matrix", f"SELECT label, pred AS prediction, count(*) AS n FROM {I.SCORE_DOCS} GROUP BY ALL")
def confusion_matrix(t):
    return evaluate.confusion_matrix(I.score_docs(t), "label", "pred")


_PRF = f"""(SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM (SELECT k, hit, support, CASE WHEN said > 0 THEN hit / said ELSE 0 END AS p, hit / support AS r FROM
 (SELECT k, count(*) FILTER (label = k AND pred = k)::DOUBLE AS hit, count(*) FILTER (pred = k)::DOUBLE AS said, count(*) FILTER (label = k) AS support
 FROM {I.SCORE_DOCS}, (VALUES (0), (1)) v(k) GROUP BY k)))"""


@query(
    "classification_report",
    f"""SELECT CAST(k AS VARCHAR) AS class, p AS precision, r AS recall, f AS f1, support FROM {_PRF}
 UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), CAST(sum(support) AS BIGINT) FROM {_PRF}
 UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f * support) / sum(support), CAST(sum(support) AS BIGINT) FROM {_PRF}""",
    doubles="precision recall f1",
)
def classification_report(t):
    return evaluate.classification_report(I.score_docs(t), "label", "pred")


@query(
    "classification_metrics",
    f"""SELECT (SELECT avg(CASE WHEN label = pred THEN 1.0::DOUBLE ELSE 0 END) FROM {I.SCORE_DOCS}) AS accuracy, sum(p * support) / sum(support) AS precision,
 sum(r * support) / sum(support) AS recall, sum(f * support) / sum(support) AS f1 FROM {_PRF}""",
    doubles="accuracy precision recall f1",
)
def classification_metrics(t):
    return evaluate.classification_metrics(I.score_docs(t), "label", "pred")


@query(
    "roc_auc",
    f"""SELECT (sum(r) FILTER (g = 1) - max(np) * (max(np) + 1) / 2) / (max(np) * max(nn)) AS roc_auc FROM {_ranked(I.SCORE_DOCS, 'label', 'score')},
 (SELECT sum(label)::DOUBLE AS np, (count(*) - sum(label))::DOUBLE AS nn FROM {I.SCORE_DOCS})""",
    doubles="roc_auc",
)
def roc_auc(t):
    return evaluate.roc_auc(I.score_docs(t), "label", "score")


@query(
    "roc_curve",
    f"""SELECT NULL::DOUBLE AS threshold, 0 AS fpr, 0 AS tpr UNION ALL SELECT score, sum(n) OVER (ORDER BY score DESC) / sum(n) OVER (), sum(p) OVER (ORDER BY score DESC) / sum(p) OVER () FROM
 (SELECT score, sum(label)::DOUBLE AS p, sum(1 - label)::DOUBLE AS n FROM {I.SCORE_DOCS} GROUP BY score)""",
    doubles="threshold fpr tpr",
)
def roc_curve(t):
    return evaluate.roc_curve(I.score_docs(t), "label", "score")


@query(
    "prediction_correlation",
    f"""SELECT 'prediction' AS "column", corr(y_true, y_pred) AS correlation FROM {I.PRED_ORDERS} UNION ALL SELECT 'x1', corr(x1, y_true - y_pred) FROM {I.PRED_ORDERS}""",
    doubles="correlation",
)
def prediction_correlation(t):
    return evaluate.prediction_correlation(I.pred_orders(t), "y_true", "y_pred", ["x1"])


def _bp(t):
    return f"SELECT lm AS statistic, CASE WHEN lm < 3.841458820694124 THEN 'Homoscedastic' ELSE 'Heteroscedastic' END AS interpretation FROM (SELECT count(*) * pow(corr((y_true - y_pred) * (y_true - y_pred), y_pred), 2) AS lm FROM {t})"


@query("breusch_pagan", _bp(I.PRED_ORDERS) + " UNION ALL " + _bp(I.PRED_ORDERS_SPREADING), doubles="statistic", digits=5)
def breusch_pagan(t):
    flat = evaluate.breusch_pagan(I.pred_orders(t), "y_true", "y_pred")
    return flat.unionByName(evaluate.breusch_pagan(I.pred_orders_spreading(t), "y_true", "y_pred")).drop("p_value")


_DW = f"SELECT sum((e - l) * (e - l)) / sum(e * e) AS statistic FROM (SELECT y_true - y_pred AS e, lag(y_true - y_pred) OVER (ORDER BY o_orderkey) AS l FROM {I.PRED_ORDERS})"


@query("durbin_watson", f"SELECT statistic, CASE WHEN statistic < 1.5 THEN 'Positive autocorrelation' WHEN statistic > 2.5 THEN 'Negative autocorrelation' ELSE 'No significant autocorrelation' END AS interpretation FROM ({_DW})", doubles="statistic")
def durbin_watson(t):
    return evaluate.durbin_watson(I.pred_orders(t), "y_true", "y_pred", "o_orderkey")


@query(
    "acf",
    f"""WITH s AS (SELECT y_true - y_pred - avg(y_true - y_pred) OVER () AS e, row_number() OVER (ORDER BY o_orderkey) AS i FROM {I.PRED_ORDERS})
 SELECT CAST(k AS INT) AS lag, (SELECT sum(a.e * b.e) FROM s a JOIN s b ON b.i = a.i + k) / (SELECT sum(e * e) FROM s) AS autocorrelation FROM range(0, 6) t(k)""",
    doubles="autocorrelation",
)
def acf(t):
    df = I.pred_orders(t).withColumn("residual", F.col("y_true") - F.col("y_pred"))
    return evaluate.acf(df, "residual", "o_orderkey", lags=5)


@query(
    "variance_analysis",
    f"""SELECT var_pop(y_pred) AS prediction_variance, var_pop(y_true - y_pred) AS residual_variance, var_pop(y_true) AS total_variance,
 1 - var_pop(y_true - y_pred) / var_pop(y_true) AS explained_variance_ratio FROM {I.PRED_ORDERS}""",
    doubles="prediction_variance residual_variance total_variance explained_variance_ratio",
    digits=2,
    per_column={"explained_variance_ratio": 6},
)
def variance_analysis(t):
    return evaluate.variance_analysis(I.pred_orders(t), "y_true", "y_pred")


@query(
    "percentile_distribution",
    " UNION ALL ".join(
        f"SELECT '{s}' AS series, 'p{p}' AS percentile, quantile_cont({x}, {p / 100}) AS value FROM {I.PRED_ORDERS}"
        for s, x in [("predictions", "y_pred"), ("residuals", "y_true - y_pred"), ("true_values", "y_true")]
        for p in evaluate.PERCENTS
    ),
    doubles="value",
    digits=5,
)
def percentile_distribution(t):
    return evaluate.percentile_distribution(I.pred_orders(t), "y_true", "y_pred")


@query(
    "residual_outliers",
    f"""SELECT o_orderkey, y_true, y_pred, x1, e AS residual, (e - m) / s AS z FROM (SELECT *, y_true - y_pred AS e FROM {I.PRED_ORDERS}),
 (SELECT avg(y_true - y_pred) AS m, stddev_pop(y_true - y_pred) AS s FROM {I.PRED_ORDERS}) WHERE abs((e - m) / s) > 1.5""",
    doubles="y_true y_pred x1 residual z",
    digits=5,
)
def residual_outliers(t):
    return evaluate.residual_outliers(I.pred_orders(t), "y_true", "y_pred", 1.5)


@query(
    "complete_evaluation",
    f"""SELECT m.*, lm AS bp_statistic, d.statistic AS durbin_watson, med AS median_residual, r AS x1_correlation FROM ({_METRICS}) m,
 (SELECT count(*) * pow(corr((y_true - y_pred) * (y_true - y_pred), y_pred), 2) AS lm, quantile_cont(y_true - y_pred, 0.5) AS med, corr(x1, y_true - y_pred) AS r FROM {I.PRED_ORDERS}), ({_DW}) d""",
    doubles="mse rmse mae r2 emse adjusted_r2 explained_variance bp_statistic durbin_watson median_residual x1_correlation",
    digits=4,
)
def complete_evaluation(t):
    out = evaluate.complete_evaluation(I.pred_orders(t), "y_true", "y_pred", "o_orderkey", ["x1"])
    return out.select(
        "error_metrics.*",
        F.col("homoscedasticity.statistic").alias("bp_statistic"),
        F.col("autocorrelation.statistic").alias("durbin_watson"),
        F.col("percentile_distribution")["residuals"]["p50"].alias("median_residual"),
        F.col("correlation")["x1"].alias("x1_correlation"),
    )


# ---------------------------------------------------------------- chart tables


@query(
    "histogram",
    """WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders), b AS (SELECT unnest(range(0, 30)) AS bin),
 c AS (SELECT least(CAST(floor((o_totalprice - lo) / ((hi - lo) / 30)) AS BIGINT), 29) AS bin, count(*) AS n FROM orders, r GROUP BY 1)
 SELECT 'o_totalprice' AS "column", CAST(b.bin AS INT) AS bin, lo + b.bin * (hi - lo) / 30 AS left, lo + (b.bin + 1) * (hi - lo) / 30 AS right, coalesce(n, 0) AS n FROM b CROSS JOIN r LEFT JOIN c USING (bin)""",
    doubles="left right",
    digits=4,
)
def histogram(t):
    return charts.histogram(t.orders, ["o_totalprice"])


_BOX = "(SELECT o_orderpriority AS g, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS q2, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY 1)"


@query(
    "boxplot_stats",
    f"""SELECT g AS label, count(*) AS n, q1, q2 AS median, q3, min(o_totalprice) FILTER (o_totalprice >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
 max(o_totalprice) FILTER (o_totalprice <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
 count(*) FILTER (o_totalprice < q1 - 1.5 * (q3 - q1) OR o_totalprice > q3 + 1.5 * (q3 - q1)) AS n_outliers FROM orders JOIN {_BOX} ON g = o_orderpriority GROUP BY g, q1, q2, q3""",
    doubles="q1 median q3 whisker_low whisker_high",
    digits=5,
)
def boxplot_stats(t):
    return charts.boxplot_stats(t.orders, "o_totalprice", "o_orderpriority")


@query(
    "kde_grid",
    """WITH s AS (SELECT count(*)::DOUBLE AS n, stddev_samp(value) * pow(count(*), -0.2) AS h, min(value) AS lo, max(value) AS hi FROM events),
 b AS (SELECT floor((value - lo) / (h / 8)) AS b, count(*)::DOUBLE AS c FROM events, s WHERE value IS NOT NULL GROUP BY 1),
 g AS (SELECT lo - 3 * h + i * (hi - lo + 6 * h) / 199 AS x FROM s, range(0, 200) t(i))
 SELECT x, sum(c * exp(-0.5 * pow((x - (lo + (b + 0.5) * (h / 8))) / h, 2))) / (max(n) * max(h) * sqrt(2 * pi())) AS density FROM g, b, s GROUP BY x""",
    doubles="x density",
)
def kde_grid(t):
    return charts.kde_grid(t.events, "value")


@query(
    "ecdf",
    "SELECT l_quantity AS value, sum(count(*)) OVER (ORDER BY l_quantity) / (SELECT count(*) FROM lineitem)::DOUBLE AS share FROM lineitem GROUP BY l_quantity",
    doubles="value share",
)
def ecdf(t):
    return charts.ecdf(t.lineitem, "l_quantity")


@query("frequency_bars", f"SELECT event_type AS value, count(*) AS n FROM {I.EV_NULLS} GROUP BY 1 ORDER BY n DESC, value NULLS LAST LIMIT 4")
def frequency_bars(t):
    return charts.frequency_bars(I.ev_nulls(t), "event_type", 4)


@query(
    "qq_points",
    " UNION ALL ".join(
        f"SELECT {(i + 0.5) / 9!r} AS probability, quantile_cont(y_true - y_pred, {(i + 0.5) / 9!r}) AS sample FROM {I.PRED_ORDERS}" for i in range(9)
    ),
    doubles="probability sample",
    digits=5,
)
def qq_points(t):
    df = I.pred_orders(t).withColumn("residual", F.col("y_true") - F.col("y_pred"))
    return charts.qq_points(df, "residual", 9).drop("theoretical")


@query(
    "lag_points",
    'SELECT * FROM (SELECT o_orderkey AS "order", lag(o_totalprice) OVER (ORDER BY o_orderkey) AS previous, o_totalprice AS value FROM orders) WHERE previous IS NOT NULL',
    doubles="previous value",
)
def lag_points(t):
    return charts.lag_points(t.orders, "o_totalprice", "o_orderkey")


@query(
    "residual_order",
    f"SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS position, y_true - y_pred AS residual FROM {I.PRED_ORDERS}",
    doubles="residual",
    digits=5,
)
def residual_order(t):
    return charts.residual_order(I.pred_orders(t), "y_true", "y_pred", "o_orderkey")


@query(
    "scatter_sample",
    f"SELECT o_orderkey, y_pred AS x, y_true AS y FROM {I.PRED_ORDERS} WHERE {hu('o_orderkey', '42')} < 0.1",
    doubles="x y",
    digits=5,
)
def scatter_sample(t):
    return charts.scatter_sample(I.pred_orders(t), "y_pred", "y_true", "o_orderkey", 0.1)


@query(
    "fit_line",
    "SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept, regr_r2(l_extendedprice, l_quantity) AS r2 FROM lineitem",
    doubles="slope intercept r2",
)
def fit_line(t):
    return charts.fit_line(t.lineitem, "l_quantity", "l_extendedprice")


@query("heatmap", _corr_sql([(a, b) for i, a in enumerate(_CHARGE) for b in _CHARGE[:i]], I.LI_CHARGE), doubles="correlation")
def heatmap(t):
    return charts.heatmap(I.li_charge(t))


@query("monthly_counts", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1")
def monthly_counts(t):
    return explore.monthly_counts(t.orders, "o_orderdate")
