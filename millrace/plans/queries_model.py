"""Queries for feature selection, models, tuning and whole runs."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.columns import local_rows
from ..functions.lineage import shared_folder, spread_out
from ..operators import encode, models, select, split, tuning
from ..sources import sinks
from . import inputs as I
from . import workflow
from .queries_explore import _anova_sql
from .queries_prepare import hu, pca2_sql
from .registry import query

LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def keyed_charge(t):
    """lineitem with its charge and a key made of the whole row (rows are distinct)."""
    df = t.lineitem
    key = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in df.columns]))
    return df.select(
        key.alias("row_key"), *LI, (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("charge")
    )


def part_y(t):
    return t.part.selectExpr("p_partkey", "CAST(p_size AS DOUBLE) AS p_size", "p_retailprice", "CAST(p_partkey AS DOUBLE) AS serial")


# ---------------------------------------------------------------- selection


def _f(c, y, t):
    return f"SELECT '{c}' AS feature, corr({c}, {y}) * corr({c}, {y}) / (1 - corr({c}, {y}) * corr({c}, {y})) * (count(*) - 2) AS score FROM {t}"


def _topk(parts, k):
    return f"SELECT feature, score, row_number() OVER (ORDER BY score DESC, feature) <= {k} AS selected FROM ({' UNION ALL '.join(parts)})"


def _scores(sel, t):
    return sel.table(t.spark).select("feature", "score", "selected")


@query("kbest_f_regression", _topk([_f(c, "charge", I.LI_CHARGE) for c in LI], 2), doubles="score", per_column={"score": 3})
def kbest_f_regression(t):
    return _scores(select.kbest(I.li_charge(t), "charge", 2), t)


@query(
    "kbest_f_classif",
    _topk([f"SELECT '{c}' AS feature, f AS score FROM {_anova_sql('lineitem', 'l_returnflag', c)}" for c in LI], 2),
    doubles="score",
)
def kbest_f_classif(t):
    return _scores(select.kbest(t.lineitem, "l_returnflag", 2, "f_classif", LI), t)


def _chi(c):
    return f"""SELECT '{c}' AS feature, sum((o - e) * (o - e) / e) AS score FROM (SELECT sum({c}) AS o, count(*)::DOUBLE / (SELECT count(*) FROM lineitem) * (SELECT sum({c}) FROM lineitem) AS e
 FROM lineitem GROUP BY l_returnflag)"""


@query("kbest_chi2", _topk([_chi(c) for c in LI], 2), doubles="score", digits=4)
def kbest_chi2(t):
    return _scores(select.kbest(t.lineitem, "l_returnflag", 2, "chi2", LI), t)


def _mi(c, edges):
    case = " ".join(f"WHEN {c} <= e[{i}] THEN {i}" for i in range(1, edges)) + f" ELSE {edges}"
    probs = ", ".join(str(i / edges) for i in range(1, edges))
    cells = f"(SELECT x, l_returnflag AS y, count(*)::DOUBLE AS n FROM (SELECT l_returnflag, CASE {case} END AS x FROM lineitem, (SELECT quantile_cont({c}, [{probs}]) AS e FROM lineitem)) GROUP BY ALL)"
    return f"SELECT '{c}' AS feature, greatest(sum(t), 0) AS score FROM (SELECT n / sum(n) OVER () * ln(n * sum(n) OVER () / (sum(n) OVER (PARTITION BY x) * sum(n) OVER (PARTITION BY y))) AS t FROM {cells})"


@query("kbest_mutual_info", _topk([_mi(c, 5) for c in LI], 1), doubles="score", digits=8)
def kbest_mutual_info(t):
    return _scores(select.kbest(t.lineitem, "l_returnflag", 1, "mutual_info", LI, bins=5), t)


@query(
    "variance_threshold",
    "SELECT feature, score, score > 0.01 AS selected FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, var_pop({c}) AS score FROM lineitem" for c in LI) + ")",
    doubles="score",
    digits=3,
)
def variance_threshold(t):
    return _scores(select.variance_threshold(t.lineitem, 0.01, LI), t)


@query("lasso_select")
def lasso_select(t):
    return select.lasso_select(I.li_charge(t), "charge", alpha=100.0).table(t.spark)


@query("ridge_select")
def ridge_select(t):
    return select.ridge_select(I.li_charge(t), "charge").table(t.spark)


@query("rfe")
def rfe(t):
    from pyspark.ml.regression import RandomForestRegressor

    return select.rfe(I.li_charge(t), "charge", 2, estimator=RandomForestRegressor(numTrees=10, maxDepth=5, seed=42)).table(t.spark)


@query("forest_select")
def forest_select(t):
    return select.forest_select(I.li_charge(t), "charge", n_estimators=20, max_depth=5).table(t.spark)


@query("model_select")
def model_select(t):
    return select.model_select(I.li_charge(t), "charge", n_estimators=5, max_depth=3).table(t.spark)


_G = "(SELECT sum(p_size * p_size)::DOUBLE AS a, sum(p_retailprice * p_retailprice) AS b, sum(p_size * p_retailprice) AS c FROM part)"


@query(
    "vif_scores",
    f"SELECT 'p_size' AS feature, a * b / (a * b - c * c) AS vif FROM {_G} UNION ALL SELECT 'p_retailprice', a * b / (a * b - c * c) FROM {_G}",
    doubles="vif",
)
def vif_scores(t):
    got = select.vif_scores(t.part, ["p_size", "p_retailprice"])
    return local_rows(t.spark, list(got.items()), "feature string, vif double")


@query(
    "vif_select",
    f"SELECT feature, vif AS score, NOT (vif > 3 AND feature = 'p_size') AS selected FROM (SELECT 'p_size' AS feature, a * b / (a * b - c * c) AS vif FROM {_G} UNION ALL SELECT 'p_retailprice', a * b / (a * b - c * c) FROM {_G})",
    doubles="score",
)
def vif_select(t):
    return _scores(select.vif_select(t.part, 3.0, features=["p_size", "p_retailprice"]), t)


@query(
    "knn_score_select",
    """WITH d AS (SELECT p_partkey AS k, p_size::DOUBLE AS x, p_retailprice AS y FROM part), v AS (SELECT DISTINCT x FROM d),
 head AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY x ORDER BY k) AS r FROM d) WHERE r <= 5),
 p AS (SELECT x, avg(y) AS p FROM (SELECT v.x, h.y, row_number() OVER (PARTITION BY v.x ORDER BY abs(h.x - v.x), h.k) AS r FROM v, head h) WHERE r <= 5 GROUP BY x)
 SELECT 'p_size' AS feature, 1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)) AS score, true AS selected FROM d JOIN p USING (x)""",
    doubles="score",
)
def knn_score_select(t):
    return _scores(select.knn_score_select(t.part, "p_retailprice", "p_partkey", features=["p_size"]), t)


@query(
    "selection_summary",
    f"""SELECT 'kbest_f_regression' AS method, feature, score, score >= max(score) OVER () AS selected FROM ({_f('p_size', 'p_retailprice', 'part')} UNION ALL {_f('p_partkey', 'p_retailprice', 'part')})
 UNION ALL SELECT 'vif', f, a * b / (a * b - c * c), a * b / (a * b - c * c) <= 3 OR f = 'p_partkey' FROM (SELECT sum(p_size * p_size)::DOUBLE AS a, sum(p_partkey * p_partkey)::DOUBLE AS b, sum(p_size * p_partkey)::DOUBLE AS c FROM part), (VALUES ('p_size'), ('p_partkey')) v(f)""",
    doubles="score",
)
def selection_summary(t):
    df, feats = t.part, ["p_size", "p_partkey"]
    best = select.kbest(df, "p_retailprice", 1, features=feats)
    return select.selection_summary(t.spark, best, select.vif_select(df, 3.0, features=feats)).drop("p_value")


@query(
    "apply_selection",
    "SELECT l_extendedprice, charge FROM " + I.LI_CHARGE,
    doubles="l_extendedprice charge",
)
def apply_selection(t):
    df = I.li_charge(t)
    return select.kbest(df, "charge", 1).apply(df, "charge")


# ---------------------------------------------------------------- models with a closed form

_S = """(SELECT count(*)::DOUBLE AS n, avg(l_quantity) AS mx, avg(charge) AS my, var_pop(l_quantity) AS vx, covar_pop(l_quantity, charge) AS cxy FROM """ + I.LI_CHARGE + ")"


def _line(slope):
    return f"SELECT '(intercept)' AS term, my - s * mx AS coefficient FROM (SELECT *, {slope} AS s FROM {_S}) UNION ALL SELECT 'l_quantity', s FROM (SELECT *, {slope} AS s FROM {_S})"


def _one_feature(t, name, params=None):
    df = I.li_charge(t)
    return models.coefficients(models.fit_model(df, ["l_quantity"], "charge", name, params), ["l_quantity"], t.spark)


@query("linear", _line("cxy / vx"), doubles="coefficient", digits=3)
def linear(t):
    return _one_feature(t, "linear")


_C2 = """(SELECT covar_pop(l_quantity, charge) AS c1, covar_pop(l_tax, charge) AS c2, var_pop(l_quantity) AS v1, var_pop(l_tax) AS v2, covar_pop(l_quantity, l_tax) AS v12,
 avg(l_quantity) AS m1, avg(l_tax) AS m2, avg(charge) AS my FROM """ + I.LI_CHARGE + ")"
_B2 = f"(SELECT *, (c1 * v2 - c2 * v12) / (v1 * v2 - v12 * v12) AS b1, (c2 * v1 - c1 * v12) / (v1 * v2 - v12 * v12) AS b2 FROM {_C2})"


@query(
    "linear_two_features",
    f"SELECT '(intercept)' AS term, my - b1 * m1 - b2 * m2 AS coefficient FROM {_B2} UNION ALL SELECT 'l_quantity', b1 FROM {_B2} UNION ALL SELECT 'l_tax', b2 FROM {_B2}",
    doubles="coefficient",
    digits=3,
)
def linear_two_features(t):
    feats = ["l_quantity", "l_tax"]
    return models.coefficients(models.fit_model(I.li_charge(t), feats, "charge", "linear"), feats, t.spark)


@query("ridge", _line("cxy * n / (vx * n + 1000)"), doubles="coefficient", digits=2)
def ridge(t):
    return _one_feature(t, "ridge", {"alpha": 1000.0})


@query("lasso", _line("sign(cxy) * greatest(abs(cxy) - 100, 0) / vx"), doubles="coefficient", digits=2)
def lasso(t):
    return _one_feature(t, "lasso", {"alpha": 100.0})


@query("elastic_net", _line("sign(cxy) * greatest(abs(cxy) - 50, 0) / (vx + 50)"), doubles="coefficient", digits=2)
def elastic_net(t):
    return _one_feature(t, "elastic_net", {"alpha": 100.0, "l1_ratio": 0.5})


@query(
    "logistic",
    """WITH s AS (SELECT avg(CAST(value > 20 AS INT)) FILTER (event_type <> 'click') AS p0, avg(CAST(value > 20 AS INT)) FILTER (event_type = 'click') AS p1 FROM events)
 SELECT '(intercept)' AS term, ln(p0 / (1 - p0)) AS coefficient FROM s UNION ALL SELECT 'flag', ln(p1 / (1 - p1)) - ln(p0 / (1 - p0)) FROM s""",
    doubles="coefficient",
    digits=3,
)
def logistic(t):
    df = t.events.selectExpr("CAST(event_type = 'click' AS DOUBLE) AS flag", "CAST(value > 20 AS INT) AS label")
    model = models.fit_model(df, ["flag"], "label", "logistic", {"penalty": "none", "tol": 1e-10}, "classification")
    return models.coefficients(model, ["flag"], t.spark)


# ---------------------------------------------------------------- models checked by quality


def _reg(t, name, **params):
    raw = spread_out(t.lineitem)
    df = raw.select(
        F.xxhash64(*raw.columns).alias("row_key"),
        *LI,
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("charge"),
    )
    train, test = split.parts(split.split_random(df, "row_key", 0.3))
    model = models.fit_model(train, LI, "charge", name, params, key="row_key")
    return models.predict(model, test).select("row_key", "charge", "prediction")


def _cls(t, name, **params):
    df = I.vectors(t).withColumn("target", (F.col("label") < 5).cast("int"))
    feats = [f"e{i}" for i in range(64)]
    model = models.fit_model(df, feats, "target", name, params, "classification", "vec_id")
    return models.predict(model, df).select("vec_id", "target", "prediction")


@query("random_forest_reg")
def random_forest_reg(t):
    return _reg(t, "random_forest", n_estimators=10, max_depth=5)


@query("random_forest_cls")
def random_forest_cls(t):
    return _cls(t, "random_forest", n_estimators=10, max_depth=5)


@query("gbt_reg")
def gbt_reg(t):
    return _reg(t, "xgboost", n_estimators=5, max_depth=3, learning_rate=0.3)


@query("gbt_cls")
def gbt_cls(t):
    return _cls(t, "lightgbm", n_estimators=5, max_depth=3)


@query("gbt_early_stopping", "SELECT count(*) AS n, count(*) AS n_right, TRUE AS stopped FROM lineitem")
def gbt_early_stopping(t):
    rows = t.lineitem.select(F.col("l_quantity").cast("double").alias("q"), F.when(F.col("l_quantity") > 25, 10.0).otherwise(0.0).alias("y"))
    model = models.fit_model(rows, ["q"], "y", "gbt", {"n_estimators": 20, "max_depth": 2, "max_bins": 64, "n_iter_no_change": 5})
    right = F.count_if(F.abs(F.col("prediction") - F.col("y")) < 1e-6)
    stopped = F.lit(model.stages[-1].getNumTrees < 20)
    return models.predict(model, rows).agg(F.count("*").alias("n"), right.alias("n_right")).withColumn("stopped", stopped)


@query("adaboost_reg")
def adaboost_reg(t):
    return _reg(t, "adaboost", n_estimators=3, loss="linear")


@query("adaboost_cls")
def adaboost_cls(t):
    return _cls(t, "adaboost", n_estimators=3)


@query("bagging_reg")
def bagging_reg(t):
    return _reg(t, "bagging", n_estimators=3, max_features=0.7, max_depth=6)


@query("bagging_cls")
def bagging_cls(t):
    return _cls(t, "bagging", n_estimators=3, max_depth=5)


@query("linear_svc")
def linear_svc(t):
    return _cls(t, "linear_svc", C=1.0, max_iter=30)


@query("rbf_regression")
def rbf_regression(t):
    return _reg(t, "svr", width=16, max_iter=20)


@query("kmeans")
def kmeans(t):
    return models.cluster_labels(I.vectors(t), [f"e{i}" for i in range(64)], 5, 42, "cluster").select("vec_id", "cluster")


@query("split_cluster")
def split_cluster(t):
    df = t.part.select("p_partkey", "p_size", "p_retailprice")
    return split.split_cluster(df, "p_partkey", "p_retailprice").select("p_partkey", "split")


@query(
    "score_model",
    "SELECT p_partkey, a + b * p_size AS prediction FROM part, (SELECT regr_slope(p_retailprice, p_size) AS b, regr_intercept(p_retailprice, p_size) AS a FROM part)",
    doubles="prediction",
    digits=5,
)
def score_model(t):
    model = models.fit_model(part_y(t), ["p_size"], "p_retailprice", "linear")
    return models.predict(model, part_y(t)).select("p_partkey", "prediction")


# ---------------------------------------------------------------- tuning


def part_model(t):
    return part_y(t), ["p_size", "serial"], "p_retailprice"


# fold number, feature and target of every part, folds as the hash split makes them
def _folds(k, y="p_retailprice"):
    return f"""(SELECT p_partkey, CAST(p_size AS DOUBLE) AS x, {y} AS y, CAST((SELECT min(i) FROM range(0, {k}) t(i) WHERE r <= (n // {k}) * (i + 1) + least(i + 1, n % {k})) AS INT) AS fold
 FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || CAST(p_partkey AS VARCHAR))) AS r, count(*) OVER () AS n FROM part))"""


def _soft(alpha):
    return f"sign(covar_pop(y, x)) * greatest(abs(covar_pop(y, x)) - {alpha}, 0) / var_pop(x)"


def _fold_mse(alpha, k):
    """Validation MSE per fold of the one-feature lasso."""
    return f"""(SELECT f.fold, avg((y - my - b * (x - mx)) * (y - my - b * (x - mx))) AS mse FROM {_folds(k)} f
 JOIN (SELECT k AS fold, avg(x) AS mx, avg(y) AS my, {_soft(alpha)} AS b FROM {_folds(k)}, range(0, {k}) t(k) WHERE fold <> k GROUP BY k) m ON m.fold = f.fold GROUP BY f.fold)"""


@query(
    "grid_search",
    f"""SELECT CAST(row_number() OVER (ORDER BY score) AS INT) AS rank, alpha, score FROM (SELECT '0.1' AS alpha, avg(mse) AS score FROM {_fold_mse(0.1, 3)}
 UNION ALL SELECT '10.0', avg(mse) FROM {_fold_mse(10.0, 3)} UNION ALL SELECT '50.0', avg(mse) FROM {_fold_mse(50.0, 3)})""",
    doubles="score",
    digits=2,
)
def grid_search(t):
    got = tuning.grid_search(part_y(t), ["p_size"], "p_retailprice", "lasso", {"alpha": [0.1, 10.0, 50.0]}, cv=3, key="p_partkey")
    return got.table.select("rank", F.col("params")["alpha"].alias("alpha"), "score")


@query("random_search")
def random_search(t):
    df, feats, y = part_model(t)
    space = {"max_depth": ("int", 2, 5), "n_estimators": [3, 5]}
    return tuning.random_search(df, feats, y, "random_forest", space, 2, cv=2, key="p_partkey").table


@query("narrowed_search")
def narrowed_search(t):
    df, feats, y = part_model(t)
    space = {"max_depth": ("int", 2, 4), "learning_rate": ("uniform", 0.05, 0.2), "n_estimators": [3]}
    first = tuning.random_search(df, feats, y, "xgboost", space, 2, cv=2, key="p_partkey", refit=False)
    grid = {k: v[-2:] if k != "n_estimators" else [3] for k, v in tuning.narrowed_grid(first.best_params).items()}
    return tuning.grid_search(df, feats, y, "xgboost", grid, cv=2, key="p_partkey", refit=False).table


@query("joint_search")
def joint_search(t):
    df, feats, y = part_model(t)
    return tuning.joint_search(df, feats, y, "random_forest", [1, 2], {"max_depth": [2, 4]}, cv=2, key="p_partkey").table


@query(
    "cv_evaluate",
    f"""WITH r AS (SELECT CAST(p_size AS DOUBLE) AS x, p_retailprice AS y, row_number() OVER (ORDER BY md5('42:' || CAST(p_partkey AS VARCHAR))) AS r, count(*) OVER () AS n FROM part),
 f AS (SELECT x, y, CAST((SELECT min(i) FROM range(0, 3) t(i) WHERE r <= (n // 3) * (i + 1) + least(i + 1, n % 3)) AS INT) AS fold FROM r),
 m AS (SELECT k AS fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM f, range(0, 3) t(k) WHERE fold <> k GROUP BY k),
 e AS (SELECT f.fold, avg((y - a - b * x) * (y - a - b * x)) AS mse, avg(abs(y - a - b * x)) AS mae, var_pop(y) AS vy, var_pop(y - a - b * x) AS ve FROM f JOIN m USING (fold) GROUP BY f.fold),
 q AS (SELECT CAST(fold AS VARCHAR) AS fold, mse, sqrt(mse) AS rmse, mae, 1 - mse / vy AS r2, 1 - ve / vy AS explained_variance FROM e)
 SELECT * FROM q UNION ALL SELECT 'mean', avg(mse), avg(rmse), avg(mae), avg(r2), avg(explained_variance) FROM q
 UNION ALL SELECT 'std', stddev_pop(mse), stddev_pop(rmse), stddev_pop(mae), stddev_pop(r2), stddev_pop(explained_variance) FROM q""",
    doubles="mse rmse mae r2 explained_variance",
    digits=5,
)
def cv_evaluate(t):
    return tuning.cv_evaluate(part_y(t), ["p_size"], "p_retailprice", "linear", cv=3, key="p_partkey")


_CURVE = """(SELECT f.fold AS fold, side, avg((y - a - b * x) * (y - a - b * x)) AS mse FROM
 (SELECT k AS fold, x, y, CASE WHEN fold = k THEN 'validation' ELSE 'train' END AS side, u FROM {folds}, range(0, {k}) t(k)) f
 JOIN (SELECT k AS fold, {b} AS b, avg(y) - ({b}) * avg(x) AS a FROM {folds}, range(0, {k}) t(k) WHERE fold <> k AND u < {share} GROUP BY k) m ON m.fold = f.fold
 WHERE side = 'validation' OR u < {share} GROUP BY f.fold, side)"""


def _curve_row(label, value, b, share, k=2):
    folds = f"(SELECT *, {hu('p_partkey', '42sample')} AS u FROM {_folds(k)})"
    body = _CURVE.format(folds=folds, k=k, b=b, share=share)
    return f"""SELECT {value} AS {label}, avg(mse) FILTER (side = 'train') AS train_mse, stddev_pop(mse) FILTER (side = 'train') AS train_std,
 avg(mse) FILTER (side = 'validation') AS validation_mse, stddev_pop(mse) FILTER (side = 'validation') AS validation_std FROM {body}"""


@query(
    "learning_curve",
    _curve_row("train_share", "0.3::DOUBLE", "regr_slope(y, x)", 0.3) + " UNION ALL " + _curve_row("train_share", "1.0::DOUBLE", "regr_slope(y, x)", 2),
    doubles="train_mse train_std validation_mse validation_std",
    digits=4,
)
def learning_curve(t):
    return tuning.learning_curve(part_y(t), ["p_size"], "p_retailprice", "linear", "p_partkey", sizes=[0.3, 1.0], cv=2)


@query(
    "validation_curve",
    _curve_row("alpha", "0.1::DOUBLE", _soft(0.1), 2) + " UNION ALL " + _curve_row("alpha", "20.0::DOUBLE", _soft(20.0), 2),
    doubles="train_mse train_std validation_mse validation_std",
    digits=2,
)
def validation_curve(t):
    return tuning.validation_curve(part_y(t), ["p_size"], "p_retailprice", "lasso", "p_partkey", "alpha", [0.1, 20.0], cv=2)


_POISSON = [0.36787944117144233 * sum(1 / math.factorial(j) for j in range(k + 1)) for k in range(8)]
_SIDES = """(SELECT p_partkey, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y, row_number() OVER (ORDER BY md5('42:' || CAST(p_partkey AS VARCHAR))) <= ceil(0.2::DOUBLE * count(*) OVER ()) AS test FROM part)"""


def _boot(b):
    u = hu("p_partkey", f"42boot{b}")
    copies = " + ".join(f"CAST({u} >= {c!r} AS INT)" for c in _POISSON)
    return f"""SELECT {b} AS b, (sum(w * x * y) - sum(w * x) * sum(w * y) / sum(w)) / (sum(w * x * x) - sum(w * x) * sum(w * x) / sum(w)) AS s, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my
 FROM (SELECT x, y, ({copies})::DOUBLE AS w FROM {_SIDES} WHERE NOT test)"""


@query(
    "bias_variance",
    f"""WITH p AS (SELECT p_partkey, y, my + s * (x - mx) AS p FROM {_SIDES}, ({" UNION ALL ".join(_boot(b) for b in range(3))}) WHERE test),
 g AS (SELECT p_partkey, max(y) AS y, avg(p) AS m, var_pop(p) AS v FROM p GROUP BY 1)
 SELECT avg((y - m) * (y - m)) AS bias, avg(v) AS variance, avg((y - m) * (y - m)) + avg(v) AS total_error FROM g""",
    doubles="bias variance total_error",
    digits=4,
)
def bias_variance(t):
    return tuning.bias_variance(part_y(t), ["p_size"], "p_retailprice", "linear", "p_partkey", n_iterations=3)


_SIDES3 = _SIDES.replace("0.2::DOUBLE", "0.3::DOUBLE")


def _compared(name, b):
    return f"""SELECT '{name}' AS model, 1 - avg(e * e) / var_pop(y) AS r2, avg(e * e) AS mse, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, 1 - var_pop(e) / var_pop(y) AS explained_variance
 FROM (SELECT y, y - my - b * (x - mx) AS e FROM {_SIDES3}, (SELECT avg(x) AS mx, avg(y) AS my, {b} AS b FROM {_SIDES3} WHERE NOT test) WHERE test)"""


@query(
    "model_compare",
    _compared("linear", "regr_slope(y, x)") + " UNION ALL " + _compared("lasso", _soft(20.0)) + " UNION ALL SELECT 'no_such_model', NULL, NULL, NULL, NULL, NULL",
    doubles="r2 mse rmse mae explained_variance",
    digits=3,
    per_column={"r2": 6, "explained_variance": 6},
)
def model_compare(t):
    train, test = split.parts(split.split_random(part_y(t), "p_partkey", 0.3))
    candidates = {"linear": None, "lasso": {"alpha": 20.0}, "no_such_model": None}
    return tuning.model_compare(train, test, ["p_size"], "p_retailprice", candidates, "p_partkey").drop("error")


@query("feature_importance")
def feature_importance(t):
    df = I.li_charge(t)
    model = models.fit_model(df, LI, "charge", "random_forest", {"n_estimators": 10, "max_depth": 4})
    return models.feature_importance(model, LI, t.spark, 3)


def _shuffled(r):
    return f"""SELECT (avg((y - a - b * px) * (y - a - b * px)) - avg((y - a - b * x) * (y - a - b * x))) / var_pop(y) AS d FROM
 (SELECT x, y, coalesce(lag(x) OVER (ORDER BY h), last_value(x) OVER (ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS px FROM
 (SELECT CAST(p_size AS DOUBLE) AS x, p_retailprice AS y, md5('42shuffle{r}:' || CAST(p_partkey AS VARCHAR)) AS h FROM part)),
 (SELECT regr_slope(p_retailprice, p_size) AS b, regr_intercept(p_retailprice, p_size) AS a FROM part)"""


@query(
    "permutation_importance",
    f"SELECT 'p_size' AS feature, avg(d) AS importance, stddev_pop(d) AS std FROM ({_shuffled(0)} UNION ALL {_shuffled(1)})",
    doubles="importance std",
    digits=8,
)
def permutation_importance(t):
    df = part_y(t)
    model = models.fit_model(df, ["p_size"], "p_retailprice", "linear")
    return tuning.permutation_importance(model, df, ["p_size"], "p_retailprice", "p_partkey", n_repeats=2)


# ---------------------------------------------------------------- whole runs


@query(
    "run_eda",
    "SELECT 'p_size' AS column_1, 'p_retailprice' AS column_2, 'pearson' AS method, corr(p_size, p_retailprice) AS correlation FROM part",
    doubles="correlation",
)
def run_eda(t):
    pairs = workflow.run_eda(t.part.select("p_size", "p_retailprice", "p_brand"))["pairs"]
    return pairs.where("method = 'pearson'").drop("p_value", "n")


@query(
    "preprocess",
    f"""WITH f AS (SELECT event_id, coalesce(value, (SELECT CASE WHEN abs(skewness(value)) > 1 THEN quantile_cont(value, 0.5) ELSE avg(value) END FROM {I.EV_NULLS})) AS value,
 coalesce(CAST(score AS DOUBLE), (SELECT CASE WHEN abs(skewness(score)) > 1 THEN quantile_cont(score, 0.5) ELSE avg(score) END FROM {I.EV_NULLS})) AS score FROM {I.EV_NULLS})
 SELECT event_id, (value - avg(value) OVER ()) / stddev_pop(value) OVER () AS value, (score - avg(score) OVER ()) / stddev_pop(score) OVER () AS score FROM f""",
    doubles="value score",
)
def preprocess(t):
    df = I.ev_nulls(t).select("event_id", "value", "score")
    return workflow.fit_preprocessor(df, exclude=["event_id"]).transform(df)


FEATURES = {
    "derived_features": {"operations": [{"name": "unit_price", "columns": ["l_extendedprice", "l_quantity"], "operation": "ratio"}]},
    "interactions": {"feature_pairs": [["l_quantity", "l_tax"]]},
    "pca": {"n_components": 2, "columns": ["l_quantity", "l_tax"]},
    "polynomial": {"degree": 2},
}
_PC = pca2_sql("l_quantity", "l_tax", I.LI_CHARGE)


@query(
    "engineer",
    f"""SELECT l_quantity, l_extendedprice, l_discount, l_tax, charge, l_extendedprice / l_quantity AS unit_price, l_quantity * l_tax AS l_quantity_multiplication_l_tax, pca_component_1, pca_component_2,
 l_quantity * l_quantity AS "poly_l_quantity^2", l_quantity * l_extendedprice AS "poly_l_quantity l_extendedprice", l_extendedprice * l_extendedprice AS "poly_l_extendedprice^2" FROM {_PC}""",
    doubles=["l_quantity", "l_extendedprice", "l_discount", "l_tax", "charge", "unit_price", "l_quantity_multiplication_l_tax", "pca_component_1", "pca_component_2",
             "poly_l_quantity^2", "poly_l_quantity l_extendedprice", "poly_l_extendedprice^2"],
    per_column={"poly_l_extendedprice^2": 4},
    digits=7,
)
def engineer_run(t):
    df = I.li_charge(t)
    return workflow.fit_features(df, FEATURES, exclude=["charge"]).transform(df)


@query("select_features")
def select_features(t):
    df = I.li_charge(t)
    return select.selection_summary(
        t.spark,
        select.select_features(df, "charge", "k_best", k=2),
        select.select_features(df, "charge", "lasso", alpha=100.0),
        select.select_features(df, "charge", "vif", threshold=5.0),
    )


_ROW = "md5(concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *LI, "l_returnflag", "l_linestatus", "l_shipdate"]) + "))"
_CHARGED = f"""(SELECT l_extendedprice AS x, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS y, row_number() OVER (ORDER BY md5('42:' || {_ROW})) <= ceil(0.2::DOUBLE * count(*) OVER ()) AS test FROM lineitem)"""


def _side(name, cond):
    return f"""(SELECT 1 - avg(e * e) / var_pop(y) AS {name}_r2, avg(e * e) AS {name}_mse, avg(abs(e)) AS {name}_mae, 1 - var_pop(e) / var_pop(y) AS {name}_explained_variance
 FROM (SELECT y, y - a - b * x AS e FROM {_CHARGED}, (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM {_CHARGED} WHERE NOT test) WHERE {cond}))"""


@query(
    "regression_run",
    f"SELECT 'linear' AS model, * FROM {_side('train', 'NOT test')}, {_side('test', 'test')}",
    doubles="train_r2 train_mse train_mae train_explained_variance test_r2 test_mse test_mae test_explained_variance",
    digits=2,
    per_column={c: 7 for c in ("train_r2", "test_r2", "train_explained_variance", "test_explained_variance")},
)
def regression_run(t):
    df = keyed_charge(t)
    run = workflow.regression_run(df, "charge", "row_key", "linear", selection="k_best", selection_params={"k": 1})
    return run.results.drop("params", "run_id")


@query("classification_run")
def classification_run(t):
    df = I.score_docs(t).select("doc_id", "lang", "source", "score", F.length("lang").alias("lang_len"), "label")
    _, _, report = workflow.classification_run(df, "label", "doc_id", "random_forest", {"n_estimators": 5, "max_depth": 4}, imbalance="random_under")
    return report


_FIT = """(SELECT 1 - avg(e * e) / var_pop(y) AS r2, avg(e * e) AS mse, avg(abs(e)) AS mae, 1 - var_pop(e) / var_pop(y) AS explained_variance FROM
 (SELECT p_retailprice AS y, p_retailprice - a - b * p_size AS e FROM part, (SELECT regr_slope(p_retailprice, p_size) AS b, regr_intercept(p_retailprice, p_size) AS a FROM part)))"""


def _size_metrics(t):
    model = models.fit_model(part_y(t), ["p_size"], "p_retailprice", "linear")
    return workflow._metrics(models.predict(model, part_y(t)), "p_retailprice")


@query(
    "results_table",
    f"""SELECT 'r1' AS run_id, 'linear' AS model, r2 AS train_r2, mse AS train_mse, mae AS train_mae, explained_variance AS train_explained_variance,
 r2 AS test_r2, mse AS test_mse, mae AS test_mae, explained_variance AS test_explained_variance, 'True' AS param_fit_intercept FROM {_FIT}""",
    doubles="train_r2 train_mse train_mae train_explained_variance test_r2 test_mse test_mae test_explained_variance",
    digits=4,
)
def results_table(t):
    m = _size_metrics(t)
    rows = {"linear": {"train": m, "test": m, "params": {"fit_intercept": True}}}
    return sinks.wide_params(sinks.results_table(t.spark, "r1", rows))


@query(
    "metrics_report",
    f"SELECT 'r1' AS run_id, 'linear' AS model, metric, value FROM (SELECT r2, mse, mae, explained_variance FROM {_FIT}) UNPIVOT (value FOR metric IN (r2, mse, mae, explained_variance))",
    doubles="value",
    digits=4,
)
def metrics_report(t):
    return sinks.metrics_report(t.spark, "r1", {"linear": _size_metrics(t)}).drop("line")


@query(
    "evaluation_json",
    f"SELECT mse, r2, adjusted FROM (SELECT mse, r2, 1 - (1 - r2) * (n - 1) / (n - 2) AS adjusted FROM {_FIT}, (SELECT count(*)::DOUBLE AS n FROM part))",
    doubles="mse r2 adjusted",
    digits=4,
)
def evaluation_json(t):
    from ..operators import evaluate

    model = models.fit_model(part_y(t), ["p_size"], "p_retailprice", "linear")
    scored = models.predict(model, part_y(t))
    text = evaluate.complete_evaluation(scored, "p_retailprice", "prediction", "p_partkey").select(F.to_json(F.struct("*")).alias("value"))

    def pick(path):
        return F.get_json_object("value", path).cast("double")

    return text.select(
        pick("$.error_metrics.mse").alias("mse"), pick("$.error_metrics.r2").alias("r2"), pick("$.error_metrics.adjusted_r2").alias("adjusted")
    )


# ---------------------------------------------------------------- saved models and run records

_FIT = "(SELECT *, my - cxy / vx * mx AS b0, cxy / vx AS b1 FROM " + _S + ")"


def _saved_line(t) -> str:
    """Path of a saved regression of charge on quantity."""
    path = shared_folder(t.spark)
    models.save_model(models.fit_model(I.li_charge(t), ["l_quantity"], "charge", "linear"), path)
    return path


@query(
    "model_save_load",
    f"""SELECT l_quantity, count(*) AS n, avg(b0 + b1 * l_quantity) AS prediction
 FROM {I.LI_CHARGE} AS x, {_FIT} AS f GROUP BY l_quantity""",
    doubles="prediction",
    digits=3,
)
def model_save_load(t):
    scored = models.predict(models.load_model(_saved_line(t)), I.li_charge(t))
    return scored.groupBy("l_quantity").agg(F.count("*").alias("n"), F.avg("prediction").alias("prediction"))


@query(
    "evaluate_saved",
    f"""SELECT count(*) AS n, avg((charge - b0 - b1 * l_quantity) ** 2) AS mse,
 avg(abs(charge - b0 - b1 * l_quantity)) AS mae, regr_r2(charge, l_quantity) AS r2 FROM {I.LI_CHARGE} AS x, {_FIT} AS f""",
    doubles="mse mae r2",
    per_column={"mse": 0, "mae": 3, "r2": 6},
)
def evaluate_saved(t):
    report = workflow.evaluate_saved(_saved_line(t), I.li_charge(t), "charge")
    return report.select("error_metrics.n", "error_metrics.mse", "error_metrics.mae", "error_metrics.r2")


@query(
    "run_record",
    f"""SELECT 'q1' AS run_id, 'linear' AS model, 'none' AS tuning, regr_slope(charge, l_quantity) AS slope,
 regr_r2(charge, l_quantity) AS r2 FROM {I.LI_CHARGE}""",
    doubles="slope r2",
    digits=3,
)
def run_record(t):
    df = I.li_charge(t)
    fitted = models.fit_model(df, ["l_quantity"], "charge", "linear")
    scored = models.predict(fitted, df)
    from ..operators import evaluate

    r2 = evaluate.regression_metrics(scored, "charge", "prediction").collect()[0]["r2"]
    slope = {r["term"]: r["coefficient"] for r in models.coefficients(fitted, ["l_quantity"], t.spark).collect()}["l_quantity"]
    path = shared_folder(t.spark)
    sinks.write_run_record(t.spark, path, "q1", {"model": "linear", "tuning": "none", "metrics": {"slope": slope, "r2": r2}})
    part = lambda p: F.get_json_object("record", f"$.{p}")
    return t.spark.read.schema("run_id string, record string").json(path).select(
        "run_id", part("model").alias("model"), part("tuning").alias("tuning"),
        part("metrics.slope").cast("double").alias("slope"), part("metrics.r2").cast("double").alias("r2"),
    )


def _scored_again(t, model, df):
    """Predictions of a model that was saved and loaded."""
    path = shared_folder(t.spark)
    models.save_model(model, path)
    return models.predict(models.load_model(path), df)


@query(
    "saved_ridge",
    f"""SELECT l_quantity, count(*) AS n, avg(my + cxy * n / (vx * n + 1000) * (l_quantity - mx)) AS prediction
 FROM {I.LI_CHARGE} AS x, {_S} AS f GROUP BY l_quantity""",
    doubles="prediction",
    digits=3,
)
def saved_ridge(t):
    df = I.li_charge(t)
    scored = _scored_again(t, models.fit_model(df, ["l_quantity"], "charge", "ridge", {"alpha": 1000.0}), df)
    return scored.groupBy("l_quantity").agg(F.count("*").alias("n"), F.avg("prediction").alias("prediction"))


@query(
    "saved_chain",
    """WITH e AS (SELECT p_partkey, p_retailprice AS y, count(*) OVER (PARTITION BY p_brand)::DOUBLE AS x FROM part),
 f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM e) SELECT p_partkey, a + b * x AS prediction FROM e, f""",
    doubles="prediction",
    digits=3,
)
def saved_chain(t):
    """A joined encoder and a line, saved together and applied to raw rows."""
    raw = t.part.select("p_partkey", "p_brand", "p_retailprice")
    chain = workflow.Chain()
    ready = chain.add(raw, encode.count_encode(raw, "p_brand"))
    whole = workflow.ChainedModel(chain, models.fit_model(ready, ["p_brand"], "p_retailprice", "linear"))
    return _scored_again(t, whole, raw).select("p_partkey", "prediction")


@query(
    "saved_adaboost",
    """SELECT p_partkey, CASE WHEN p_size <= 25 THEN 1.0::DOUBLE ELSE 0 END AS prediction FROM part""",
    doubles="prediction",
)
def saved_adaboost(t):
    """Boosted stumps on a label that one cut separates: the cut is found, saved and applied."""
    df = t.part.select("p_partkey", "p_size", (F.col("p_size") <= 25).cast("int").alias("small"))
    model = models.fit_model(df, ["p_size"], "small", "adaboost", {"n_estimators": 5, "max_bins": 64}, "classification")
    return _scored_again(t, model, df).select("p_partkey", "prediction")
