"""Queries for splits, folds, resampling and nearest neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import neighbours, resample, split
from . import inputs as I
from .queries_prepare import hu, hx
from .registry import query


def md(key: str, seed: str = "42") -> str:
    return f"md5('{seed}:' || CAST({key} AS VARCHAR))"


@query(
    "split_random",
    f"""SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY {md('o_orderkey')}) <= ceil(0.3::DOUBLE * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM orders""",
)
def split_random(t):
    return split.split_random(t.orders.select("o_orderkey"), "o_orderkey")


@query("split_random_approx", f"SELECT o_orderkey, CASE WHEN {hu('o_orderkey', '42')} < 0.3 THEN 'test' ELSE 'train' END AS split FROM orders")
def split_random_approx(t):
    return split.split_random(t.orders.select("o_orderkey"), "o_orderkey", mode="approx")


def _strata_sql(source, key, s, share):
    return f"""WITH src AS (SELECT {key} AS k, {s} AS s FROM {source}), n AS (SELECT s, count(*) AS m FROM src GROUP BY s),
 a AS (SELECT s, ceil({share}::DOUBLE * (SELECT count(*) FROM src)) * m / (SELECT count(*) FROM src) AS x FROM n),
 b AS (SELECT s, floor(x) + CASE WHEN row_number() OVER (ORDER BY round(x - floor(x), 9) DESC, s) <= ceil({share}::DOUBLE * (SELECT count(*) FROM src)) - (SELECT sum(floor(x)) FROM a) THEN 1 ELSE 0 END AS take FROM a)
 SELECT k AS {key}, CASE WHEN row_number() OVER (PARTITION BY src.s ORDER BY {md('k')}) <= take THEN 'test' ELSE 'train' END AS split FROM src JOIN b USING (s)"""


@query("split_stratified", _strata_sql("orders", "o_orderkey", "o_orderpriority", 0.3))
def split_stratified(t):
    return split.split_stratified(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderkey", "o_orderpriority").drop("o_orderpriority")


_BINS = "CAST(CASE " + " ".join(f"WHEN o_totalprice <= e[{i}] THEN {i - 1}" for i in range(1, 10)) + " ELSE 9 END AS VARCHAR)"
_BINNED = f"(SELECT o_orderkey, o_totalprice, {_BINS} AS b FROM orders, (SELECT quantile_cont(o_totalprice, [{', '.join(str(i / 10) for i in range(1, 10))}]) AS e FROM orders))"


@query("split_stratified_bins", _strata_sql(_BINNED, "o_orderkey", "b", 0.3))
def split_stratified_bins(t):
    return split.split_stratified(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", "o_totalprice").drop("o_totalprice")


@query(
    "split_bias",
    f"""WITH s AS (SELECT avg(o_totalprice) AS mu, stddev_samp(o_totalprice) AS sd FROM orders)
 SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY (o_totalprice - mu) / sd * 0.7 + 0.3, {md('o_orderkey')}) <= CAST(floor((SELECT count(*) FROM orders) * 0.3::DOUBLE) AS BIGINT) THEN 'test' ELSE 'train' END AS split FROM orders, s""",
)
def split_bias(t):
    df = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    return split.split_bias(df, "o_orderkey", {"o_totalprice": 0.7, "o_orderpriority": 0.3}).select("o_orderkey", "split")


@query(
    "split_time",
    f"""SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderdate, {md('o_orderkey')}) <= CAST(floor((SELECT count(*) FROM orders) * (1.0::DOUBLE - 0.3::DOUBLE)) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM orders""",
)
def split_time(t):
    return split.split_time(t.orders.select("o_orderkey", "o_orderdate"), "o_orderkey", "o_orderdate").select("o_orderkey", "split")



@query(
    "split_bias_frequency",
    f"""WITH b AS (SELECT l_id, CASE {' '.join(f'WHEN user_id <= e[{i}] THEN {i - 1}' for i in range(1, 4))} ELSE 3 END AS b FROM
 (SELECT event_id AS l_id, user_id FROM events), (SELECT quantile_cont(user_id, [0.25, 0.5, 0.75]) AS e FROM events)), n AS (SELECT b, count(*)::DOUBLE AS n FROM b GROUP BY b)
 SELECT l_id AS event_id, CASE WHEN row_number() OVER (ORDER BY -ln(1 - {hu('l_id', '42')}) * n, {md('l_id')}) <= CAST(floor((SELECT count(*) FROM events) * 0.2::DOUBLE) AS BIGINT) THEN 'test' ELSE 'train' END AS split FROM b JOIN n USING (b)""",
)
def split_bias_frequency(t):
    df = t.events.select("event_id", "user_id")
    return split.split_bias_frequency(df, "event_id", "user_id", bins=4).select("event_id", "split")


@query(
    "kfold",
    f"""WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {md('o_orderkey')}) AS r, count(*) OVER () AS n FROM orders)
 SELECT o_orderkey, CAST((SELECT min(i) FROM range(0, 5) t(i) WHERE r <= (n // 5) * (i + 1) + least(i + 1, n % 5)) AS INT) AS fold FROM r""",
)
def kfold(t):
    return split.kfold(t.orders.select("o_orderkey"), "o_orderkey")


@query(
    "kfold_stratified",
    f"""WITH r AS (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {md('o_orderkey')}) AS r, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
 SELECT o_orderkey, CAST((SELECT min(i) FROM range(0, 5) t(i) WHERE r <= (n // 5) * (i + 1) + least(i + 1, n % 5)) AS INT) AS fold FROM r""",
)
def kfold_stratified(t):
    return split.kfold(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderkey", target="o_orderpriority").drop("o_orderpriority")


@query(
    "undersample",
    f"""SELECT doc_id, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {md('doc_id')}) AS r FROM {I.SCORE_DOCS})
 WHERE r <= (SELECT min(n) FROM (SELECT count(*) AS n FROM {I.SCORE_DOCS} GROUP BY label))""",
)
def undersample(t):
    return resample.undersample(I.score_docs(t), "doc_id", "label").select("doc_id", "label")


@query(
    "class_weight",
    f"""SELECT count(*) FILTER (label = 0) AS negatives, count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0)::DOUBLE / count(*) FILTER (label = 1) AS scale_pos_weight FROM {I.SCORE_DOCS}""",
    doubles="scale_pos_weight",
)
def class_weight(t):
    return resample.class_weight(I.score_docs(t), "label")


# ---------------------------------------------------------------- neighbours

WIDTH = 64
FEATS = [f"e{i}" for i in range(WIDTH)]
VEC = f"(SELECT vec_id, label, label = 0 AS rare, CAST(list_slice(embedding, 1, {WIDTH}) AS DOUBLE[]) AS v FROM embeddings)"


def _near(ask, corpus, k, self_join=True):
    """DuckDB brute-force k nearest: (q, nb, d, r)."""
    same = "WHERE a.vec_id <> b.vec_id" if self_join else ""
    return f"""(SELECT * FROM (SELECT a.vec_id AS q, b.vec_id AS nb, list_distance(a.v, b.v) AS d, b.v AS bv, b.rare AS nb_rare,
 row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS r FROM {ask} a, {corpus} b {same}) WHERE r <= {k})"""


@query("knn_join", f"SELECT q AS vec_id, nb AS neighbour, d AS distance, CAST(r AS INT) AS rank FROM {_near(VEC, VEC, 3)}", doubles="distance")
def knn_join(t):
    df = I.vectors(t, WIDTH)
    return neighbours.knn_join(df, df, "vec_id", "vec_id", FEATS, 3, exclude_self=True, block_rows=256)


@query(
    "knn_reg",
    f"""SELECT q AS vec_id, avg(y) AS prediction FROM {_near(f"(SELECT * FROM {VEC} WHERE {hu('vec_id', '42')} < 0.2)", f"(SELECT * FROM {VEC} WHERE NOT {hu('vec_id', '42')} < 0.2)", 5, False)}
 JOIN (SELECT vec_id AS nb, label::DOUBLE AS y FROM embeddings) USING (nb) GROUP BY q""",
    doubles="prediction",
)
def knn_reg(t):
    df = I.vectors(t, WIDTH)
    train, test = split.parts(split.split_random(df, "vec_id", 0.2, mode="approx"))
    return neighbours.knn_predict(train, test, "vec_id", "vec_id", FEATS, "label", 5)


@query(
    "knn_reg_distance",
    f"""SELECT q AS vec_id, sum(y / d) / sum(1 / d) AS prediction FROM {_near(f"(SELECT * FROM {VEC} WHERE {hu('vec_id', '42')} < 0.2)", f"(SELECT * FROM {VEC} WHERE NOT {hu('vec_id', '42')} < 0.2)", 5, False)}
 JOIN (SELECT vec_id AS nb, label::DOUBLE AS y FROM embeddings) USING (nb) GROUP BY q""",
    doubles="prediction",
)
def knn_reg_distance(t):
    df = I.vectors(t, WIDTH)
    train, test = split.parts(split.split_random(df, "vec_id", 0.2, mode="approx"))
    return neighbours.knn_predict(train, test, "vec_id", "vec_id", FEATS, "label", 5, weights="distance")


_REST = "list_concat(list_slice(embedding, 1, 3), list_slice(embedding, 5, 64))"
_CELLS = ", ".join("CASE WHEN vec_id % 5 = 0 THEN NULL ELSE embedding[4]::DOUBLE END AS e3" if i == 3 else f"embedding[{i + 1}]::DOUBLE AS e{i}" for i in range(WIDTH))


@query(
    "knn_impute",
    f"""WITH g AS (SELECT vec_id, CAST({_REST} AS DOUBLE[]) AS rest, {_CELLS} FROM embeddings),
 p AS (SELECT a.vec_id AS q, b.e3 AS y, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.rest, b.rest), b.vec_id) AS r
 FROM g a, g b WHERE a.e3 IS NULL AND b.e3 IS NOT NULL)
 SELECT * EXCLUDE (rest) REPLACE (coalesce(e3, (SELECT avg(y) FROM p WHERE q = vec_id AND r <= 5)) AS e3) FROM g""",
    doubles=FEATS,
)
def knn_impute(t):
    df = I.vectors(t, WIDTH).drop("label").withColumn("e3", F.when(F.col("vec_id") % 5 != 0, F.col("e3")))
    return neighbours.knn_impute(df, "vec_id", FEATS)


@query("knn_approx")
def knn_approx(t):
    """Neighbours by random-projection buckets; the share of the exact ones is held in tests."""
    df = I.vectors(t, WIDTH)
    return neighbours.knn_join(df, df, "vec_id", "vec_id", FEATS, 10, exclude_self=True, mode="approx", recall=0.95)


def _smote_sql():
    near = _near(f"(SELECT * FROM {VEC} WHERE rare)", f"(SELECT * FROM {VEC} WHERE rare)", 5)
    rows = f"""(SELECT vec_id, v, 5 AS k, (n_new // n) + CASE WHEN row_number() OVER (ORDER BY {md('vec_id', '42extra')}) <= n_new % n THEN 1 ELSE 0 END AS copies FROM {VEC},
 (SELECT count(*) FILTER (rare) AS n, count(*) FILTER (NOT rare) - count(*) FILTER (rare) AS n_new FROM {VEC}) WHERE rare)"""
    tag = "CAST(m.q AS VARCHAR) || ':' || CAST(m.c AS VARCHAR)"
    return f"""SELECT m.q AS seed_key, CAST(m.c AS INT) AS copy, true AS rare, {', '.join(f'm.v[{i + 1}] + {hu(tag, "42gap")} * (n.bv[{i + 1}] - m.v[{i + 1}]) AS e{i}' for i in range(WIDTH))}
 FROM (SELECT vec_id AS q, v, unnest(range(1, copies + 1)) AS c FROM {rows}) m JOIN {near} n ON n.q = m.q AND n.r = {hx(tag, '42pick')} % 5 + 1"""


def _rare(t):
    return I.vectors(t, WIDTH).withColumn("rare", F.col("label") == 0).drop("label")


@query("smote", _smote_sql(), doubles=" ".join(FEATS))
def smote(t):
    return resample.smote(_rare(t), "vec_id", FEATS, "rare")


_ADA = f"""(SELECT q AS vec_id, avg(CASE WHEN nb_rare THEN 0.0::DOUBLE ELSE 1 END) AS ratio FROM {_near(f"(SELECT * FROM {VEC} WHERE rare)", VEC, 5)} GROUP BY q)"""


def _adasyn_sql():
    near = _near(f"(SELECT * FROM {VEC} WHERE rare)", f"(SELECT * FROM {VEC} WHERE rare)", 5)
    rows = f"""(SELECT vec_id, v, CAST(round(ratio / (SELECT sum(ratio) FROM {_ADA}) * n_new) AS INT) AS copies FROM {VEC} JOIN {_ADA} USING (vec_id),
 (SELECT (count(*) FILTER (NOT rare) - count(*) FILTER (rare))::DOUBLE AS n_new FROM {VEC}) WHERE rare)"""
    tag = "CAST(m.q AS VARCHAR) || ':' || CAST(m.c AS VARCHAR)"
    return f"""SELECT m.q AS seed_key, CAST(m.c AS INT) AS copy, true AS rare, {', '.join(f'm.v[{i + 1}] + {hu(tag, "42gap")} * (n.bv[{i + 1}] - m.v[{i + 1}]) AS e{i}' for i in range(WIDTH))}
 FROM (SELECT vec_id AS q, v, unnest(range(1, copies + 1)) AS c FROM {rows}) m JOIN {near} n ON n.q = m.q AND n.r = {hx(tag, '42pick')} % 5 + 1"""


@query("adasyn", _adasyn_sql(), doubles=" ".join(FEATS))
def adasyn(t):
    return resample.adasyn(_rare(t), "vec_id", FEATS, "rare", "true")


@query(
    "tomek_links",
    f"""WITH n AS {_near(VEC, VEC, 1)}, m AS (SELECT n.q, n.nb, a.rare AS ra, n.nb_rare AS rb FROM n JOIN {VEC} a ON a.vec_id = n.q)
 SELECT x.q AS vec_id FROM m x JOIN m y ON y.q = x.nb AND y.nb = x.q WHERE x.ra <> x.rb""",
)
def tomek_links(t):
    return resample.tomek_links(_rare(t), "vec_id", FEATS, "rare")


def _tomek_sql():
    cells = ", ".join(f"e{i}" for i in range(WIDTH))
    both = f"""SELECT CAST(vec_id AS VARCHAR) AS row_id, v, rare, false AS synthetic FROM {VEC}
 UNION ALL SELECT CAST(seed_key AS VARCHAR) || ':' || CAST(copy AS VARCHAR), [{cells}], rare, true FROM ({_smote_sql()})"""
    return f"""WITH b AS MATERIALIZED ({both}), n AS (SELECT * FROM (SELECT x.row_id AS q, y.row_id AS nb, x.rare AS ra, y.rare AS rb,
 row_number() OVER (PARTITION BY x.row_id ORDER BY list_distance(x.v, y.v), y.row_id) AS r FROM b x, b y WHERE x.row_id <> y.row_id) WHERE r = 1)
 SELECT row_id, {', '.join(f'v[{i + 1}] AS e{i}' for i in range(WIDTH))}, rare, synthetic FROM b
 WHERE row_id NOT IN (SELECT p.q FROM n p JOIN n s ON s.q = p.nb AND s.nb = p.q WHERE p.ra <> p.rb)"""


@query("smote_tomek", _tomek_sql(), doubles=" ".join(FEATS))
def smote_tomek(t):
    return resample.smote_tomek(_rare(t), "vec_id", FEATS, "rare")


def _smote_regression_sql():
    """Quantile bins of the label; each smaller bin is filled as SMOTE fills a class."""
    n_bins, k = 3, 5
    edges = ", ".join(str(i / n_bins) for i in range(1, n_bins))
    case = " ".join(f"WHEN label <= e[{i}] THEN {i - 1}" for i in range(1, n_bins))
    tag = "CAST(m.q AS VARCHAR) || ':' || CAST(m.c AS VARCHAR)"
    return f"""WITH b AS (SELECT vec_id, v, label, CASE {case} ELSE {n_bins - 1} END AS bin FROM {VEC}, (SELECT quantile_cont(label, [{edges}]) AS e FROM embeddings)),
 z AS (SELECT bin, count(*) AS n, avg(label) AS mean FROM b GROUP BY bin), w AS (SELECT *, (SELECT max(n) FROM z) - n AS n_new FROM z),
 near AS (SELECT * FROM (SELECT x.vec_id AS q, y.v AS bv, row_number() OVER (PARTITION BY x.vec_id ORDER BY list_distance(x.v, y.v), y.vec_id) AS r FROM b x JOIN b y ON x.bin = y.bin AND x.vec_id <> y.vec_id) WHERE r <= {k}),
 s AS (SELECT vec_id, v, bin, (n_new // n) + CASE WHEN row_number() OVER (PARTITION BY bin ORDER BY {md('vec_id', '42extra')}) <= n_new % n THEN 1 ELSE 0 END AS copies FROM b JOIN w USING (bin))
 SELECT m.q AS seed_key, CAST(m.c AS INT) AS copy, {', '.join(f'm.v[{i + 1}] + {hu(tag, "42gap")} * (near.bv[{i + 1}] - m.v[{i + 1}]) AS e{i}' for i in range(WIDTH))}, z.mean AS label, m.bin AS bin
 FROM (SELECT vec_id AS q, v, bin, unnest(range(1, copies + 1)) AS c FROM s) m JOIN near ON near.q = m.q AND near.r = {hx(tag, '42pick')} % {k} + 1 JOIN z ON z.bin = m.bin"""


@query("smote_regression", _smote_regression_sql(), doubles=" ".join(FEATS) + " label")
def smote_regression(t):
    return resample.smote_regression(I.vectors(t, WIDTH), "vec_id", FEATS, "label", bins=3)
