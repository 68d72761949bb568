"""Tail functions, quantiles, global order and hash selection against direct computation."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import quantiles, tails
from millrace.functions.gram import gram_matrix, pairwise_correlation, pairwise_moments
from millrace.functions.modes import exact_modes
from millrace.functions.moments import moments
from millrace.operators import ordered
from millrace.operators.lookup import lookup_join
from millrace.operators.split import allocate, hash_thresholds


def test_tail_probabilities():
    # textbook critical values
    assert tails.student_two_sided(2.228138852, 10) == pytest.approx(0.05, abs=1e-8)
    assert tails.student_two_sided(12.7062047364, 1) == pytest.approx(0.05, abs=1e-8)
    assert tails.f_upper(4.964602744, 1, 10) == pytest.approx(0.05, abs=1e-8)
    assert tails.f_upper(2.978237016, 10, 10) == pytest.approx(0.05, abs=1e-7)
    assert tails.chi2_upper(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-12)
    assert tails.chi2_upper(18.30703805327514, 10) == pytest.approx(0.05, abs=1e-12)
    assert tails.chi2_upper(0.5, 3) == pytest.approx(0.9188914116, abs=1e-9)
    assert tails.normal_two_sided(1.959963984540054) == pytest.approx(0.05, abs=1e-12)
    assert tails.kolmogorov_upper(1.3580986393) == pytest.approx(0.05, abs=1e-8)
    assert tails.kolmogorov_upper(0.8275735552) == pytest.approx(0.5, abs=1e-7)
    # both series agree where they meet
    assert tails.kolmogorov_upper(1.1799999) == pytest.approx(tails.kolmogorov_upper(1.18), abs=1e-6)


def test_published_breusch_pagan_values():
    from millrace.operators.evaluate import breusch_pagan_p

    assert breusch_pagan_p(41.616913182188284) == pytest.approx(1.1102858899768997e-10, rel=1e-12)
    assert breusch_pagan_p(7.932455532238247) == pytest.approx(0.004855585815053259, rel=1e-12)


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(7)
    rows = []
    for i in range(5000):
        x = 3.25 if i % 3 == 0 else rng.lognormvariate(0, 2)  # one value holds a third of the rows
        rows.append((i, x, float(rng.randrange(4)), None if i % 10 == 0 else rng.gauss(0, 1), float("nan") if i % 4 == 0 else 1.0 * i))
    return rows, spark.createDataFrame(rows, "id bigint, a double, b double, c double, d double").repartition(5)


def test_quantiles_exact_on_both_paths(numbers):
    rows, df = numbers
    probs = [0.0, 0.01, 0.25, 0.333, 0.5, 0.9, 0.999, 1.0]
    want = {}
    for j, name in enumerate("abcd", start=1):
        values = np.array([r[j] for r in rows if r[j] is not None and not math.isnan(r[j])])
        want[name] = np.quantile(values, probs)
    for in_memory in (10**6, 0):
        got = quantiles.exact_quantiles(df, {n: probs for n in "abcd"}, in_memory=in_memory)
        for n in "abcd":
            assert np.allclose(got[n], want[n], rtol=0, atol=1e-12), (in_memory, n)


@pytest.mark.parametrize("limit, accuracy", [(50, 100), (7, 40), (100000, 10000)])
def test_order_statistics_narrowing(numbers, limit, accuracy):
    rows, df = numbers
    values = sorted(r[1] for r in rows)
    ranks = [0, 1, 17, 1250, 2499, 4998, 4999]
    got = quantiles.order_statistics(df, {"a": F.col("a")}, {"a": ranks}, collect_limit=limit, accuracy=accuracy)
    assert got["a"] == {r: values[r] for r in ranks}


def test_moments_skip_nan_and_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (10.0,), (float("nan"),), (None,)], "x double")
    m = moments(df, ["x"], ["n", "n_rows", "mean", "max", "skew", "kurt", "std"])["x"]
    assert (m["n"], m["n_rows"], m["mean"], m["max"]) == (4, 6, 3.75, 10.0)
    assert m["skew"] == pytest.approx(1.9225217141412743)
    assert m["kurt"] == pytest.approx(3.769996181577235)
    assert exact_modes(df, ["x"]) == {"x": 2.0}


@pytest.mark.parametrize("few, buckets, limit", [(True, 8, 10), (False, 8, 60), (False, 64, 100), (False, 4096, 10**9)])
def test_exact_modes_in_their_own_type(spark, few, buckets, limit):
    """Neighbours above 2^53, hot, tied and unrepeated values, every bucket size and slice."""
    from collections import Counter
    from decimal import Decimal

    big = 2**53
    rows = []
    for i in range(600):
        whole = big + 1 if i % 5 == 0 else big + (0 if i % 6 == 0 else 2 + i % 40)
        rows.append((whole, float(i * 7919 % 600), None if i % 2 else Decimal(i % 9) / 8, [float("nan"), -0.0, 0.0][i % 3], "ab"[i % 2], None))
    df = spark.createDataFrame(rows, "a bigint, b double, c decimal(20,6), d double, e string, f int")
    got = exact_modes(df, list("abcdef"), few=few, buckets=buckets, limit=limit)
    counts = Counter(r[2] for r in rows if r[2] is not None)
    most = min(counts, key=lambda v: (-counts[v], v))
    assert got == {"a": big + 1, "b": 0.0, "c": most, "d": 0.0, "e": "a", "f": None}
    assert isinstance(got["a"], int)


def test_exact_modes_count_only_buckets_that_can_win(spark, monkeypatch):
    """A value in a tenth of the rows of an otherwise continuous column: one bucket is counted by value."""
    from millrace.functions import modes

    counted, real = [], modes._best
    monkeypatch.setattr(modes, "_best", lambda cells: counted.append(cells.count()) or real(cells))
    df = spark.range(20_000).selectExpr("IF(id % 10 = 0, 0.5D, CAST(id AS DOUBLE)) AS x")
    assert modes.exact_modes(df, ["x"], few=False, buckets=512) == {"x": 0.5}
    assert len(counted) == 1 and counted[0] < 2_200


def test_wide_tables_use_the_stacked_aggregate(spark):
    names = [f"k.{i}" for i in range(40)]
    df = spark.createDataFrame([tuple(float(i * j) for j in range(40)) for i in range(6)], names)
    m = moments(df, names, ["mean", "max"])
    assert m["k.3"] == {"mean": 7.5, "max": 15.0}
    constant = spark.createDataFrame([(5.0,)] * 4, "x double")
    assert moments(constant, ["x"], ["skew", "kurt"])["x"] == {"skew": 0.0, "kurt": 0.0}


def test_ordered_scan_matches_a_plain_window(numbers):
    rows, df = numbers
    slim = df.select("id", "a")
    got = ordered.ordered_scan(slim, [F.col("a"), F.col("id")], {"cum": F.col("a")}, partitions=7, small=False)
    want = sorted((r[1], r[0]) for r in rows)
    cum = np.cumsum([a for a, _ in want])
    found = {r["id"]: (r["row_index"], r["cum"]) for r in got.collect()}
    for i, (_, key) in enumerate(want):
        assert found[key][0] == i
        assert found[key][1] == pytest.approx(cum[i], rel=1e-9)


def test_lagged_crosses_range_edges(spark, monkeypatch):
    monkeypatch.setattr(ordered, "SMALL_VALUES", 10)
    df = spark.range(9000).selectExpr("id AS o", "CAST(id * 2 AS DOUBLE) AS v").repartition(6)
    out = ordered.lagged(df, [F.col("o")], [1, 5], "v")
    rows = {r["o"]: r for r in out.collect()}
    assert len(rows) == 9000
    assert rows[0]["v_lag1"] is None and rows[4]["v_lag5"] is None
    for o in (1, 5, 4095, 4096, 4097, 4100, 8191, 8192, 8999):
        assert rows[o]["v_lag1"] == (o - 1) * 2.0
        if o >= 5:
            assert rows[o]["v_lag5"] == (o - 5) * 2.0


def test_ranged_scan_equals_window_on_hot_null_and_decimal_values(spark):
    """A value in a third of the rows, null values and totals, ranges shorter than the lag, equal order."""
    df = spark.range(400).selectExpr(
        "id",
        "CAST(id % 7 AS INT) AS o",
        "IF(id % 3 = 0, 5.0D, IF(id % 11 = 0, NULL, CAST(id * 37 % 101 AS DOUBLE))) AS v",
        "IF(id % 13 = 0, NULL, CAST(id / 8 AS DECIMAL(9, 3))) AS d",
    )
    sums = {"whole": F.col("id"), "exact": F.col("d")}
    few, many = (ordered.ordered_scan(df, [F.col("v"), F.col("id")], sums, partitions=60, small=s) for s in (True, False))
    assert few.schema["exact"].dataType == many.schema["exact"].dataType
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))
    slim = df.select("o", "v")
    few, many = (ordered.lagged(slim, [F.col("o")], [1, 40], "v", partitions=90, small=s) for s in (True, False))
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))


def test_ranged_scan_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "o bigint, v double")
    out = ordered.ordered_scan(empty, [F.col("o")], {"t": F.col("v")}, small=False)
    assert out.columns == ["o", "v", "row_index", "t"] and out.count() == 0
    out = ordered.lagged(empty, [F.col("o")], [2], "v", small=False)
    assert out.columns == ["o", "v", "row_index", "v_lag2"] and out.count() == 0


def test_ranged_scan_moves_the_rows_once(spark, monkeypatch):
    layouts, real = [], ordered.materialise
    monkeypatch.setattr(ordered, "materialise", lambda df: layouts.append(plan_of(df)) or real(df))
    df = spark.range(5000).selectExpr("id AS o", "CAST(id AS DOUBLE) AS v")
    out = ordered.lagged(df, [F.col("o")], [1, 40], "v", small=False)
    assert len(layouts) == 1 and layouts[0].count("Exchange") == 1 == layouts[0].count("rangepartitioning")
    assert "Exchange" not in plan_of(out) and "Window" not in plan_of(out)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_average_ranks_within_columns(spark, monkeypatch):
    monkeypatch.setattr(ordered, "SMALL_VALUES", 1)
    rows = [("p", 1.0, 2), ("p", 3.0, 1), ("p", 7.0, 4), ("q", 0.5, 1), ("q", 9.0, 3)]
    got = ordered.average_ranks(spark.createDataFrame(rows, "column string, value double, n bigint"), ["column"])
    ranks = {(r["column"], r["value"]): r["avg_rank"] for r in got.collect()}
    assert ranks == {("p", 1.0): 1.5, ("p", 3.0): 3.0, ("p", 7.0): 5.5, ("q", 0.5): 1.0, ("q", 9.0): 3.0}


def test_lookup_join_with_a_hot_value(spark):
    big = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('k', id) END AS k")
    table = big.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n")).selectExpr("k AS v", "n AS enc", "n")
    for small in (True, False):
        got = lookup_join(big, F.col("k"), table, "v", "n", small)
        rows = {r["id"]: r["enc"] for r in got.collect()}
        assert len(rows) == 3000
        assert rows[0] == 1000 and rows[2] == 1
        assert rows[51 + 150 * 0] is None or 51 % 3 == 0
        assert rows[101] is None


def test_gram_paths_agree(spark, monkeypatch):
    from millrace.functions import gram

    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4))
    rows = [tuple(None if rng.random() < 0.1 else float(v) for v in r) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(4)
    names = ["a", "b", "c", "d"]
    n1, g1 = gram_matrix(df, names)
    c1 = pairwise_correlation(df, names, [0.0] * 4)
    monkeypatch.setattr(gram, "EXPRESSION_WIDTH", 1)
    n2, g2 = gram_matrix(df, names)
    c2 = pairwise_correlation(df, names, [0.0] * 4)
    assert n1 == n2 and np.allclose(g1, g2)
    assert np.allclose(c1[0], c2[0]) and np.allclose(c1[1], c2[1])
    import pandas as pd

    frame = pd.DataFrame(rows, columns=names).astype(float)
    assert np.allclose(c2[1], frame.corr().to_numpy())
    assert pairwise_moments(df, names, [0.0] * 4)["n"][0, 0] == frame["a"].notna().sum()


def test_hash_thresholds_pick_exactly_n(spark):
    df = spark.range(4000).selectExpr("id", "CASE WHEN id % 4 = 0 THEN 'x' ELSE 'y' END AS s")
    takes = {"x": [0, 1, 250, 1000], "y": [7, 2999]}
    marks = hash_thresholds(df, "id", 42, takes, "s")
    for s, ns in takes.items():
        ids = [i for i in range(4000) if (i % 4 == 0) == (s == "x")]
        hashes = sorted(hashlib.md5(f"42:{i}".encode()).hexdigest() for i in ids)
        for n, mark in zip(ns, marks[s]):
            assert sum(h <= mark for h in hashes) == n


def test_hash_thresholds_refine_long_prefixes(spark, monkeypatch):
    from millrace.operators import split

    monkeypatch.setattr(split, "READ_LIMIT", 2)
    df = spark.range(3000)
    mark = hash_thresholds(df, "id", 1, {"": [1234]})[""][0]
    hashes = [hashlib.md5(f"1:{i}".encode()).hexdigest() for i in range(3000)]
    assert sum(h <= mark for h in hashes) == 1234


def test_allocate_adds_up():
    assert allocate({"a": 10, "b": 10, "c": 1}, 7) == {"a": 4, "b": 3, "c": 0}
    assert sum(allocate({"a": 333, "b": 334, "c": 333}, 100).values()) == 100
