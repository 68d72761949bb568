"""Statistics, tests, lift, splits and neighbours against direct computation."""

import hashlib
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import tails
from millrace.operators import charts, evaluate, explore, hypothesis, lift, neighbours, ordered, resample, split


def two(spark, a, b):
    return spark.createDataFrame([("a", float(x)) for x in a] + [("b", float(x)) for x in b], "g string, x double")


A = [1.83, 0.50, 1.62, 2.48, 1.68, 1.88, 1.55, 3.06, 1.30]
B = [0.878, 0.647, 0.598, 2.05, 1.06, 1.29, 1.06, 3.14, 1.29]


def test_two_sample_tests(spark):
    df = two(spark, A, B)
    t = hypothesis.ttest(df, "g", "x")
    sp = math.sqrt((np.var(A, ddof=1) + np.var(B, ddof=1)) / 2)
    assert t["statistic"] == pytest.approx((np.mean(A) - np.mean(B)) / (sp * math.sqrt(2 / 9)))
    assert t["dof"] == 16
    w = hypothesis.ttest_welch(df, "g", "x")
    assert w["statistic"] == pytest.approx(t["statistic"]) and w["dof"] < 16
    f = hypothesis.anova(df, "g", "x")
    assert f["statistic"] == pytest.approx(t["statistic"] ** 2) and f["p_value"] == pytest.approx(t["p_value"])


def test_wilcoxon_exact_textbook_value(spark):
    # published example of paired depression scores: V = 40, two-sided p = 0.03906
    df = spark.createDataFrame(list(zip(A, B)), "x double, y double")
    got = hypothesis.wilcoxon(df, "x", "y")
    assert got["statistic"] == 5.0 and got["p_value"] == pytest.approx(0.0390625)
    same = spark.createDataFrame([(1.0, 1.0)], "x double, y double")
    assert hypothesis.wilcoxon(same, "x", "y") is None


def test_mannwhitney_exact_and_normal(spark):
    got = hypothesis.mannwhitney(two(spark, [1, 2, 3], [4, 5, 6]), "g", "x")
    assert got["statistic"] == 0.0 and got["p_value"] == pytest.approx(0.1)
    x, y = [1, 2, 2, 3] * 5, [2, 3, 4, 5] * 5
    got = hypothesis.mannwhitney(two(spark, x, y), "g", "x")
    u = sum((a > b) + 0.5 * (a == b) for a in x for b in y)
    assert got["statistic"] == u and 0 < got["p_value"] < 0.01


def test_rank_tests_by_brute_force(spark, monkeypatch):
    rng = random.Random(1)
    groups = {g: [rng.randrange(12) + (g == "c") for _ in range(30)] for g in "abc"}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    pooled = sorted(v for _, v in rows)
    rank = {v: pooled.index(v) + (pooled.count(v) + 1) / 2 for v in set(pooled)}
    n = len(pooled)
    h = 12 / (n * (n + 1)) * sum(sum(rank[v] for v in vs) ** 2 / 30 for vs in groups.values()) - 3 * (n + 1)
    h /= 1 - sum(pooled.count(v) ** 3 - pooled.count(v) for v in set(pooled)) / (n**3 - n)
    for limit in (10**6, 2):  # plain window and ranged scan
        monkeypatch.setattr(ordered, "SMALL_VALUES", limit)
        assert hypothesis.kruskal(df, "g", "x")["statistic"] == pytest.approx(h)
        d = max(abs(sum(v <= c for v in groups["a"]) - sum(v <= c for v in groups["b"])) / 30 for c in pooled)
        assert hypothesis.ks_2samp(df, "g", "x")["statistic"] == pytest.approx(d)


def test_normality_formula(spark):
    x = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]  # published height example: Z = 2.78 for skew
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    row = hypothesis.normality(df).collect()[0]
    assert row["statistic"] == pytest.approx(13.034263121192582, abs=1e-6) and not row["is_normal"]
    assert row["p_value"] == pytest.approx(math.exp(-row["statistic"] / 2))
    assert hypothesis.normality(df.limit(7)).count() == 0


def test_chi2_continuity_and_empty_cells(spark):
    rows = [("m", "l")] * 43 + [("m", "r")] * 9 + [("f", "l")] * 44 + [("f", "r")] * 4
    df = spark.createDataFrame(rows, "s string, h string")
    got = hypothesis.chi2_contingency(df, "s", "h")
    assert got["statistic"] == pytest.approx(1.0724852, abs=1e-6)
    wide = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "y")], "s string, h string")
    assert hypothesis.contingency(wide, "s", "h").count() == 6


def test_battery_pairs_only_equal_sizes(spark):
    rows = [(i, "a" if i % 2 else "b", float(i * i % 17)) for i in range(40)]
    df = spark.createDataFrame(rows, "o int, g string, x double")
    table = {r["test"]: r for r in hypothesis.two_sample_battery(df, "g", "x", "o").collect()}
    assert table["wilcoxon"]["statistic"] is not None
    table = {r["test"]: r for r in hypothesis.two_sample_battery(df.where("o > 0"), "g", "x", "o").collect()}
    assert table["wilcoxon"]["statistic"] is None and table["ks"]["statistic"] is not None
    with pytest.raises(ValueError):
        hypothesis.stats_analysis(df, ["nowhere"], "x", "ttest")
    out = hypothesis.stats_analysis(df.where("o > 0"), ["g"], "x", ["ttest", "wilcoxon", "mannwhitneyu", "anova"], order="o")
    assert sorted(r["method"] for r in out.collect()) == ["Mann-Whitney U", "T-Test", "Wilcoxon"]


def test_spearman_re_ranks_shared_rows(spark):
    import pandas as pd

    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"a": rng.integers(0, 6, 80).astype(float), "b": rng.normal(size=80), "c": rng.normal(size=80)})
    frame.loc[::7, "b"] = np.nan
    df = spark.createDataFrame([tuple(None if v != v else float(v) for v in r) for r in frame.to_numpy()], "a double, b double, c double")
    _, r = explore.spearman_matrix(df, ["a", "b", "c"])
    want = [[frame[[x, y]].dropna().rank().corr().iloc[0, -1] if x != y else 1.0 for y in "abc"] for x in "abc"]
    assert np.allclose(r, want)


@pytest.mark.parametrize("few", [True, False])
def test_rank_correlations_share_patterns_of_missing_rows(spark, monkeypatch, few):
    """Twenty columns, half with nulls: equal to ranking each pair anew, in one ordered scan."""
    import pandas as pd

    from millrace.operators import ranks

    rng = np.random.default_rng(11)
    x = rng.integers(0, 12, (300, 20)).astype(float)
    x[:, 1] += x[:, 0]
    x[:100, 2] = 4.0
    x[:, 19] = 7.0
    for j in range(5, 15):
        x[rng.random(300) < 0.2, j] = np.nan
    x[:, 6], x[:, 7] = np.where(np.isnan(x[:, 5]), np.nan, x[:, 6]), np.where(np.isnan(x[:, 8]), x[:, 7], -0.0)
    names = [f"k.{i}" for i in range(20)]
    frame = pd.DataFrame(x, columns=names)
    df = spark.createDataFrame(frame)
    scans, real = [], ranks.ordered_scan
    monkeypatch.setattr(ranks, "ordered_scan", lambda *a, **k: scans.append(1) or real(*a, **k))
    n, r = ranks.rank_correlations(df, names, few)
    held = (~frame.isna()).to_numpy().astype(int)
    assert (n == held.T @ held).all() and len(scans) == 1
    assert np.allclose(r, frame.corr(method="spearman").to_numpy(), equal_nan=True)


def test_rank_correlations_of_empty_tables_and_columns(spark):
    from millrace.operators import ranks

    empty = spark.createDataFrame([], "a double, b bigint")
    n, r = ranks.rank_correlations(empty, ["a", "b"])
    assert (n == 0).all() and np.isnan(r).all()
    gone = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    for few in (True, False):
        n, r = ranks.rank_correlations(gone, ["a", "b"], few)
        assert n.tolist() == [[2, 0], [0, 0]] and r[0, 0] == 1.0 and np.isnan([r[0, 1], r[1, 1]]).all()


def test_constant_columns_have_no_correlation(spark):
    df = spark.createDataFrame([(float(i), 5.0, None if i == 2 else i * 2.0) for i in range(5)], "a double, k double, b double")
    got = {(r["column_1"], r["column_2"]): r["correlation"] for r in explore.corr_matrix(df, "pearson").collect()}
    assert got[("a", "k")] is None and got[("k", "k")] is None and got[("a", "b")] == pytest.approx(1.0)
    assert explore.high_corr_pairs(df).count() == 1
    from millrace.operators import select

    assert select.kbest(df, "a", 1, features=["k", "b"]).selected == ["b"]
    line = charts.fit_line(df, "k", "a").collect()[0]
    assert line["slope"] is None


def test_lift_and_lorenz(spark):
    df = spark.createDataFrame([(i, float(i), float(i >= 15)) for i in range(20)], "id int, p double, y double")
    rows = lift.decile_lift(df, "y", "p").orderBy("decile").collect()
    assert rows[9]["lift"] == pytest.approx(4.0) and rows[9]["cumulative_lift"] == pytest.approx(1.0)
    curve = lift.lorenz_curve(df, "p").orderBy("rank").collect()
    assert len(curve) == 21 and curve[0]["cumulative_share"] == 0.0 and curve[-1]["cumulative_share"] == pytest.approx(1.0)
    gini = lift.gini_lorenz(df, "y", "p", "id").collect()[0]["gini"]
    share = np.cumsum([1.0] * 5 + [0.0] * 15) / 5
    assert gini == pytest.approx(1 - 2 * share.mean())


def test_classification_scores(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (1, 1, 0.4), (0, 1, 0.4), (0, 0, 0.1)], "y int, p int, s double")
    assert evaluate.roc_auc(df, "y", "s").collect()[0][0] == pytest.approx(0.875)
    m = evaluate.classification_metrics(df, "y", "p").collect()[0]
    assert m["accuracy"] == 0.75 and m["precision"] == pytest.approx((2 * 2 / 3 + 2 * 1.0) / 4)
    assert evaluate.roc_curve(df, "y", "s").count() == 4


def test_residual_tests(spark):
    df = spark.createDataFrame([(i, float(i), i + (-1.0) ** i) for i in range(50)], "o int, y double, p double")
    row = evaluate.durbin_watson(df, "y", "p", "o").collect()[0]
    assert row["statistic"] == pytest.approx(49 * 4 / 50) and row["interpretation"] == "Negative autocorrelation"
    acf = evaluate.acf(df.withColumn("e", F.col("y") - F.col("p")), "e", "o", 2).orderBy("lag").collect()
    assert acf[1]["autocorrelation"] == pytest.approx(-49 / 50) and acf[2]["autocorrelation"] == pytest.approx(48 / 50)
    assert charts.histogram(df, ["y"], 7).agg(F.sum("n")).collect()[0][0] == 50


def test_split_properties(spark):
    df = spark.range(101).selectExpr("id", "CAST(id AS DOUBLE) AS v", "CASE WHEN id < 10 THEN 'r' ELSE 'c' END AS k", "CAST(id DIV 30 AS TIMESTAMP) AS ts")
    for out, n in (
        (split.split_random(df, "id", 0.3), 31),
        (split.split_stratified(df, "id", "k", 0.3), 31),
        (split.split_stratified(df, "id", "v", 0.3, bins=4), 31),
        (split.split_bias(df, "id", {"v": 1.0, "k": 2.0}, 0.3), 30),
        (split.split_time(df, "id", "ts", 0.3), 31),
        (split.split_bias_frequency(df, "id", "v", 0.2), 20),
    ):
        train, test = split.parts(out)
        assert test.count() == n and train.count() == 101 - n
        assert train.unionByName(test).select("id").distinct().count() == 101
    stratified = split.split_stratified(df, "id", "k", 0.3).where("split = 'test'").groupBy("k").count().collect()
    assert dict((r["k"], r["count"]) for r in stratified) == {"r": 3, "c": 28}
    test = split.parts(split.split_bias(df, "id", {"v": 1.0}, 0.3))[1]
    assert max(r["id"] for r in test.collect()) == 29
    sizes = sorted(r["count"] for r in split.kfold(df, "id", 4).groupBy("fold").count().collect())
    assert sizes == [25, 25, 25, 26]
    with pytest.raises(ValueError):
        split.split_random(df, "id", 1.5)
    want = sorted(range(101), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())[:31]
    got = [r["id"] for r in split.parts(split.split_random(df, "id", 0.3))[1].collect()]
    assert sorted(got) == sorted(want)


def brute(q, c, k, p, exclude):
    out = {}
    for qi, qv in q:
        near = []
        for ci, cv in c:
            if exclude and ci == qi:
                continue
            shared = [(a, b) for a, b in zip(qv, cv) if a is not None and b is not None]
            if not shared:
                continue
            d = sum(abs(a - b) ** p for a, b in shared)
            if len(shared) < len(qv) or any(v is None for v in (*qv, *cv)):
                d *= len(qv) / len(shared)
            near.append((round(d ** (1 / p), 9), ci))
        out[qi] = sorted(near)[:k]
    return out


@pytest.mark.parametrize("p, missing", [(2.0, False), (1.0, False), (2.0, True)])
def test_knn_join_is_exact_over_many_blocks(spark, p, missing):
    rng = random.Random(11)
    rows = []
    for i in range(240):
        v = [0.5, 0.5, 0.5] if i % 3 == 0 else [rng.random() for _ in range(3)]  # a third of all rows coincide
        if missing:
            v = [None if rng.random() < 0.2 else x for x in v]
        rows.append((i, *v))
    df = spark.createDataFrame(rows, "id bigint, a double, b double, c double").repartition(5)
    got = neighbours.knn_join(df, df, "id", "id", ["a", "b", "c"], 4, p, True, allow_missing=missing, block_rows=40, query_rows=60)
    found = {}
    for r in got.orderBy("id", "rank").collect():
        found.setdefault(r["id"], []).append((round(r["distance"], 9), r["neighbour"]))
    want = {i: v for i, v in brute([(r[0], r[1:]) for r in rows], [(r[0], r[1:]) for r in rows], 4, p, True).items() if v}
    assert set(found) == set(want)
    for i in want:
        assert [d for d, _ in found[i]] == [d for d, _ in want[i]]
        if not missing:
            assert found[i] == want[i]


def test_resampling_balances(spark):
    rows = [(i, float(i % 7), float(i % 5), "big" if i < 40 else "tiny") for i in range(52)]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, y string")
    made = resample.smote(df, "id", ["a", "b"], "y")
    assert made.count() == 28 and made.select("y").distinct().count() == 1
    assert resample.append_synthetic(df, made, "id", ["a", "b"], "y").groupBy("y").count().select("count").distinct().count() == 1
    assert resample.undersample(df, "id", "y").groupBy("y").count().collect()[0]["count"] == 12
    box = made.agg(F.min("a"), F.max("a")).collect()[0]
    assert 0.0 <= box[0] and box[1] <= 6.0


def test_exact_kolmogorov_by_enumeration():
    for n1, n2 in itertools.product(range(1, 7), repeat=2):
        gaps = []
        for chosen in itertools.combinations(range(n1 + n2), n1):
            a = np.cumsum(np.isin(np.arange(n1 + n2), chosen))
            gaps.append(int(np.abs(a * n2 - (np.arange(1, n1 + n2 + 1) - a) * n1).max()))
        for g in set(gaps):
            want = sum(x >= g for x in gaps) / len(gaps)
            assert tails.kolmogorov_exact(g / (n1 * n2), n1, n2) == pytest.approx(want, rel=1e-12)
    assert tails.kolmogorov_exact(0.0, 3, 4) == 1.0
    # large samples meet the limiting distribution, and small chances stay positive
    assert tails.kolmogorov_exact(0.03, 5000, 4000) == pytest.approx(tails.kolmogorov_upper(0.03 * (5000 * 4000 / 9000) ** 0.5), rel=0.1)
    assert 0 < tails.kolmogorov_exact(1.0, 40, 40) < 1e-22


def test_ks_uses_the_exact_law_for_small_samples(spark, monkeypatch):
    df = two(spark, [1, 2, 3], [4, 5, 6])
    assert hypothesis.ks_2samp(df, "g", "x")["p_value"] == pytest.approx(0.1)
    monkeypatch.setattr(hypothesis, "EXACT_SAMPLE", 2)
    assert hypothesis.ks_2samp(df, "g", "x")["p_value"] == pytest.approx(tails.kolmogorov_upper(1.5**0.5))


def test_density_with_a_long_tail_equals_the_direct_sum(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, 4000), [2000.0, np.nan]])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
    got = np.array([tuple(r) for r in charts.kde_grid(df, "x", points=4001).orderBy("x").collect()])
    x = x[:-1]
    h = x.std(ddof=1) * len(x) ** -0.2
    want = np.array([np.exp(-0.5 * ((g - x) / h) ** 2).sum() for g in got[:, 0]]) / (len(x) * h * math.sqrt(2 * math.pi))
    assert got[0, 0] == pytest.approx(x.min() - 3 * h) and got[-1, 0] == pytest.approx(x.max() + 3 * h)
    assert np.abs(got[:, 1] - want).max() < 2e-3 * want.max()
    assert charts.kde_grid(df.where("x = 2000"), "x").count() == 0
