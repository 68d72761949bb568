"""Hypothesis tests.

Each test is one or two grouped aggregates; only group totals reach the driver, where the p-value is
computed.  Rank tests work on the table of distinct values with their multiplicities, ordered once.
Results are dictionaries (``None`` where a test does not apply); :func:`as_table` lays them out.
"""

from __future__ import annotations

import math
from typing import Any, Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tails
from ..functions.columns import col, columns_of, local_rows, num
from ..functions.hashing import hash_hex
from ..functions.lineage import materialise
from ..functions.moments import moments
from ..functions.quantiles import exact_quantiles
from .ordered import average_ranks, ordered_scan

MAX_GROUPS = 1000
EXACT_PAIRS = 50
EXACT_GROUP = 8
EXACT_SAMPLE = 10_000
EXACT_TERMS = 10_000_000  # numbers held for an exact distribution; the normal one agrees to 1e-6 there


def _present(df: DataFrame, group: str, value: str) -> DataFrame:
    slim = df.select(col(group).cast("string").alias("g"), num(df, value).alias("x"))
    return slim.where(F.col("g").isNotNull() & F.col("x").isNotNull())


def group_moments(df: DataFrame, group: str, value: str) -> dict[str, dict[str, float]]:
    rows = (
        _present(df, group, value)
        .groupBy("g")
        .agg(
            F.count("x").alias("n"),
            F.avg("x").alias("mean"),
            F.var_samp("x").alias("var"),
            F.var_pop("x").alias("var_pop"),
        )
        .collect()
    )
    return {r["g"]: r.asDict() for r in sorted(rows, key=lambda r: r["g"])}


# ---------------------------------------------------------------- normality


def normality_from(n: int, skew: float | None, kurt: float | None) -> dict[str, Any] | None:
    """D'Agostino-Pearson K2 from population skewness and excess kurtosis."""
    if n < 8 or skew is None or kurt is None or math.isnan(skew) or math.isnan(kurt):
        return None
    y = skew * math.sqrt((n + 1.0) * (n + 3.0) / (6.0 * (n - 2.0)))
    b = 3.0 * (n * n + 27.0 * n - 70.0) * (n + 1.0) * (n + 3.0) / ((n - 2.0) * (n + 5.0) * (n + 7.0) * (n + 9.0))
    w2 = math.sqrt(2.0 * (b - 1.0)) - 1.0
    z_skew = math.asinh(y / math.sqrt(2.0 / (w2 - 1.0))) / math.sqrt(0.5 * math.log(w2))
    expected = 3.0 * (n - 1.0) / (n + 1.0)
    spread = 24.0 * n * (n - 2.0) * (n - 3.0) / ((n + 1.0) ** 2 * (n + 3.0) * (n + 5.0))
    x = (kurt + 3.0 - expected) / math.sqrt(spread)
    root = 6.0 * (n * n - 5.0 * n + 2.0) / ((n + 7.0) * (n + 9.0))
    root *= math.sqrt(6.0 * (n + 3.0) * (n + 5.0) / (n * (n - 2.0) * (n - 3.0)))
    a = 6.0 + 8.0 / root * (2.0 / root + math.sqrt(1.0 + 4.0 / (root * root)))
    below = 1.0 + x * math.sqrt(2.0 / (a - 4.0))
    third = math.copysign(((1.0 - 2.0 / a) / abs(below)) ** (1.0 / 3.0), below) if below else 0.0
    z_kurt = (1.0 - 2.0 / (9.0 * a) - third) / math.sqrt(2.0 / (9.0 * a))
    k2 = z_skew * z_skew + z_kurt * z_kurt
    p = math.exp(-k2 / 2.0)
    return {"statistic": k2, "p_value": p, "is_normal": p > 0.05}


def normality(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """K2 test of every column from one fused aggregate."""
    columns = list(columns) if columns is not None else columns_of(df, "numeric")
    rows = []
    for c, m in moments(df, columns, ["n", "skew_pop", "kurt_pop"]).items():
        got = normality_from(m["n"], m["skew_pop"], m["kurt_pop"])
        if got:
            rows.append((c, got["statistic"], got["p_value"], got["is_normal"]))
    return local_rows(df.sparkSession, rows, "column string, statistic double, p_value double, is_normal boolean")


# ---------------------------------------------------------------- means


def _two(groups: Mapping[str, Any]) -> tuple | None:
    labels = sorted(groups)
    return (groups[labels[0]], groups[labels[1]]) if len(labels) >= 2 else None


def ttest(df: DataFrame, group: str, value: str) -> dict[str, Any] | None:
    """Pooled two-sample t of the two smallest labels."""
    return ttest_from(_two(group_moments(_first_two(df, group, value), group, value)))


def ttest_from(pair) -> dict[str, Any] | None:
    if pair is None or pair[0]["n"] < 2 or pair[1]["n"] < 2:
        return None
    a, b = pair
    dof = a["n"] + b["n"] - 2
    pooled = ((a["n"] - 1) * a["var"] + (b["n"] - 1) * b["var"]) / dof
    if pooled == 0:
        return None
    t = (a["mean"] - b["mean"]) / math.sqrt(pooled * (1.0 / a["n"] + 1.0 / b["n"]))
    return {"statistic": t, "p_value": tails.student_two_sided(t, dof), "dof": float(dof)}


def ttest_welch(df: DataFrame, group: str, value: str) -> dict[str, Any] | None:
    pair = _two(group_moments(_first_two(df, group, value), group, value))
    if pair is None or pair[0]["n"] < 2 or pair[1]["n"] < 2:
        return None
    a, b = pair
    va, vb = a["var"] / a["n"], b["var"] / b["n"]
    if va + vb == 0:
        return None
    t = (a["mean"] - b["mean"]) / math.sqrt(va + vb)
    dof = (va + vb) ** 2 / (va * va / (a["n"] - 1) + vb * vb / (b["n"] - 1))
    return {"statistic": t, "p_value": tails.student_two_sided(t, dof), "dof": dof}


def anova_from(groups: Sequence[Mapping[str, float]]) -> dict[str, Any] | None:
    """One-way F from n, mean and population variance per group; groups of one are left out."""
    groups = [g for g in groups if g["n"] > 1]
    if len(groups) < 2:
        return None
    n = sum(g["n"] for g in groups)
    grand = sum(g["n"] * g["mean"] for g in groups) / n
    between = sum(g["n"] * (g["mean"] - grand) ** 2 for g in groups)
    within = sum(g["n"] * g["var_pop"] for g in groups)
    d1, d2 = len(groups) - 1, n - len(groups)
    if within == 0 or d2 <= 0:
        return None
    f = (between / d1) / (within / d2)
    return {"statistic": f, "p_value": tails.f_upper(f, d1, d2), "dof": float(d1)}


def anova(df: DataFrame, group: str, value: str) -> dict[str, Any] | None:
    """One-way F; the groups' moments are added up in Spark, so there may be any number of them."""
    groups = _present(df, group, value).groupBy("g").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("var_pop")
    )
    groups = groups.where("n > 1")
    n, mean = F.col("n"), F.col("mean")
    row = groups.agg(
        F.count(F.lit(1)).alias("k"), F.sum(n).alias("n"), F.sum(n * F.col("var_pop")).alias("within"), (F.sum(n * mean) / F.sum(n)).alias("grand")
    ).collect()[0]
    if row["k"] < 2:
        return None
    between = groups.agg(F.sum(n * (mean - F.lit(row["grand"])) ** 2)).collect()[0][0]
    d1, d2 = row["k"] - 1, row["n"] - row["k"]
    if row["within"] == 0 or d2 <= 0:
        return None
    f = (between / d1) / (row["within"] / d2)
    return {"statistic": f, "p_value": tails.f_upper(f, d1, d2), "dof": float(d1)}


def levene(df: DataFrame, first: str, second: str) -> dict[str, Any] | None:
    """Median-centred Levene test of two columns."""
    q = exact_quantiles(df, {first: [0.5], second: [0.5]})
    if q[first][0] is None or q[second][0] is None:
        return None
    parts = []
    for i, c in enumerate((first, second)):
        d = F.abs(num(df, c) - F.lit(q[c][0]))
        parts += [F.count(d).alias(f"n{i}"), F.avg(d).alias(f"mean{i}"), F.var_pop(d).alias(f"var_pop{i}")]
    row = df.agg(*parts).collect()[0]
    return anova_from([{k: row[f"{k}{i}"] for k in ("n", "mean", "var_pop")} for i in (0, 1)])


# ---------------------------------------------------------------- ranks


def rank_summary(df: DataFrame, group: str, value: str) -> dict[str, Any]:
    """Everything the rank tests need: n and rank sum per label, tie term, and the ECDF gap.

    Labels are few (checked), so the multiplicities of a value are one grouped row with a count per
    label; the distinct values are ordered once and give ranks and both running counts together.
    """
    slim = _present(df, group, value)
    sizes = slim.groupBy("g").agg(F.count("x").alias("n")).limit(MAX_GROUPS + 1).collect()
    if len(sizes) > MAX_GROUPS:
        raise ValueError(f"{group} has more than {MAX_GROUPS} groups")
    n = {r["g"]: r["n"] for r in sorted(sizes, key=lambda r: r["g"])}
    labels = list(n)
    if len(labels) < 2:
        return {"n": n, "rank_sum": {}, "ties": 0.0, "gap": None}
    counts = slim.groupBy("x").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("g") == g).alias(f"k{i}") for i, g in enumerate(labels)]
    )
    counts = materialise(counts)  # read by the size check, the range sample and the scan
    a, b = F.col("k0"), F.col("k1")
    scan = ordered_scan(counts, [F.col("x")], {"cum": F.col("n"), "cum0": a, "cum1": b})
    rank = F.col("cum") - F.col("n") + (F.col("n") + 1) / F.lit(2.0)
    many = F.col("n").cast("double")
    row = scan.agg(
        F.sum(many * many * many - many).alias("ties"),
        F.max(F.abs(F.col("cum0") / F.lit(float(n[labels[0]])) - F.col("cum1") / F.lit(float(n[labels[1]])))).alias("gap"),
        *[F.sum(F.col(f"k{i}") * rank).alias(f"r{i}") for i in range(len(labels))],
    ).collect()[0]
    return {
        "n": n,
        "rank_sum": {g: row[f"r{i}"] for i, g in enumerate(labels)},
        "ties": row["ties"],
        "gap": row["gap"],
    }


def _exact_u_p(u: float, n1: int, n2: int) -> float:
    """Two-sided exact p of U by counting arrangements.

    The arrangements with U = s are the coefficients of a product over i = 1 .. min(n1, n2) of
    (1 - q^(max + i)) / (1 - q^i).  They are symmetric, so only those up to the smaller tail are made,
    each from terms of lower order, and their share of all arrangements is the p-value.
    """
    few, many = sorted((n1, n2))
    tail = math.floor(min(u, n1 * n2 - u))
    counts = np.zeros(tail + 1)
    counts[0] = 1.0
    for i in range(1, few + 1):
        if many + i <= tail:
            counts[many + i :] -= counts[: -(many + i)].copy()
        for start in range(min(i, tail + 1)):
            counts[start::i] = np.cumsum(counts[start::i])
    return min(1.0, 2.0 * float(counts.sum()) / math.comb(n1 + n2, few))


def mannwhitney_from(s: Mapping[str, Any]) -> dict[str, Any] | None:
    if len(s["n"]) < 2:
        return None
    a, b = list(s["n"])[:2]
    n1, n2 = s["n"][a], s["n"][b]
    u = s["rank_sum"][a] - n1 * (n1 + 1) / 2.0
    if s["ties"] == 0 and min(n1, n2) <= EXACT_GROUP and n1 * n2 <= EXACT_TERMS:
        return {"statistic": u, "p_value": _exact_u_p(u, n1, n2)}
    n = n1 + n2
    sd = math.sqrt(n1 * n2 / 12.0 * ((n + 1.0) - s["ties"] / (n * (n - 1.0))))
    if sd == 0:
        return {"statistic": u, "p_value": 1.0}
    z = (max(u, n1 * n2 - u) - n1 * n2 / 2.0 - 0.5) / sd
    return {"statistic": u, "p_value": min(1.0, math.erfc(z / math.sqrt(2.0)))}


def ks_from(s: Mapping[str, Any]) -> dict[str, Any] | None:
    """Two-sample Kolmogorov-Smirnov; exact p-value up to EXACT_SAMPLE rows of a label, else asymptotic.

    The exact one is that of untied samples; with ties it errs on the large side.
    """
    if len(s["n"]) < 2:
        return None
    n1, n2 = list(s["n"].values())[:2]
    if max(n1, n2) <= EXACT_SAMPLE:
        return {"statistic": s["gap"], "p_value": tails.kolmogorov_exact(s["gap"], n1, n2)}
    root = math.sqrt(n1 * n2 / (n1 + n2))
    return {"statistic": s["gap"], "p_value": tails.kolmogorov_upper(root * s["gap"])}


def _first_two(df: DataFrame, group: str, value: str | None = None) -> DataFrame:
    """Rows of the two smallest labels, of those that have a ``value`` if one is named."""
    usable = df.where(col(group).isNotNull() & (num(df, value).isNotNull() if value else F.lit(True)))
    labels = usable.select(col(group).cast("string").alias("g")).distinct().orderBy("g").limit(2)
    names = [r["g"] for r in labels.collect()]
    return df.where(col(group).cast("string").isin(names))


def kruskal(df: DataFrame, group: str, value: str) -> dict[str, Any] | None:
    """Rank test of any number of groups: ranks of the distinct values, joined with (value, group) counts."""
    cells = materialise(_present(df, group, value).groupBy("x", "g").agg(F.count(F.lit(1)).alias("k")))
    values = average_ranks(cells.groupBy(F.col("x").alias("value")).agg(F.sum("k").alias("n")))
    many = F.col("n").cast("double")
    ties = values.agg(F.sum(many * many * many - many)).collect()[0][0]
    by_group = cells.join(values, F.col("x") == F.col("value")).groupBy("g").agg(
        F.sum("k").alias("size"), F.sum(F.col("k") * F.col("avg_rank")).alias("r")
    )
    row = by_group.agg(F.count(F.lit(1)).alias("groups"), F.sum("size").alias("n"), F.sum(F.col("r") ** 2 / F.col("size")).alias("s")).collect()[0]
    if row["groups"] < 2:
        return None
    n = float(row["n"])
    correction = 1.0 - ties / (n**3 - n)
    if correction == 0:
        return None
    h = (12.0 / (n * (n + 1.0)) * row["s"] - 3.0 * (n + 1.0)) / correction
    return {"statistic": h, "p_value": tails.chi2_upper(h, row["groups"] - 1), "dof": float(row["groups"] - 1)}


def mannwhitney(df: DataFrame, group: str, value: str) -> dict[str, Any] | None:
    return mannwhitney_from(rank_summary(_first_two(df, group), group, value))


def ks_2samp(df: DataFrame, group: str, value: str) -> dict[str, Any] | None:
    return ks_from(rank_summary(_first_two(df, group), group, value))


def wilcoxon(df: DataFrame, first: str | Column, second: str | Column) -> dict[str, Any] | None:
    """Signed-rank test of paired columns of the same row; zero differences are dropped."""
    x = num(df, first) if isinstance(first, str) else first
    y = num(df, second) if isinstance(second, str) else second
    d = df.select((x - y).alias("d"))
    zeros = F.count_if(F.col("d") == 0).alias("zeros")
    n_zero = d.agg(zeros).collect()[0][0]
    counts = (
        d.where(F.col("d").isNotNull() & (F.col("d") != 0))
        .groupBy(F.abs("d").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("d") > 0).alias("up"))
    )
    scan = ordered_scan(counts, [F.col("value")], {"cum": F.col("n")})
    rank = F.col("cum") - F.col("n") + (F.col("n") + 1) / F.lit(2.0)
    many = F.col("n").cast("double")
    row = scan.agg(
        F.sum("n").alias("n"), F.sum(F.col("up") * rank).alias("plus"), F.sum(many * many * many - many).alias("ties")
    ).collect()[0]
    n = row["n"]
    if not n:
        return None
    total = n * (n + 1) / 2.0
    w = min(row["plus"], total - row["plus"])
    if n <= EXACT_PAIRS and not n_zero and row["ties"] == 0:
        counts_ = [1]
        for r in range(1, n + 1):  # distribution of the rank sum
            longer = counts_ + [0] * r
            for s, c in enumerate(counts_):
                longer[s + r] += c
            counts_ = longer
        p = min(1.0, 2.0 * sum(counts_[: int(w) + 1]) / 2.0**n)
    else:
        sd = math.sqrt((n * (n + 1.0) * (2.0 * n + 1.0) - row["ties"] / 2.0) / 24.0)
        p = tails.normal_two_sided((w - total / 2.0) / sd) if sd else 1.0
    return {"statistic": w, "p_value": p}


def paired_by_order(df: DataFrame, group: str, value: str, order: str, sample: bool = False) -> DataFrame | None:
    """Rows of the two groups matched by their position, or None when the sizes differ.

    With ``sample`` both groups are shuffled by hash instead and the longer one is cut to the length
    of the shorter by the join.
    """
    base = df.select(col(group).cast("string").alias("g"), num(df, value).alias("x"), col(order).alias("o"))
    base = base.where(F.col("g").isNotNull() & F.col("x").isNotNull())
    first = [r["g"] for r in base.select("g").distinct().orderBy("g").limit(2).collect()]
    base = base.where(F.col("g").isin(first))
    sizes = sorted(base.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect())
    if len(sizes) < 2 or (sizes[0]["n"] != sizes[1]["n"] and not sample):
        return None
    if sample:
        base = base.withColumn("o", hash_hex("o", "pairs"))
    sides = [
        ordered_scan(base.where(F.col("g") == s["g"]).select("x", "o"), [F.col("o")]).select(
            "row_index", F.col("x").alias(f"x{i}")
        )
        for i, s in enumerate(sizes[:2])
    ]
    return sides[0].join(sides[1], "row_index")


# ---------------------------------------------------------------- counts


def contingency(df: DataFrame, first: str, second: str) -> DataFrame:
    """Observed counts of two columns with their expectation under independence, empty cells included."""
    rows = (
        df.where(col(first).isNotNull() & col(second).isNotNull())
        .groupBy(col(first).cast("string").alias("a"), col(second).cast("string").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
        .limit(MAX_GROUPS * MAX_GROUPS + 1)
        .collect()
    )
    if len(rows) > MAX_GROUPS * MAX_GROUPS:
        raise ValueError("too many cells for a contingency table")
    seen = {(r["a"], r["b"]): r["n"] for r in rows}
    left, right = sorted({k[0] for k in seen}), sorted({k[1] for k in seen})
    total = sum(seen.values())
    ra = {a: sum(seen.get((a, b), 0) for b in right) for a in left}
    rb = {b: sum(seen.get((a, b), 0) for a in left) for b in right}
    cells = [(a, b, seen.get((a, b), 0), ra[a] * rb[b] / total) for a in left for b in right]
    return local_rows(df.sparkSession, cells, "first string, second string, observed bigint, expected double")


def chi2_contingency(df: DataFrame, first: str, second: str) -> dict[str, Any] | None:
    """Independence test; two-by-two tables get the continuity correction."""
    cells = (
        df.where(col(first).isNotNull() & col(second).isNotNull())
        .groupBy(col(first).cast("string").alias("a"), col(second).cast("string").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cells = materialise(cells)
    rows, columns = (cells.groupBy(k).agg(F.sum("n").alias(f"n_{k}")) for k in "ab")
    r, total = rows.agg(F.count(F.lit(1)), F.sum("n_a")).collect()[0]
    c = columns.count()
    dof = (r - 1) * (c - 1)
    if dof <= 0:
        return None
    # cells nobody is in add their expectation, and all expectations add up to the total
    expected = F.col("n_a") * F.col("n_b") / F.lit(float(total))
    gap = F.abs(F.col("n") - expected)
    if dof == 1:
        gap = gap - F.least(F.lit(0.5), gap)
    seen = cells.join(rows, "a").join(columns, "b").agg(F.sum(gap * gap / expected), F.sum(expected), F.count(F.lit(1))).collect()[0]
    stat = seen[0]
    if dof > 1:
        stat += max(0.0, total - seen[1])
    elif seen[2] < 4:  # a two-by-two table with an empty cell
        stat = _two_by_two(df, first, second)
    return {"statistic": stat, "p_value": tails.chi2_upper(stat, dof), "dof": float(dof)}


def _two_by_two(df: DataFrame, first: str, second: str) -> float:
    stat = 0.0
    for x in contingency(df, first, second).collect():
        gap = abs(x["observed"] - x["expected"])
        stat += (gap - min(0.5, gap)) ** 2 / x["expected"]
    return stat


# ---------------------------------------------------------------- batteries


def as_table(df: DataFrame, results: Mapping[str, Mapping[str, Any] | None]) -> DataFrame:
    rows = [
        (name, r["statistic"] if r else None, r["p_value"] if r else None, r.get("dof") if r else None)
        for name, r in results.items()
    ]
    return local_rows(df.sparkSession, rows, "test string, statistic double, p_value double, dof double")


def two_sample_battery(df: DataFrame, group: str, value: str, order: str | None = None) -> DataFrame:
    """t, Wilcoxon (equal sizes and an order column only), Mann-Whitney and Kolmogorov-Smirnov together."""
    df = _first_two(df, group)
    ranks = rank_summary(df, group, value)
    pairs = paired_by_order(df, group, value, order) if order else None
    return as_table(
        df,
        {
            "ttest": ttest(df, group, value),
            "wilcoxon": wilcoxon(pairs, "x0", "x1") if pairs is not None else None,
            "mannwhitney": mannwhitney_from(ranks),
            "ks": ks_from(ranks),
        },
    )


def compare_distributions(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Mann-Whitney, Kolmogorov-Smirnov and location/spread of the two smallest labels, per column."""
    pair = _first_two(df, group)
    rows = []
    for c in columns:
        ranks = rank_summary(pair, group, c)
        labels = list(ranks["n"])
        mw, ks = mannwhitney_from(ranks), ks_from(ranks)
        stats = group_moments(pair, group, c)
        split = pair.select(
            *[F.when(col(group).cast("string") == g, num(pair, c)).alias(f"v{i}") for i, g in enumerate(labels)]
        )
        q = exact_quantiles(split, {f"v{i}": [0.25, 0.5, 0.75] for i in range(len(labels))})
        for i, g in enumerate(labels):
            q1, med, q3 = q[f"v{i}"]
            rows.append(
                (
                    c,
                    g,
                    stats[g]["mean"],
                    med,
                    math.sqrt(stats[g]["var_pop"]),
                    q3 - q1,
                    mw["statistic"] if mw else None,
                    mw["p_value"] if mw else None,
                    ks["statistic"] if ks else None,
                    ks["p_value"] if ks else None,
                )
            )
    return local_rows(
        df.sparkSession,
        rows,
        "column string, label string, mean double, median double, std double, iqr double, mannwhitney double, "
        "mannwhitney_p double, ks double, ks_p double",
    )


def median_split_tests(df: DataFrame, columns: Sequence[str], order: str | None = None) -> DataFrame:
    """Split each column at its median and run the two-sample battery on the halves."""
    medians = exact_quantiles(df, {c: [0.5] for c in columns})
    rows = []
    for c in columns:
        med = medians[c][0]
        if med is None:
            continue
        keep = [num(df, c).alias("x"), F.when(num(df, c) <= F.lit(med), "1").otherwise("2").alias("half")]
        halves = df.where(num(df, c).isNotNull()).select(*keep, *([col(order).alias("o")] if order else []))
        tests = {r["test"]: r for r in two_sample_battery(halves, "half", "x", "o" if order else None).collect()}
        sizes = {r["half"]: r["n"] for r in halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).collect()}
        rows.append(
            (c, med, sizes.get("1", 0), sizes.get("2", 0))
            + tuple(v for t in ("ttest", "wilcoxon", "mannwhitney", "ks") for v in (tests[t]["statistic"], tests[t]["p_value"]))
        )
    parts = ", ".join(f"{t} double, {t}_p double" for t in ("ttest", "wilcoxon", "mannwhitney", "ks"))
    return local_rows(df.sparkSession, rows, f"column string, median double, n_low bigint, n_high bigint, {parts}")


# Names of the tests in results.
METHODS = {
    "pearson": "Pearson",
    "spearman": "Spearman",
    "ttest": "T-Test",
    "wilcoxon": "Wilcoxon",
    "mannwhitneyu": "Mann-Whitney U",
    "anova": "ANOVA",
    "kruskal": "Kruskal-Wallis",
    "ks": "KS Test",
    "chi2": "Chi-Square",
}


def stats_analysis(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    target: str = "target",
    methods: Sequence[str] | str = ("pearson",),
    max_groups: int = 20,
    order: str | None = None,
) -> DataFrame:
    """Run the named tests of columns against a target: (column, method, statistic, p-value).

    Two-group tests apply where the column has exactly two values, the several-group tests otherwise.
    """
    from .convert import distinct_counts
    from .explore import corr_pairs

    wanted = {methods} if isinstance(methods, str) else set(methods)
    unknown = wanted - set(METHODS)
    if unknown:
        raise ValueError(f"unknown methods {sorted(unknown)}")
    absent = [c for c in columns or [] if c not in df.columns]
    if absent:
        raise ValueError(f"columns {absent} not in the table")
    numeric = columns_of(df, "numeric")
    others = columns_of(df, "string", "boolean")
    sizes = distinct_counts(df, others)
    groups = [c for c in (columns or others) if c in others and (columns or sizes[c] <= max_groups)]
    rows: list[tuple] = []

    def add(column, method, got):
        if got is not None and got["statistic"] is not None:
            rows.append((column, METHODS[method], round(got["statistic"], 4), round(got["p_value"], 6)))

    correlations = [m for m in ("pearson", "spearman") if m in wanted]
    if correlations:
        xs = [c for c in (columns or numeric) if c in numeric]
        if columns:
            pairs = [(x, target) for x in xs if x != target and target in numeric]
        else:
            pairs = [(x, y) for x in xs for y in xs if x != y]
        names = sorted({c for p in pairs for c in p})
        if names:
            found = {(r["column_1"], r["column_2"], r["method"]): r for r in corr_pairs(df, names, correlations).collect()}
            for x, y in pairs:
                for m in correlations:
                    r = found.get((x, y, m)) or found[(y, x, m)]
                    add(x, m, {"statistic": r["correlation"], "p_value": r["p_value"]})
    if target in numeric:
        for c in groups:
            k = sizes[c]
            if k == 2:
                if "ttest" in wanted:
                    add(c, "ttest", ttest(df, c, target))
                if "wilcoxon" in wanted and order:
                    pairs_ = paired_by_order(df, c, target, order, sample=True)
                    add(c, "wilcoxon", wilcoxon(pairs_, "x0", "x1") if pairs_ is not None else None)
                if "mannwhitneyu" in wanted:
                    add(c, "mannwhitneyu", mannwhitney(df, c, target))
            elif k > 2:
                if "anova" in wanted:
                    add(c, "anova", anova(df, c, target))
                if "kruskal" in wanted:
                    add(c, "kruskal", kruskal(df, c, target))
                if "ks" in wanted:
                    add(c, "ks", ks_2samp(df, c, target))
    if "chi2" in wanted:
        if columns:
            pairs = [(c, target) for c in groups if target in others and c != target]
        else:
            pairs = [(a, b) for i, a in enumerate(groups) for b in groups[i + 1 :]]
        for a, b in pairs:
            add(a, "chi2", chi2_contingency(df, a, b))
    return local_rows(df.sparkSession, rows, "column string, method string, statistic double, p_value double")

