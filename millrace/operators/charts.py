"""The tables behind every figure: bins, boxes, densities, curves and samples."""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tails
from ..functions.columns import col, columns_of, correlation, local_rows, num, present
from ..functions.hashing import hash_unit
from ..functions.moments import moments
from ..functions.quantiles import exact_quantiles
from .ordered import lagged, ordered_scan

REACH = 9.0  # bandwidths a kernel reaches


def bin_counts(df: DataFrame, columns: Sequence[str], edges: dict[str, tuple[float, float]], bins: int) -> dict:
    """{column: [counts]} for equal-width bins, the last one closed on the right."""
    from ..functions.columns import long_form

    bucket = F.lit(None).cast("int")
    for c in columns:
        lo, hi = edges[c]
        width = (hi - lo) / bins
        raw = F.floor((F.col("value") - F.lit(lo)) / F.lit(width)).cast("int")
        inside = (F.col("value") >= F.lit(lo)) & (F.col("value") <= F.lit(hi))
        bucket = F.when((F.col("column") == c) & inside, F.least(raw, F.lit(bins - 1))).otherwise(bucket)
    rows = (
        long_form(df, columns)
        .where(F.col("value").isNotNull())
        .select("column", bucket.alias("bin"))
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    out = {c: [0] * bins for c in columns}
    for r in rows:
        if r["bin"] is not None:
            out[r["column"]][r["bin"]] = r["n"]
    return out


def value_range(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    out = {}
    for c, m in moments(df, columns, ["min", "max"]).items():
        if m["min"] is None:
            continue
        lo, hi = m["min"], m["max"]
        out[c] = (lo, hi) if hi > lo else (lo - 0.5, hi + 0.5)
    return out


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30, shared: bool = False) -> DataFrame:
    """Equal-width histogram of every column from one grouped scan; ``shared`` uses common edges."""
    edges = value_range(df, columns)
    columns = [c for c in columns if c in edges]
    if shared and edges:
        both = (min(e[0] for e in edges.values()), max(e[1] for e in edges.values()))
        edges = {c: both for c in columns}
    counts = bin_counts(df, columns, edges, bins)
    rows = []
    for c in columns:
        lo, hi = edges[c]
        step = (hi - lo) / bins
        for i, n in enumerate(counts[c]):
            rows.append((c, i, lo + i * step, hi if i == bins - 1 else lo + (i + 1) * step, n))
    return local_rows(df.sparkSession, rows, "column string, bin int, left double, right double, n bigint")


def boxplot_stats(df: DataFrame, value: str, group: str | None = None, max_groups: int = 200) -> DataFrame:
    """Quartiles, whiskers (last value within 1.5 IQR) and outlier count, overall or per group.

    Groups become columns (their number is checked), so quartiles of a hot group go through the same
    size-safe path as those of a whole column.
    """
    if group is None:
        labels = [None]
        wide = df.select(num(df, value).alias("v0"))
    else:
        found = df.where(col(group).isNotNull()).select(col(group).cast("string").alias("g")).distinct().limit(max_groups + 1).collect()
        if len(found) > max_groups:
            raise ValueError(f"{group} has more than {max_groups} groups")
        labels = sorted(r["g"] for r in found)
        wide = df.select(
            *[F.when(col(group).cast("string") == g, num(df, value)).alias(f"v{i}") for i, g in enumerate(labels)]
        )
    names = [f"v{i}" for i in range(len(labels))]
    q = exact_quantiles(wide, {v: [0.25, 0.5, 0.75] for v in names})
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, v in enumerate(names):
        if q[v][0] is None:
            continue
        reach = 1.5 * (q[v][2] - q[v][0])
        x = F.col(v)
        inside = (x >= F.lit(q[v][0] - reach)) & (x <= F.lit(q[v][2] + reach))
        aggs += [
            F.min(F.when(inside, x)).alias(f"lo{i}"),
            F.max(F.when(inside, x)).alias(f"hi{i}"),
            F.count_if(~inside).alias(f"out{i}"),
            F.count(x).alias(f"n{i}"),
        ]
    row = wide.agg(*aggs).collect()[0]
    rows = [
        (labels[i], row[f"n{i}"], q[v][0], q[v][1], q[v][2], row[f"lo{i}"], row[f"hi{i}"], row[f"out{i}"])
        for i, v in enumerate(names)
        if q[v][0] is not None
    ]
    return local_rows(
        df.sparkSession,
        rows,
        "label string, n bigint, q1 double, median double, q3 double, whisker_low double, whisker_high double, n_outliers bigint",
    )


def kde_grid(df: DataFrame, column: str, points: int = 200, fine: int = 8, cut: float = 3.0) -> DataFrame:
    """Gaussian density on a grid with Scott's bandwidth.

    Values are counted in bins of a ``fine``-th of the bandwidth, of which only occupied ones exist, so
    long tails cost nothing in resolution.  Every bin meets the grid points within REACH bandwidths;
    beyond them the kernel adds less than 1e-17.
    """
    m = moments(df, [column], ["n", "std"])[column]
    if m["n"] < 2 or not m["std"]:
        return local_rows(df.sparkSession, [], "x double, density double")
    lo, hi = value_range(df, [column])[column]
    h = m["std"] * m["n"] ** (-0.2)
    width, start = h / fine, lo - cut * h
    step = (hi + cut * h - start) / (points - 1)
    lit = lambda v: F.lit(float(v))
    value = num(df, column)
    bins = df.where(value.isNotNull()).groupBy(F.floor((value - lit(lo)) / lit(width)).alias("bin")).agg(F.count("*").alias("c"))
    centre = lit(lo) + (F.col("bin") + 0.5) * lit(width)
    first = F.greatest(F.lit(0), F.ceil((centre - lit(REACH * h) - lit(start)) / lit(step)))
    last = F.least(F.lit(points - 1), F.floor((centre + lit(REACH * h) - lit(start)) / lit(step)))
    near = F.when(first <= last, F.sequence(first.cast("int"), last.cast("int"))).otherwise(F.array().cast("array<int>"))
    met = bins.select("c", centre.alias("centre"), F.explode(near).alias("i"))
    z = (lit(start) + F.col("i") * lit(step) - F.col("centre")) / lit(h)
    sums = met.groupBy("i").agg(F.sum(F.col("c") * F.exp(-0.5 * z * z)).alias("s"))
    found = {r["i"]: r["s"] for r in sums.collect()}  # at most `points` rows
    scale = m["n"] * h * math.sqrt(2 * math.pi)
    rows = [(start + i * step, found.get(i, 0.0) / scale) for i in range(points)]
    return local_rows(df.sparkSession, rows, "x double, density double")


def ecdf(df: DataFrame, column: str) -> DataFrame:
    """Share of values at or below each distinct value."""
    counts = (
        df.select(num(df, column).alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = df.agg(F.count(num(df, column))).collect()[0][0]
    scan = ordered_scan(counts, [F.col("value")], {"cum": F.col("n")})
    return scan.select("value", (F.col("cum") / F.lit(float(total or 1))).alias("share"))


def frequency_bars(df: DataFrame, column: str, top_n: int | None = None) -> DataFrame:
    """Rows per value, nulls counted as a value, most frequent first."""
    counts = df.groupBy(present(df, column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.orderBy(F.desc("n"), F.asc_nulls_last("value"))
    return counts.limit(top_n) if top_n else counts


def qq_points(df: DataFrame, column: str, points: int = 99) -> DataFrame:
    """Sample quantiles against standard normal quantiles on an even grid of probabilities."""
    probs = [(i + 0.5) / points for i in range(points)]
    q = exact_quantiles(df, {column: probs})[column]
    rows = [(p, tails.normal_quantile(p), v) for p, v in zip(probs, q) if v is not None]
    return local_rows(df.sparkSession, rows, "probability double, theoretical double, sample double")


def lag_points(df: DataFrame, value: str, order: str, lag: int = 1, share: float = 1.0, seed: int = 42) -> DataFrame:
    """(order, value, value ``lag`` rows earlier), optionally a hash sample of the points.

    ``order`` should be unique; rows that it leaves equal follow each other by value.
    """
    slim = df.select(col(order).alias("order"), num(df, value).alias("value"))
    out = lagged(slim, [F.col("order")], [lag], "value").where(F.col(f"value_lag{lag}").isNotNull())
    out = out.select("order", F.col(f"value_lag{lag}").alias("previous"), "value")
    return out if share >= 1.0 else out.where(hash_unit("order", seed) < F.lit(share))


def residual_order(df: DataFrame, y_true: str, y_pred: str, order: str) -> DataFrame:
    """Residuals against their 0-based position; rows of equal ``order`` follow each other by residual."""
    slim = df.select(col(order).alias("order"), (num(df, y_true) - num(df, y_pred)).alias("residual"))
    return ordered_scan(slim, [F.col("order"), F.col("residual")], index="position").select("position", "residual")


def scatter_sample(df: DataFrame, x: str, y: str, key: str, share: float, seed: int = 42) -> DataFrame:
    """A reproducible share of the (x, y) points."""
    return df.where(hash_unit(key, seed) < F.lit(share)).select(col(key), num(df, x).alias("x"), num(df, y).alias("y"))


def fit_line(df: DataFrame, x: str, y: str) -> DataFrame:
    a, b = num(df, y), num(df, x)
    xs, ys = F.when(a.isNotNull(), b), F.when(b.isNotNull(), a)
    slope = F.try_divide(F.covar_pop(a, b), F.var_pop(xs))
    r = correlation(a, b)
    return df.agg(slope.alias("slope"), (F.avg(ys) - slope * F.avg(xs)).alias("intercept"), (r * r).alias("r2"))


def heatmap(df: DataFrame, columns: Sequence[str] | None = None, method: str = "pearson") -> DataFrame:
    """Lower triangle of the correlation matrix."""
    from .explore import corr_matrix

    return corr_matrix(df, method, columns or columns_of(df, "numeric"), lower_only=True)
