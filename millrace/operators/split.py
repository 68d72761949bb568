"""Train/test splits, folds and exact-size random selection.

A random order is the order of ``md5(seed:key)``.  To take exactly n rows we look for the n-th
smallest hash: rows are counted by hash prefix (a map-side-combined aggregate), the prefix holding
the n-th row is refined until its few hashes can be read, and the choice becomes the comparison
``hash <= threshold``.  Nothing is sorted or shuffled, and any engine can repeat the choice.
"""

from __future__ import annotations

import math
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, columns_of, dtype_of, is_float, local_rows, num, num_sql
from ..functions.hashing import hash_hex, hash_unit
from ..functions.moments import moments
from ..functions.quantiles import order_statistics
from .engineer import bin_expr, quantile_edges

PREFIX_STEP = 3
READ_LIMIT = 200_000
MAX_STRATA = 100_000
NO_STRATUM = "\u0000missing"
ABOVE_ALL = "g"  # sorts after every hex digit


def stratum(column: str | Column | None) -> Column:
    if column is None:
        return F.lit("")
    c = col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(NO_STRATUM))


def hash_thresholds(
    df: DataFrame,
    key: str | Sequence[str],
    seed: object,
    takes: Mapping[str, Sequence[int]],
    strata: str | Column | None = None,
) -> dict[str, list[str]]:
    """{stratum: [hash]}: the rows with hash <= threshold are exactly the first n of their stratum."""
    base = df.select(stratum(strata).alias("s"), hash_hex(key, seed).alias("h"))
    sizes: dict[str, int] = {}
    out: dict[str, list[str | None]] = {s: [None] * len(ns) for s, ns in takes.items()}
    # open requests: stratum, slot, prefix found so far, rows still to take inside it
    todo = [(s, i, "", n) for s, ns in takes.items() for i, n in enumerate(ns)]
    width = 0
    while todo:
        step = PREFIX_STEP
        while step > 1 and len(takes) * 16**step > 10 * READ_LIMIT:
            step -= 1
        width += step
        scope = base
        if width > step:
            wanted = sorted({f"{s}/{p}" for s, _, p, _ in todo})
            scope = base.where(F.concat("s", F.lit("/"), F.substring("h", 1, width - step)).isin(wanted))
        rows = scope.groupBy("s", F.substring("h", 1, width).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        buckets: dict[tuple[str, str], list[tuple[str, int]]] = {}
        for r in rows:
            buckets.setdefault((r["s"], r["p"][: width - step]), []).append((r["p"], r["n"]))
        if width == step:
            for (s, _), ps in buckets.items():
                sizes[s] = sum(n for _, n in ps)
        refined, inside = [], {}
        for s, i, prefix, n in todo:
            if n <= 0:
                out[s][i] = ""
                continue
            if width == step and n >= sizes.get(s, 0):
                out[s][i] = ABOVE_ALL
                continue
            left = n
            for p, m in sorted(buckets.get((s, prefix), [])):
                if left <= m:
                    refined.append((s, i, p, left))
                    inside[(s, p)] = m
                    break
                left -= m
        todo = refined
        if todo and (sum(inside.values()) <= READ_LIMIT or width >= 30):
            wanted = sorted({f"{s}/{p}" for s, _, p, _ in todo})
            rows = base.where(F.concat("s", F.lit("/"), F.substring("h", 1, width)).isin(wanted)).collect()
            hashes: dict[tuple[str, str], list[str]] = {}
            for r in rows:
                hashes.setdefault((r["s"], r["h"][:width]), []).append(r["h"])
            for s, i, p, n in todo:
                out[s][i] = sorted(hashes[(s, p)])[n - 1]
            todo = []
    return out


def stratum_sizes(df: DataFrame, strata: str | Column | None) -> dict[str, int]:
    rows = df.groupBy(stratum(strata).alias("s")).agg(F.count(F.lit(1)).alias("n")).limit(MAX_STRATA + 1).collect()
    if len(rows) > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} strata")
    return {r["s"]: r["n"] for r in rows}


def position_column(
    df: DataFrame,
    key: str | Sequence[str],
    seed: object,
    thresholds: Mapping[str, Sequence[str]],
    strata: str | Column | None,
    output: str,
) -> DataFrame:
    """Number of the thresholds of its stratum that a row's hash exceeds."""
    h = hash_hex(key, seed)
    if strata is None:
        marks = thresholds.get("", [])
        return df.withColumn(output, sum([(h > F.lit(m)).cast("int") for m in marks], F.lit(0)))
    table = local_rows(df.sparkSession, [(s, list(ms)) for s, ms in thresholds.items()], "__s string, __marks array<string>")
    keyed = df.withColumn("__stratum", stratum(strata)).withColumn("__h", h)
    # one row per stratum, all of them read from the driver a moment ago
    joined = keyed.join(F.broadcast(table), F.col("__stratum") == F.col("__s"), "left")
    passed = F.size(F.filter("__marks", lambda m: F.col("__h") > m))
    return joined.withColumn(output, passed).drop("__s", "__marks", "__stratum", "__h")


def _labelled(df: DataFrame, is_test: Column, output: str = "split") -> DataFrame:
    return df.withColumn(output, F.when(is_test, "test").otherwise("train"))


def parts(df: DataFrame, column: str = "split") -> tuple[DataFrame, DataFrame]:
    """(train, test) of a table labelled by one of the split functions."""
    return df.where(F.col(column) == "train").drop(column), df.where(F.col(column) == "test").drop(column)


def split_random(
    df: DataFrame, key: str, test_size: float = 0.3, seed: int = 42, mode: str = "exact"
) -> DataFrame:
    """Label rows train/test; exactly ceil(n x test_size) test rows, or about that many in one pass (approx)."""
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must lie between 0 and 1")
    if mode == "approx":
        return _labelled(df, hash_unit(key, seed) < F.lit(test_size))
    n_test = math.ceil(df.count() * test_size)
    mark = hash_thresholds(df, key, seed, {"": [n_test]})[""][0]
    return _labelled(df, hash_hex(key, seed) <= F.lit(mark))


def allocate(sizes: Mapping[str, int], total: int) -> dict[str, int]:
    """Share ``total`` over the strata in proportion, whole numbers by largest remainder."""
    n = sum(sizes.values())
    exact = {s: total * m / n for s, m in sizes.items()}
    out = {s: math.floor(x) for s, x in exact.items()}
    spare = total - sum(out.values())
    for s in sorted(sizes, key=lambda s: (-round(exact[s] - out[s], 9), s))[:spare]:
        out[s] += 1
    return out


def strata_of(df: DataFrame, target: str, bins: int = 10) -> Column:
    """The target itself, or its quantile bin when it is a floating point column."""
    if not is_float(dtype_of(df, target)):
        return stratum(target)
    return stratum(F.expr(bin_expr(num_sql(df, target), quantile_edges(df, target, bins, duplicates="drop"))))


def split_stratified(
    df: DataFrame, key: str, target: str, test_size: float = 0.3, bins: int = 10, seed: int = 42
) -> DataFrame:
    """Test share the same in every class (or quantile bin of a float target)."""
    return split_by_strata(df, key, strata_of(df, target, bins), test_size, seed)


def split_by_strata(df: DataFrame, key: str, strata: str | Column, test_size: float, seed: int) -> DataFrame:
    sizes = stratum_sizes(df, strata)
    takes = allocate(sizes, math.ceil(sum(sizes.values()) * test_size))
    marks = hash_thresholds(df, key, seed, {s: [n] for s, n in takes.items()}, strata)
    placed = position_column(df, key, seed, marks, strata, "__position")
    return _labelled(placed, F.col("__position") == 0).drop("__position")


def first_rows(df: DataFrame, value: Column, key: str, n: int, seed: int) -> Column:
    """Condition true for exactly the first ``n`` rows by (value, hash of key), without sorting."""
    if n <= 0:
        return F.lit(False)
    cutoff = order_statistics(df, {"v": value}, {"v": [n - 1]})["v"][n - 1]
    below = df.agg(F.count_if(value < F.lit(cutoff)).alias("n")).collect()[0][0]
    ties = df.where(value == F.lit(cutoff))
    mark = hash_thresholds(ties, key, seed, {"": [n - below]})[""][0]
    return (value < F.lit(cutoff)) | ((value == F.lit(cutoff)) & (hash_hex(key, seed) <= F.lit(mark)))


def bias_score(df: DataFrame, weights: Mapping[str, float]) -> Column:
    """Weighted sum of z-scores of float columns; any other column adds its weight to every row with a value."""
    floats = [c for c in weights if is_float(dtype_of(df, c))]
    stats = moments(df, floats, ["mean", "std"])
    total = F.lit(0.0)
    for c, w in weights.items():
        if c in stats:
            z = F.try_divide(num(df, c) - F.lit(stats[c]["mean"]), F.lit(stats[c]["std"]))
            total = total + F.lit(float(w)) * z
        else:
            total = total + F.lit(float(w)) * col(c).isNotNull().cast("double")
    return total


def split_bias(df: DataFrame, key: str, weights: Mapping[str, float], test_size: float = 0.3, seed: int = 42) -> DataFrame:
    """The rows with the lowest bias score are the test set."""
    scored = df.withColumn("__score", bias_score(df, weights))
    n_test = int(df.count() * test_size)
    return _labelled(scored, first_rows(scored, F.col("__score"), key, n_test, seed)).drop("__score")


def split_time(df: DataFrame, key: str, time: str, test_size: float = 0.3, seed: int = 42) -> DataFrame:
    """The latest rows are the test set; rows of the cut-off instant are divided in hash order."""
    n_train = int(df.count() * (1.0 - test_size))
    instant = F.unix_micros(col(time).cast("timestamp"))
    return _labelled(df, ~first_rows(df, instant, key, n_train, seed))


def split_cluster(
    df: DataFrame, key: str, target: str, test_size: float = 0.2, n_clusters: int = 5, seed: int = 42
) -> DataFrame:
    """Stratify by k-means cluster of the standardised numeric features."""
    from .models import cluster_labels

    features = columns_of(df, "numeric", exclude=[target, key])
    if not features:
        raise ValueError("cluster split needs numeric features")
    labelled = cluster_labels(df, features, n_clusters, seed, "__cluster")
    return split_by_strata(labelled, key, "__cluster", test_size, seed).drop("__cluster")


def split_bias_frequency(
    df: DataFrame, key: str, target: str, test_size: float = 0.2, bins: int = 10, seed: int = 42
) -> DataFrame:
    """Test rows drawn without replacement with weight 1 / size of their target bin.

    Weighted sampling by exponential keys: the n largest ln(u) / weight win.
    """
    edges = quantile_edges(df, target, bins, duplicates="drop")
    binned = df.withColumn("__bin", F.expr(bin_expr(num_sql(df, target), edges)))
    sizes = {r["__bin"]: r["n"] for r in binned.groupBy("__bin").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = F.lit(None).cast("double")
    for b, n in sizes.items():
        if b is not None:
            size = F.when(F.col("__bin") == b, F.lit(float(n))).otherwise(size)
    draw = -F.log(1.0 - hash_unit(key, seed)) * size
    n_test = int(df.count() * test_size)
    drawn = binned.withColumn("__draw", draw)
    return _labelled(drawn, F.coalesce(first_rows(drawn, F.col("__draw"), key, n_test, seed), F.lit(False))).drop("__bin", "__draw")


def kfold(df: DataFrame, key: str, n_splits: int = 5, target: str | None = None, seed: int = 42, output: str = "fold") -> DataFrame:
    """Add the fold number; fold sizes differ by at most one (per class with a target)."""
    if n_splits < 2:
        raise ValueError("n_splits must be at least 2")
    strata = stratum(target) if target else None
    sizes = stratum_sizes(df, strata)
    takes = {}
    for s, n in sizes.items():
        base, extra = divmod(n, n_splits)
        takes[s] = [base * (i + 1) + min(i + 1, extra) for i in range(n_splits - 1)]
    marks = hash_thresholds(df, key, seed, takes, strata)
    return position_column(df, key, seed, marks, strata, output)
