"""Class balancing: under-sampling, synthetic minority rows, link cleaning and class weights."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, num, num_sql
from ..functions.hashing import hash_hex, hash_int, hash_unit
from ..functions.lineage import materialise
from .engineer import bin_expr, quantile_edges
from .neighbours import knn_join
from .split import hash_thresholds, position_column, stratum, stratum_sizes


def undersample(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """Cut every class at random to the size of the smallest one."""
    sizes = stratum_sizes(df, label)
    least = min(sizes.values())
    marks = hash_thresholds(df, key, seed, {s: [least] for s in sizes}, label)
    return position_column(df, key, seed, marks, label, "__position").where(F.col("__position") == 0).drop("__position")


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives over positives, the weight that balances a binary label."""
    y = num(df, label)
    return df.agg(
        F.count_if(y == 0).alias("negatives"),
        F.count_if(y == 1).alias("positives"),
        F.try_divide(F.count_if(y == 0).cast("double"), F.count_if(y == 1)).alias("scale_pos_weight"),
    )


def with_class_weight(df: DataFrame, label: str, output: str = "weight") -> DataFrame:
    w = class_weight(df, label).collect()[0]["scale_pos_weight"]
    return df.withColumn(output, F.when(num(df, label) == 1, F.lit(w)).otherwise(F.lit(1.0)))


def _copies_by_rank(rows: DataFrame, key: str, n_rows: int, n_new: int, seed: int) -> Column:
    """How many synthetic rows each of ``n_rows`` rows seeds: an even share, the rest by hash order."""
    base, extra = divmod(n_new, n_rows)
    mark = hash_thresholds(rows, key, f"{seed}extra", {"": [extra]})[""][0]
    return F.lit(base) + (hash_hex(key, f"{seed}extra") <= F.lit(mark)).cast("int")


def _synthesise(
    rows: DataFrame,
    near: DataFrame,
    key: str,
    features: Sequence[str],
    copies: Column,
    seed: int,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Points on the segments from each row to hash-chosen ones of its neighbours.

    ``near`` carries the neighbours' vectors (:data:`POINT`); at most k neighbours are gathered per row.
    """
    choices = near.groupBy(col(key).alias("__key")).agg(F.array_sort(F.collect_list(F.struct("rank", POINT))).alias("__near"))
    base = _pointed(rows, features).select(col(key).alias("__key"), POINT, *[col(c) for c in carry], copies.alias("__copies"))
    seeds = base.where(F.col("__copies") > 0).join(choices, "__key")
    copy = seeds.select("*", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))).alias("copy"))
    tag = F.concat_ws(":", F.col("__key").cast("string"), F.col("copy").cast("string"))
    picked = copy.withColumn(
        "__pick", F.get(F.col("__near"), hash_int(tag, f"{seed}pick", F.size("__near").cast("bigint")).cast("int"))
    ).withColumn("__gap", hash_unit(tag, f"{seed}gap"))
    made = F.zip_with(POINT, F.col("__pick")[POINT], lambda a, b: a + F.col("__gap") * (b - a))
    placed = picked.select(F.col("__key").alias("seed_key"), "copy", made.alias("__made"), *[col(c) for c in carry])
    return placed.select("seed_key", "copy", *[F.get("__made", F.lit(i)).alias(f) for i, f in enumerate(features)], *[col(c) for c in carry])


POINT = "__point"  # a row's features as one array: plans with hundreds of columns are slow to optimise


def _pointed(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumn(POINT, F.array(*[num(df, f).cast("double") for f in features]))


def _own_neighbours(rows: DataFrame, key: str, features: Sequence[str], k: int, mode: str) -> DataFrame:
    return knn_join(rows, _pointed(rows, features), key, key, features, k, exclude_self=True, carry=[POINT], mode=mode)


def smote(
    df: DataFrame, key: str, features: Sequence[str], label: str, k: int = 5, seed: int = 42, mode: str = "exact"
) -> DataFrame:
    """Synthetic rows that bring every smaller class up to the largest.

    Returns only the new rows as (seed_key, copy, features..., label); append them to the table with
    :func:`append_synthetic`.  ``mode`` is that of the neighbour join.
    """
    sizes = stratum_sizes(df, label)
    most = max(sizes.values())
    out = None
    for s, n in sizes.items():
        if n == most or n < 2:
            continue
        rows = df.where(stratum(label) == F.lit(s))
        near = _own_neighbours(rows, key, features, min(k, n - 1), mode)
        made = _synthesise(rows, near, key, features, _copies_by_rank(rows, key, n, most - n, seed), seed, [label])
        out = made if out is None else out.unionByName(made)
    return out if out is not None else _empty(df, key, features, [label])


def _empty(df: DataFrame, key: str, features: Sequence[str], carry: Sequence[str]) -> DataFrame:
    return df.limit(0).select(
        col(key).alias("seed_key"), F.lit(1).alias("copy"), *[num(df, f).alias(f) for f in features], *[col(c) for c in carry]
    )


def append_synthetic(df: DataFrame, made: DataFrame, key: str, features: Sequence[str], label: str) -> DataFrame:
    """Original and synthetic rows together; ``row_id`` names a copy by its seed row."""
    real = df.select(col(key).cast("string").alias("row_id"), *[num(df, f).alias(f) for f in features], col(label), F.lit(False).alias("synthetic"))
    new = made.select(
        F.concat_ws(":", F.col("seed_key").cast("string"), F.col("copy").cast("string")).alias("row_id"),
        *[col(f) for f in features],
        col(label),
        F.lit(True).alias("synthetic"),
    )
    return real.unionByName(new)


def adasyn(
    df: DataFrame, key: str, features: Sequence[str], label: str, minority: object, k: int = 5, seed: int = 42, mode: str = "exact"
) -> DataFrame:
    """Synthetic minority rows, more where a row's neighbours belong to other classes.

    A row seeds round(total x its share) copies, its share being its fraction of foreign neighbours
    over the sum of those fractions.
    """
    sizes = stratum_sizes(df, label)
    name = str(minority)
    if name not in sizes:
        raise ValueError(f"no rows of class {minority}")
    total = max(sizes.values()) - sizes[name]
    rows = df.where(stratum(label) == F.lit(name))
    if total == 0 or sizes[name] < 2:
        return _empty(df, key, features, [label])
    around = knn_join(rows, df, key, key, features, k, exclude_self=True, carry=[label], mode=mode)
    ratio = around.groupBy(col(key)).agg(
        F.avg((stratum(label) != F.lit(name)).cast("double")).alias("__ratio")
    )
    whole = ratio.agg(F.sum("__ratio")).collect()[0][0]
    if not whole:
        return _empty(df, key, features, [label])
    weighted = rows.join(ratio, key)
    near = _own_neighbours(rows, key, features, min(k, sizes[name] - 1), mode)
    copies = F.round(F.col("__ratio") / F.lit(whole) * F.lit(float(total))).cast("int")
    return _synthesise(weighted, near, key, features, copies, seed, [label])


def tomek_links(df: DataFrame, key: str, features: Sequence[str], label: str, mode: str = "exact") -> DataFrame:
    """Keys of rows that are each other's nearest neighbour across classes.

    One end of a link is outside the largest class: those rows are asked first, then the rows that
    they point at.  No other row can have a link.
    """
    largest = df.groupBy(stratum(label).alias("s")).count().orderBy(F.desc("count"), "s").first()
    most = largest["s"] if largest else ""
    mine = df.select(col(key).alias("a"), stratum(label).alias("a_label"))

    def pointing(keys: DataFrame) -> DataFrame:
        # written, as the neighbour join counts, tries and deals the rows: each would shuffle the whole table
        asked = materialise(df.join(keys.select(F.col("a").alias("__asked")).distinct(), col(key) == F.col("__asked"), "left_semi"))
        near = knn_join(asked, df, key, key, features, 1, exclude_self=True, carry=[label], mode=mode)
        ends = near.select(col(key).alias("a"), F.col("neighbour").alias("b"), stratum(label).alias("b_label")).join(mine, "a")
        return materialise(ends.where(F.col("a_label") != F.col("b_label")).select("a", "b"))

    first = mine.where(F.col("a_label") != F.lit(most)).select("a")
    one = pointing(first)
    one = one.unionByName(pointing(one.select(F.col("b").alias("a")).join(first, "a", "left_anti")))
    back = one.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return one.join(back, ["a", "b"]).select(F.col("a").alias(key))


def smote_tomek(
    df: DataFrame, key: str, features: Sequence[str], label: str, k: int = 5, seed: int = 42, mode: str = "exact"
) -> DataFrame:
    """SMOTE, then drop both ends of every cross-class mutual-nearest pair."""
    both = materialise(append_synthetic(df, smote(df, key, features, label, k, seed, mode), key, features, label))
    links = tomek_links(both, "row_id", features, label, mode)
    return both.join(links, "row_id", "left_anti")


def smote_regression(
    df: DataFrame, key: str, features: Sequence[str], target: str, bins: int = 5, k: int = 5, seed: int = 42, mode: str = "exact"
) -> DataFrame:
    """Balance the quantile bins of a numeric target; a synthetic row takes its bin's mean target.

    Ties in the quantile edges merge bins, and a bin as large as the largest gets no rows.
    """
    edges = quantile_edges(df, target, bins, duplicates="drop")
    binned = df.withColumn("__bin", F.expr(bin_expr(num_sql(df, target), edges))).where(F.col("__bin").isNotNull())
    made = smote(binned, key, features, "__bin", k, seed, mode)
    means = binned.groupBy("__bin").agg(F.avg(num(df, target)).alias(target))
    # one row per bin
    return made.join(F.broadcast(means), "__bin").select("seed_key", "copy", *[col(f) for f in features], col(target), F.col("__bin").alias("bin"))

