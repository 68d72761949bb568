"""Seeded demonstration tables.

Every cell is a function of (seed, column, row key), so the tables are reproducible at any
parallelism and one generator serves a million or a trillion rows.  Pass ``base``/``key`` to grow a
table from the keys of an existing one, or use the ``*_rows`` helpers for a plain row count.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col
from ..functions.hashing import hash_hex, hash_int, hash_normal, hash_unit
from ..functions.moments import moments

# The category levels of the demonstration tables.
LETTERS = ["A", "B", "C", "D", "E"]
TEXT_LEVELS = ["high", "medium", "low", "critical", "normal"]
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def keyed_rows(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).withColumnRenamed("id", "row_id")


def _pick(levels: Sequence[str], key: str, seed: object) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in levels]), (hash_int(key, seed, len(levels)) + 1).cast("int"))


def gen_regression(
    base: DataFrame,
    key: str,
    n_float: int = 100,
    n_int: int = 40,
    n_bool: int = 20,
    n_category: int = 30,
    n_text: int = 18,
    seed: int = 42,
    target_mean: float = 50.0,
    target_sd: float = 10.0,
) -> DataFrame:
    """Wide regression table: the target mixes the first column of each kind, rescaled to mean 50, sd 10."""
    feats: dict[str, Column] = {}
    for i in range(n_float):
        feats[f"float_feature_{i}"] = hash_normal(key, f"{seed}f{i}")
    for i in range(n_int):
        feats[f"int_feature_{i}"] = hash_int(key, f"{seed}i{i}", 100)
    for i in range(n_bool):
        feats[f"bool_feature_{i}"] = hash_int(key, f"{seed}b{i}", 2) == 1
    for i in range(n_category):
        feats[f"cat_feature_{i}"] = _pick(LETTERS, key, f"{seed}c{i}")
    for i in range(n_text):
        feats[f"text_feature_{i}"] = _pick(TEXT_LEVELS, key, f"{seed}t{i}")
    df = base.select(col(key), *[c.alias(n) for n, c in feats.items()])
    raw = F.lit(0.1) * hash_normal(key, f"{seed}noise")
    if n_float:
        raw = raw + 2.0 * F.col("float_feature_0")
    if n_int:
        raw = raw + 0.5 * F.col("int_feature_0")
    if n_bool:
        raw = raw + 3.0 * F.col("bool_feature_0").cast("double")
    if n_category:
        raw = raw + (F.col("cat_feature_0") == "A").cast("double")
    if n_text:
        raw = raw + (F.col("text_feature_0") == "high").cast("double")
    df = df.withColumn("target", raw)
    stats = moments(df, ["target"], ["mean", "std_pop"])["target"]
    scale = target_sd / stats["std_pop"] if stats["std_pop"] else 0.0
    return df.withColumn("target", (F.col("target") - F.lit(stats["mean"])) * F.lit(scale) + F.lit(target_mean))


def gen_mixed(base: DataFrame, key: str, per_kind: int = 5, seed: int = 42) -> DataFrame:
    """Boolean, integer, float, 10-letter text, category and date columns with an unrelated target."""
    feats: dict[str, Column] = {}
    for i in range(per_kind):
        feats[f"bool_col_{i}"] = hash_int(key, f"{seed}b{i}", 2) == 1
    for i in range(per_kind):
        feats[f"int_col_{i}"] = hash_int(key, f"{seed}i{i}", 1000)
    for i in range(per_kind):
        feats[f"float_col_{i}"] = hash_unit(key, f"{seed}f{i}") * 1000.0
    for i in range(per_kind):
        digest = hash_hex(key, f"{seed}t{i}")
        feats[f"text_col_{i}"] = F.concat(
            *[
                F.substring(
                    F.lit(ALPHABET),
                    (F.conv(F.substring(digest, 3 * j + 1, 3), 16, 10).cast("int") % len(ALPHABET)) + 1,
                    F.lit(1),
                )
                for j in range(10)
            ]
        )
    for i in range(per_kind):
        feats[f"cat_col_{i}"] = _pick(LETTERS[:4], key, f"{seed}c{i}")
    for i in range(per_kind):
        feats[f"date_col_{i}"] = F.date_add(
            F.lit("2020-01-01").cast("date"), hash_int(key, f"{seed}d{i}", 3650).cast("int")
        ).cast("timestamp")
    feats["target"] = hash_unit(key, f"{seed}y") * 1000.0
    return base.select(col(key), *[c.alias(n) for n, c in feats.items()])


def gen_numeric(base: DataFrame, key: str, per_kind: int = 6, seed: int = 42) -> DataFrame:
    """Noisy integers, normal(50, 10) columns and a skewed category; target is a random linear mix."""
    import random

    rng = random.Random(seed)
    feats: dict[str, Column] = {}
    for i in range(per_kind):
        feats[f"int_col_{i}"] = hash_int(key, f"{seed}i{i}", 100).cast("double") + hash_normal(key, f"{seed}in{i}")
    for i in range(per_kind):
        feats[f"float_col_{i}"] = 50.0 + 10.0 * hash_normal(key, f"{seed}f{i}")
    for i in range(per_kind):
        u = hash_unit(key, f"{seed}c{i}")
        feats[f"cat_col_{i}"] = F.when(u < 0.4, "A").when(u < 0.7, "B").otherwise("C")
    mix = hash_normal(key, f"{seed}noise")
    for name in [n for n in feats if not n.startswith("cat")]:
        mix = mix + F.lit(rng.uniform(-2.0, 2.0)) * F.col(name)
    return base.select(col(key), *[c.alias(n) for n, c in feats.items()]).withColumn("target", mix)


def gen_classification(
    base: DataFrame,
    key: str,
    n_numeric: int = 200,
    n_category: int = 4,
    n_boolean: int = 4,
    null_share: float = 0.05,
    seed: int = 42,
) -> DataFrame:
    """Two classes from the logistic of a linear mix of the first ten numeric columns, with null cells."""
    feats: dict[str, Column] = {}
    for i in range(n_numeric):
        feats[f"numeric_{i}"] = hash_normal(key, f"{seed}n{i}")
    for i in range(n_category):
        feats[f"category_{i}"] = _pick(LETTERS[:4], key, f"{seed}c{i}")
    for i in range(n_boolean):
        feats[f"boolean_{i}"] = hash_int(key, f"{seed}b{i}", 2) == 1
    df = base.select(col(key), *[c.alias(n) for n, c in feats.items()])
    mix = F.lit(0.0)
    for i in range(min(10, n_numeric)):
        mix = mix + F.lit((-1.0) ** i) * F.col(f"numeric_{i}")
    label = (hash_unit(key, f"{seed}y") < 1.0 / (1.0 + F.exp(-mix))).cast("int")
    df = df.withColumn("target", label)
    return inject_missing(df, key, [c for c in feats], {c: null_share for c in feats}, seed=seed)


def inject_missing(
    df: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    share: float | dict[str, float] | tuple[float, float] = (0.05, 0.40),
    seed: int = 42,
    with_replacement: bool = False,
) -> DataFrame:
    """Null out cells at random.

    ``share`` is one rate, a rate per column, or a (low, high) range from which each column draws its
    own rate.  ``with_replacement`` treats a single rate as drawn with replacement over all cells, so
    the share really emptied is 1 - exp(-rate).
    """
    import math
    import random

    columns = [c for c in (columns or df.columns) if c != key]
    if isinstance(share, dict):
        rates = {c: share[c] for c in columns if c in share}
    elif isinstance(share, tuple):
        rates = {c: random.Random(f"{seed}:{c}").uniform(*share) for c in columns}
    else:
        rates = {c: (1.0 - math.exp(-share)) if with_replacement else share for c in columns}
    picks = []
    for name in df.columns:
        if name in rates:
            gone = hash_unit(key, f"{seed}null{name}") < F.lit(rates[name])
            picks.append(F.when(~gone, col(name)).alias(name))
        else:
            picks.append(col(name))
    return df.select(*picks)
