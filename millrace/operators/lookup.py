"""Joining a table with a table of per-value results, whatever the skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import SMALL_VALUES

# A value holding more than 1/HOT_SHARE of the rows is hot; there can be at most HOT_SHARE of them.
HOT_SHARE = 10_000
MIN_HOT = 100_000  # rows of one value that any single task can hold


def lookup_join(
    big: DataFrame,
    key: Column,
    table: DataFrame,
    value: str,
    n: str,
    small: bool | None = None,
    share: int = HOT_SHARE,
    least: int = MIN_HOT,
) -> DataFrame:
    """Left join ``big`` with ``table`` (unique on ``value``, ``n`` rows each) on ``key``.

    A table counted as small is broadcast.  Otherwise only its hot values are: there are at most
    ``share`` of those by counting, and with them gone no join key is large enough to fill a
    task, so the remaining rows take an ordinary shuffled join.  Values of up to ``least`` rows are not hot.
    """
    if small is None:
        small = table.limit(SMALL_VALUES + 1).count() <= SMALL_VALUES
    if small:
        return big.join(F.broadcast(table.drop(n)), key == F.col(value), "left").drop(value)
    total, most = table.agg(F.sum(n), F.max(n)).collect()[0]
    if not total or most <= max(total / share, least):
        return big.join(table.drop(n), key == F.col(value), "left").drop(value)
    is_hot = F.col(n) > F.lit(max(total / share, least))
    hot, cold = table.where(is_hot).drop(n), table.where(~is_hot).drop(n)
    keyed = big.withColumn("__key", key)
    with_hot = keyed.join(F.broadcast(hot), F.col("__key") == F.col(value), "inner").drop(value, "__key")
    no_key = keyed.where(F.col("__key").isNull()).drop("__key")
    rest = (
        keyed.where(F.col("__key").isNotNull())
        .join(F.broadcast(hot.select(value)), F.col("__key") == F.col(value), "left_anti")
        .join(cold, F.col("__key") == F.col(value), "left")
        .drop(value, "__key")
    )
    return with_hot.unionByName(rest).unionByName(no_key, allowMissingColumns=True)
