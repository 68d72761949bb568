"""Weighted rendezvous hashing of stable record keys, in DataFrame functions only.

Every (key, shard) pair gets a uniform draw u from a hash; the key goes to the shard with the smallest
-ln(u) / weight.  The choice depends on the key and the shards alone: adding a shard moves only the
records that it wins, removing one moves only its own.

* equal keys share a shard, whatever their other columns; copies of a text under other keys do not
* null keys are one key; null texts have no bytes
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 7
OVERHEAD = 16  # bytes a record takes besides its text
BLOCK_ROWS = 50_000  # rows of a shard that are numbered together


def _score(key: Column, shard: Column, weight: Column | float, seed: int) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), key, shard), 11).cast("double")
    return -F.log((bits + 0.5) / F.lit(2.0**53)) / weight


def shard_of(key: Column, weights: Sequence[float], seed: int = SEED) -> Column:
    """Number of the shard that wins the key; shards of weight 0 or less take nothing."""
    live = [(i, float(w)) for i, w in enumerate(weights) if w > 0]
    if not live:
        raise ValueError("no shard has a weight above 0")
    shards = F.array(*[F.struct(F.lit(i).alias("s"), F.lit(w).alias("w")) for i, w in live])
    scored = F.transform(shards, lambda x: F.struct(_score(key, x["s"], x["w"], seed).alias("score"), x["s"].alias("s")))
    return F.array_min(scored)["s"]


def assign(
    docs: DataFrame,
    weights: Sequence[float],
    grown: Sequence[float] | None = None,
    key: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
) -> DataFrame:
    """key, size, text_crc32, shard, slot, grown_shard for every row.

    ``slot`` numbers the rows of a shard from 0 without gaps.  A shard is numbered in hashed blocks
    of about BLOCK_ROWS rows, each in its own group; block totals give the offsets.  Texts stay where
    they are: only numbers are shuffled.
    """
    k, body = F.col(key), F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        k.alias(key),
        (F.octet_length(body) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(F.encode(body, "utf-8")).alias("text_crc32"),
        shard_of(k, weights, seed).alias("shard"),
        (shard_of(k, grown, seed) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    total = docs.count()
    blocks = max(1, -(-total // (BLOCK_ROWS * len(weights))))
    placed = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), F.col(key), F.col("text_crc32")), F.lit(blocks)))
    window = Window.partitionBy("shard", "block").orderBy(key, "text_crc32", "size")
    totals = placed.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("shard", "block", F.coalesce(before, F.lit(0)).alias("offset"))
    numbered = placed.withColumn("rank", F.row_number().over(window) - 1)
    return numbered.join(offsets, ["shard", "block"]).select(
        key, "size", "text_crc32", "shard", (F.col("offset") + F.col("rank")).cast("bigint").alias("slot"), "grown_shard"
    )
