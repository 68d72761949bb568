"""SimHash near-duplicates: fingerprints, multi-index hashing, connected components.

Fingerprint: a bit is set if more than half of the text's shingle hashes (XXH64, seed 42) have it.
Links: fingerprints at most 3 bits apart.  Of two 32-bit segments one then differs in at most one bit,
so every fingerprint is filed under both segments and looks up, per segment, its own value and those
with one of its set bits cleared (of two values one bit apart, exactly one has the bit).  What is found
is verified on the complete distance.  Keys with many fingerprints are cut further: the other segment
has at most 3 differing bits, so one of its 16-bit halves at most one.

* equal fingerprints are one node, so copies never form pairs
* null, empty and blank texts: fingerprint 0, linked like any other
* fewer words than a shingle has: the whole word sequence is the one shingle
* repeated keys are separate rows; null keys never name a component unless it has no other
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import looked_up, over_texts, shuffled, stored

SHINGLE = 3
RADIUS = 3
HOT = 4096  # fingerprints under one segment value beyond which its key is cut further
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BLOCK = 50_000  # hashes whose bits are counted at once


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "replace").translate(LOWER).split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    grams = [words] if len(words) < shingle else zip(*[words[i:] for i in range(shingle)])
    hashes = np.fromiter([digest(s, 42) for s in map(b" ".join, grams)], ">u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), BLOCK):
        ones += np.unpackbits(hashes[i : i + BLOCK].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Columns ``keep`` and ``fp``, the fingerprint as a signed 64-bit number."""

    def make():
        return lambda texts: [pa.array([text_fingerprint(t, shingle) for t in texts], pa.int64())]

    return over_texts(docs, keep, [T.StructField("fp", T.LongType())], make, text)


def _balls(value: str, bits: int) -> str:
    """SQL array of a value and of those with one set bit cleared."""
    cleared = f"transform(filter(sequence(0, {bits - 1}), i -> getbit({value}, i) = 1), i -> {value} - shiftleft(1L, i))"
    return f"concat(array({value}), {cleared})"


def _halves(fp: str) -> str:
    high, low = f"shiftrightunsigned({fp}, 32)", f"{fp} & 4294967295L"
    return f"array(struct(0L as seg, {high} as value, {low} as other), struct(1L as seg, {low} as value, {high} as other))"


def links(fps: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, b): pairs of distinct fingerprints at most RADIUS bits apart; ``fps`` has distinct ``fp``."""
    filed = fps.selectExpr("fp", f"inline({_halves('fp')})")
    table = filed.selectExpr("fp", "seg", "other", "shiftleft(seg, 32) | value as key")
    asks = filed.selectExpr("fp as asker", "other as asker_other", "seg", f"explode({_balls('value', 32)}) as v").selectExpr(
        "asker", "asker_other", "shiftleft(seg, 32) | v as key"
    )
    apart = "bit_count(fp ^ asker)"
    # a pair that both segments find counts where the first one finds it
    once = "(seg = 0 or bit_count(shiftrightunsigned(fp ^ asker, 32)) > 1)"
    # equal segment values find each other from both sides
    sided = "(fp < asker or bit_count((fp ^ asker) & if(seg = 0, -4294967296L, 4294967295L)) > 0)"
    verified = f"fp <> asker and {apart} <= {RADIUS} and {once} and {sided}"

    crowded = table.groupBy("key").count().where(f"count > {hot}").select("key")
    if crowded.isEmpty():
        found = table.join(shuffled(asks), "key").where(verified)
        return found.selectExpr("fp as a", "asker as b")
    cold_asks = asks.join(crowded, "key", "left_anti")
    cold = table.join(crowded, "key", "left_anti").join(shuffled(cold_asks), "key").where(verified)
    parts = "array(struct(0L as half, shiftrightunsigned({0}, 16) as sub), struct(1L as half, {0} & 65535L as sub))"
    filed_again = table.join(crowded, "key", "left_semi").selectExpr("*", f"inline({parts.format('other')})")
    asked_again = (
        asks.join(crowded, "key", "left_semi")
        .selectExpr("asker", "key", f"inline({parts.format('asker_other')})")
        .selectExpr("asker", "key", "half", "sub as own")
    )
    # both sides look up their balls here: the sides of the first lookup are already settled
    flips = "concat(array(own), transform(sequence(0, 15), i -> own ^ shiftleft(1L, i)))"
    asked_again = asked_again.selectExpr("asker", "key", "half", f"explode({flips}) as sub")
    again = filed_again.join(shuffled(asked_again), ["key", "half", "sub"]).where(verified)
    return cold.selectExpr("fp as a", "asker as b").union(again.selectExpr("fp as a", "asker as b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from every node of the edges (a, b).

    Alternates two steps until nothing changes, each a grouped minimum and a join: all larger
    neighbours of a node move to the least neighbour, then all smaller ones do.  Nothing is collected
    but a row count and a checksum per round.
    """
    least, most = F.least("a", "b"), F.greatest("a", "b")
    current = stored(edges.where("a <> b").select(most.alias("u"), least.alias("v")).distinct())
    before = None
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(shuffled(low), "u").where("v > u").selectExpr("v as u", "m as v").where("u <> v").distinct()
        large = stored(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(shuffled(low), "u").selectExpr("inline(array(struct(v as u, m as v), struct(u as u, m as v)))")
        current = stored(moved.where("u > v").distinct())
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            return current.selectExpr("u as node", "v as root")
        before = state


def groups(rows: DataFrame, key: str, hot: int = HOT) -> DataFrame:
    """``rows`` (with ``fp``) and ``component_id``: the smallest key reachable, its own included."""
    nodes = stored(rows.groupBy("fp").agg(F.min(key).alias("low")))
    n = nodes.count()  # no table below has more rows
    roots = components(links(nodes.select("fp"), hot))
    rooted = nodes.join(looked_up(roots, n), F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(looked_up(names, n), "root").select(F.col("fp").alias("node_fp"), "component_id")
    return rows.join(looked_up(named, n), F.col("fp") == F.col("node_fp")).drop("node_fp")
