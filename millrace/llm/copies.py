"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Exact, by prefix filter.  All shingles have one total order; two sets that share SIMILAR of their union
share a shingle among the first n - ceil(SIMILAR * n) + 1 of each.  The order puts shingles that many
texts of a sample have last, the most frequent at the very end; the sample shapes the order and with it the time, never
a result.  Within what shares a shingle, all are first held against the least and the greatest member;
where that does not link all of them, the pairs of different components are verified whose sizes and places
of the shingle leave room for enough common ones (true of every similar pair at its first common shingle).

Before two sets are compared, their parities are: the number of shingles per hash bucket modulo 2, about a bit
per shingle.  Where they differ, a shingle is in one set only, so more such bits than similar sets can have
shingles apart rule a pair out, with certainty; full sets travel for the few pairs that are left.

* words are split at blanks, A to Z in lower case; a text of fewer words is one shingle
* equal sets are one node, known by a 64-bit hash, so copies never form pairs
* null, empty and blank texts have the empty set and are copies of each other
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import _pieces, looked_up, over_texts, shuffled, stored
from .simhash import LOWER, components, links, text_fingerprint

SHINGLE = 5
SIMILAR = (4, 5)  # Jaccard similarity as a fraction
SAMPLE = 10_000  # texts, about, whose shingles are counted for the order
FREQUENT = 3  # texts of the sample
HOT = 200_000  # frequent shingles that may be sent to every task


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    words = (text or "").encode("utf-8", "replace").translate(LOWER).split()
    if not words:
        return np.zeros(0, np.int64)
    digest = xxhash.xxh64_intdigest
    grams = [words] if len(words) < SHINGLE else zip(*[words[i:] for i in range(SHINGLE)])
    return np.unique(np.fromiter(map(digest, map(b" ".join, grams)), np.uint64).view(np.int64))


def _prefix(hashes: np.ndarray, hot: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The first shingles in the common order: rare ones by hash, then ``hot`` ones by ``place``."""
    size, (num, den) = len(hashes), SIMILAR
    if not size:
        return hashes
    if len(hot):
        at = np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)
        is_hot = hot[at] == hashes
        hashes = np.concatenate([hashes[~is_hot], hashes[is_hot][np.argsort(place[at[is_hot]])]])
    return hashes[: size + (-num * size) // den + 1]


def parity(hashes: np.ndarray) -> np.ndarray:
    """Number of shingles modulo 2 in each of 2^k buckets, 64 to a word; at least as many bits as shingles."""
    bits = 1 << max(7, (len(hashes) - 1).bit_length())
    counts = np.bincount(hashes & (bits - 1), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)


def _apart(a: str, b: str) -> str:
    """Least number of shingles in one set only: bits that differ, the longer parity folded once."""
    fold = lambda x: f"zip_with(slice({x}, 1, size({x}) div 2), slice({x}, size({x}) div 2 + 1, size({x}) div 2), (x, y) -> x ^ y)"
    left = f"if(size({a}) > size({b}), {fold(a)}, {a})"
    right = f"if(size({b}) > size({a}), {fold(b)}, {b})"
    return f"aggregate(zip_with({left}, {right}, (x, y) -> bit_count(x ^ y)), 0, (n, x) -> n + x)"


def frequent(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles that several texts of a sample have, and their places in the order."""
    share = min(1.0, SAMPLE / max(1, docs.count()))
    draw = F.pmod(F.xxhash64(F.lit(5), text), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = docs.where(draw < share).select(text).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch, 0):
                sets = [shingle_set(t) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets))], names=["token"])
        pa.default_memory_pool().release_unused()

    counts = some.mapInArrow(run, "token bigint").groupBy("token").agg(F.count("*").alias("n")).where(f"n >= {FREQUENT}")
    top = counts.orderBy(F.desc("n"), "token").limit(HOT).toPandas()  # at most HOT rows, the most frequent first
    tokens, place = top["token"].to_numpy(np.int64), -np.arange(len(top))
    order = np.argsort(tokens)
    return tokens[order], place[order]


def marked(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` with sig (hash of the set), size (of the set), prefix, parity and fp (SimHash)."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent(docs, text))

    def make():
        hot, place = shared.value

        def compute(texts: list) -> list[pa.Array]:
            sets = [shingle_set(t) for t in texts]
            sigs = np.array([xxhash.xxh64_intdigest(s.tobytes(), 7) for s in sets], np.uint64).view(np.int64)
            prefixes = pa.array([_prefix(s, hot, place) for s in sets], pa.list_(pa.int64()))
            parities = pa.array([parity(s) for s in sets], pa.list_(pa.int64()))
            fps = pa.array([text_fingerprint(t) for t in texts], pa.int64())
            return [pa.array(sigs), pa.array([len(s) for s in sets], pa.int32()), prefixes, parities, fps]

        return compute

    fields = [
        T.StructField("sig", T.LongType()), T.StructField("size", T.IntegerType()), T.StructField("prefix", T.ArrayType(T.LongType())),
        T.StructField("parity", T.ArrayType(T.LongType())), T.StructField("fp", T.LongType()),
    ]
    return over_texts(docs, keep, fields, make, text)


def by_number(rows: DataFrame, numbers: DataFrame, how: str) -> DataFrame:
    """Join on ``at``; few numbers are sent to every task, so that the texts stay where they are."""
    numbers = stored(numbers)
    return rows.join(looked_up(numbers, numbers.count()), "at", how)


def _possible(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and parities allow the similarity."""
    num, den = SIMILAR
    both = pairs
    for x in "ab":
        both = both.join(shuffled(marks.selectExpr(f"at as {x}", f"size as n{x}", f"parity as p{x}")), x)
    near = both.where(f"{den} * na >= {num} * nb and {den} * nb >= {num} * na")
    return near.where(f"({num} + {den}) * {_apart('pa', 'pb')} <= ({den} - {num}) * (na + nb)").select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar; sets are made again for their texts only."""
    num, den = SIMILAR
    pairs = stored(pairs)
    wanted = by_number(texts, pairs.selectExpr("a as at").union(pairs.selectExpr("b as at")).distinct(), "left_semi")
    fields = [T.StructField("tokens", T.ArrayType(T.LongType()))]
    make = lambda: lambda batch: [pa.array([shingle_set(t) for t in batch], pa.list_(pa.int64()))]
    sets = stored(over_texts(wanted, ["at"], fields, make))
    left, right = sets.selectExpr("at as a", "tokens as of_a"), sets.selectExpr("at as b", "tokens as of_b")
    both = pairs.join(shuffled(left), "a").join(shuffled(right), "b").withColumn("common", F.size(F.array_intersect("of_a", "of_b")))
    return both.where(f"{den} * common >= {num} * (size(of_a) + size(of_b) - common)").select("a", "b")


def fingerprint_links(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fp, head, size) of all heads, and (a, b): pairs of fingerprints that are equal or linked.

    ``rows`` has sig, size, fp and at; rows of one sig are one node, whatever fingerprints they have.
    """
    heads = rows.groupBy("sig").agg(F.min("at").alias("head"), F.max("size").alias("size"))
    held = stored(rows.select("sig", "fp").distinct().join(shuffled(heads), "sig").select("fp", "head", "size"))
    fps = stored(held.select("fp").distinct())
    return held, stored(links(fps).union(fps.selectExpr("fp as a", "fp as b")))


def first_heads(held: DataFrame, linked: DataFrame) -> DataFrame:
    """(a, b): every head and the least one of its fingerprint, and the least ones of linked fingerprints."""
    least = stored(held.groupBy("fp").agg(F.min("head").alias("rep")))
    n = least.count()
    equal = held.join(looked_up(least, n), "fp").selectExpr("rep as a", "head as b")
    near = linked.join(looked_up(least.selectExpr("fp as a", "rep as x"), n), "a").join(looked_up(least.selectExpr("fp as b", "rep as y"), n), "b")
    return equal.union(near.selectExpr("least(x, y) as a", "greatest(x, y) as b")).where("a <> b").distinct()


def other_heads(held: DataFrame, linked: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b): all heads of equal or linked fingerprints but those that ``known`` has in one group already."""
    num, den = SIMILAR
    named = held.join(looked_up(known, known.count()), F.col("head") == F.col("node"), "left")
    named = stored(named.select("fp", "head", "size", F.coalesce("root", "head").alias("root")))
    span = named.groupBy("fp").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    for x in "ab":
        linked = linked.join(shuffled(span.selectExpr(f"fp as {x}", f"lo as lo_{x}", f"hi as hi_{x}")), x)
    pairs = linked.where("least(lo_a, lo_b) < greatest(hi_a, hi_b)").select("a", "b")
    for x in "ab":
        pairs = pairs.join(shuffled(named.selectExpr(f"fp as {x}", f"head as h{x}", f"size as n{x}", f"root as r{x}")), x)
    pairs = pairs.where(f"ra <> rb and {den} * na >= {num} * nb and {den} * nb >= {num} * na")
    return pairs.selectExpr("least(ha, hb) as a", "greatest(ha, hb) as b").distinct()


def roots(rows: DataFrame) -> DataFrame:
    """(node, root): for numbers linked with a smaller one, the least linked.

    ``rows`` is stored and has sig, size, prefix, parity, text and the unique number ``at``; of the rows with
    one sig, the one of the least number stands for all.  With a column fp, all pairs linked by SimHash fingerprints are
    verified, or in one group already, beside those of the prefixes, which find what the fingerprints miss.
    """
    heads = rows.groupBy("sig").agg(F.min("at").alias("head"))
    copied = rows.select("sig", "at").join(shuffled(heads), "sig").where("at <> head").select("at")
    nodes = by_number(rows.select("at", "size", "prefix"), copied, "left_anti")
    num, den = SIMILAR
    marks, texts = rows.select("at", "size", "parity"), rows.select("at", "text")
    each = nodes.select("at", "size", F.posexplode("prefix").alias("place", "token")).repartition("token")
    ends = each.groupBy("token").agg(F.min("at").alias("lo"), F.max("at").alias("hi")).where("lo < hi")
    shared = stored(each.join(shuffled(ends), "token"))

    first = shared.selectExpr("at", "inline(array(struct(lo as b), struct(hi as b)))").where("at <> b")
    first = first.select(F.least("at", "b").alias("a"), F.greatest("at", "b").alias("b"))
    held, linked = fingerprint_links(rows) if "fp" in rows.columns else (None, None)
    first = (first.union(first_heads(held, linked)) if held is not None else first).distinct()
    first = stored(_possible(first, marks))
    edges = stored(_verified(first, texts))
    known = components(edges)
    n_known = known.count()
    left = F.col("size") - F.col("place")  # this shingle and those behind it
    named = shared.join(looked_up(known, n_known), F.col("at") == F.col("node"), "left")
    named = named.select("token", "at", F.coalesce("root", "at").alias("root"), "size", left.alias("left"))
    named = stored(named)
    several = named.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("token")
    named = stored(named.join(shuffled(several), "token", "left_semi"))
    a, b = (named.selectExpr("token", f"at as {x}", f"root as r{x}", f"size as n{x}", f"left as l{x}") for x in "ab")
    # similar sets share enough from their first common shingle on
    enough = f"({num} + {den}) * least(la, lb) >= {num} * (na + nb)"
    rest = a.join(shuffled(b), "token").where(f"a < b and ra <> rb and {enough}").select("a", "b")
    rest = (rest.union(other_heads(held, linked, known)) if held is not None else rest).distinct()
    rest = _possible(rest.join(shuffled(first), ["a", "b"], "left_anti"), marks)  # those were found unlike
    return components(edges.union(_verified(rest, texts)))
