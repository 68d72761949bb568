"""Document fingerprints: bottom-k sketches of word-shingle hashes, in DataFrame functions only.

A sketch is the sorted array of the ``k`` smallest distinct 64-bit hashes of a text's shingles.  The
sketch of a union is the k smallest of both sketches (``merge``), so sketches of parts add up to the
sketch of the whole.  A sketch shorter than k holds every shingle and all estimates from it are exact.

* null or wordless texts: the empty sketch; two empty sketches resemble each other fully (1.0), an
  empty and a non-empty one not at all (0.0)
* fewer words than a shingle has: the whole word sequence is the only shingle
* repeated rows: equal texts have equal sketches; nothing depends on other columns
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS = 5
K = 128
BLOCK = 1024  # neighbouring ids that are ordered together
ONE_TASK = 1_000_000  # block numbers that one task may order
BROADCAST_ROWS = 2_000_000  # block heads (24 bytes each) that may be broadcast

SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, also inside higher-order functions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """64-bit hash of every shingle, repeats included."""

    def shingles(h: Column) -> Column:
        last = F.greatest(F.size(h) - words, F.lit(0))
        # positions past the end are null, which the hash skips: short texts give one short shingle
        each = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(words)]))
        return F.when(F.size(h) > 0, each).otherwise(F.array().cast("array<bigint>"))

    return let(word_hashes(text), shingles)


def sketch(text: Column, words: int = WORDS, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, words))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two texts' shingles."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_all(sketches: DataFrame, group: list[str], sketch: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group.  Hot groups are combined in up to 64 parts first, at most k hashes each."""
    hashes = sketches.select(*group, F.explode(sketch).alias("h"), (F.abs(F.hash(sketch)) % 64).alias("lane"))
    least = F.slice(F.sort_array(F.collect_set("h")), 1, k)
    return (
        hashes.groupBy(*group, "lane", "h").agg(F.lit(1).alias("one"))
        .groupBy(*group, "lane").agg(least.alias("part"))
        .select(*group, F.explode("part").alias("h"))
        .groupBy(*group).agg(least.alias(sketch))
    )


def _common(a: Column, b: Column, k: int, use) -> Column:
    """``use(size of the joint sketch, hashes of it that both have)``."""

    def counted(joint: Column) -> Column:
        top = F.element_at(joint, -1)
        both = F.size(F.filter(F.array_intersect(a, b), lambda h: h <= top))
        return F.when(F.size(joint) > 0, use(F.size(joint), both, joint))

    return let(merge(a, b, k), counted)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets."""
    return F.coalesce(_common(a, b, k, lambda n, both, _: both / n), F.lit(1.0))


def distinct_shingles(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(s, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise(F.lit(k - 1.0) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has; 1.0 for an empty a."""
    shared = _common(a, b, k, lambda n, both, joint: both / n * distinct_shingles(joint, k))
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def text_form(s: Column) -> Column:
    return F.concat_ws(" ", s.cast("array<string>"))


def _next_above(keys: DataFrame) -> DataFrame:
    """(key, above): every key of a distinct column ``key`` with the next larger one, null for the last.

    A table of up to ONE_TASK keys is ordered in one task; a larger one in groups of neighbouring
    keys, whose own order is found the same way.
    """
    if keys.count() <= ONE_TASK:
        return keys.select("key", F.lead("key").over(Window.orderBy("key")).alias("above"))
    grouped = keys.withColumn("group", F.floor(F.col("key") / BLOCK))
    inner = grouped.withColumn("above", F.lead("key").over(Window.partitionBy("group").orderBy("key")))
    firsts = grouped.groupBy("group").agg(F.min("key").alias("first"))
    links = _next_above(firsts.select(F.col("group").alias("key")))
    entry = links.join(firsts, F.col("above") == F.col("group")).select(F.col("key").alias("group"), "first")
    return inner.join(entry, "group", "left").select("key", F.coalesce("above", "first").alias("above"))


def _in_order(docs: DataFrame, key: str, text: str):
    """Rows dealt out in blocks, and the window in which ``lead`` reaches the next document.

    Order: descending key; after the last document comes the first.  Rows of one key are ordered by text; null keys come
    last; null texts count as empty.  Texts are shuffled once, in blocks of neighbouring keys; the
    first row of a block also travels to the block before it.
    """
    rows = docs.select(
        F.col(key).cast("bigint").alias("row_key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col(key).cast("bigint") / BLOCK), F.lit(-(2**63))).alias("block"),
    )
    heads = rows.groupBy("block").agg(F.max("row_key").alias("head"))
    order = _next_above(heads.select(F.col("block").alias("key")))
    lowest = heads.agg(F.min("block")).first()[0]
    guests = heads.join(order, F.col("block") == F.col("key")).select(
        F.col("head"), F.col("block").alias("own"), F.coalesce("above", F.lit(lowest).cast("bigint")).alias("visits")
    )
    if order.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        guests = F.broadcast(guests)
    home = F.struct(F.col("block").alias("b"), F.lit(False).alias("guest"))
    away = F.struct(F.col("visits").alias("b"), F.lit(True).alias("guest"))
    travelled = (
        rows.join(guests, (F.col("block") == F.col("own")) & F.col("row_key").eqNullSafe(F.col("head")), "left")
        .select("row_key", "text", F.explode(F.when(F.col("visits").isNull(), F.array(home)).otherwise(F.array(home, away))).alias("place"))
        .select("row_key", "text", "place.b", "place.guest")
        .repartition("b")
    )
    window = Window.partitionBy("b").orderBy("guest", F.col("row_key").desc_nulls_last(), "text")
    return travelled, window


def edited_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Sketches of every text, of its edited form and of the next document.

    Edited: the last floor(n/2) code points are replaced by the first as many (or all) of the next
    document's text.  Columns: key, text, sketch, edited, edited_sketch, next_sketch.
    """
    rows, window = _in_order(docs, key, text)
    sketched = rows.withColumn("sketch", sketch(F.col("text"), k=k))
    paired = sketched.select(
        F.col("row_key").alias(key),
        "text",
        "sketch",
        "guest",
        F.lead("text").over(window).alias("next_text"),
        F.lead("sketch").over(window).alias("next_sketch"),
    ).where(~F.col("guest"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.char_length("text") - half), F.left("next_text", half))
    return paired.select(key, "text", "sketch", edited.alias("edited"), "next_sketch").withColumn(
        "edited_sketch", sketch(F.col("edited"), k=k)
    )
