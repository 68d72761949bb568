"""Quality rules: hashed n-gram log-likelihood ratio between trusted and raw text.

Words of every text are cut into byte 3-grams and 4-grams (a space stands before and behind a word) that
are hashed to BUCKETS buckets.  Two multinomials are counted: over every document, and over all
documents labelled quality 1.  A document's score is the mean of log(trusted / raw) over its
n-grams.  The threshold is where all labelled documents separate best (share of good documents kept plus
share of bad ones dropped, the lowest such point that keeps KEEP_GOOD of the good ones); it depends on nothing else, and equal texts share a
verdict.

* null or wordless texts have score 0 and fail the base rules
* no labelled document of either quality: nothing is dropped beyond the base rules
* repeated rows count and are judged as often as they occur
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from ..operators.ordered import ordered_scan
from .batches import _pieces, known_labels, over_texts, stored
from .tokens import Table, gram_hashes, laid_out, per_text

BUCKETS = 1 << 16
ORDERS = (3, 4)
SENT = 3_000_000  # labelled ids that may be sent to every task; more are joined by a shuffle
SMOOTHING = 0.5
KEEP_GOOD = 0.99  # share of the trusted documents that any threshold must keep
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MANY = 1 << 21  # distinct words of a batch up to which three of them fit a number


def _buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all words, and how many each word has."""
    padded = [b" " + w + b" " for w in words]
    flat, lengths = laid_out(padded, np.uint8)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(flat)) - np.repeat(starts, lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    hashes = gram_hashes(flat, max(ORDERS))
    found, owners = [], []
    for n in ORDERS:
        whole = place >= n - 1
        found.append((hashes[n - 1][whole] % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(owner[whole])
    return np.concatenate(found), np.concatenate(owners)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(label_id, label): all labelled ids of documents; with ``limit`` half of it of each class at most, in hash order."""
    one = known_labels(docs, labels, label, key, text).where("label in (0, 1)")
    if limit is None:
        return one
    order = F.xxhash64(F.lit(5), "label_id"), F.col("label_id")
    return one.where("label = 1").orderBy(*order).limit(limit // 2).union(one.where("label = 0").orderBy(*order).limit(limit // 2))


def _sent(ids: DataFrame) -> DataFrame:
    """Marked for being sent to every task, so that texts stay where they are, if counted as few enough."""
    return F.broadcast(ids) if ids.count() <= SENT else ids


def counted(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(bucket, raw, target): n-gram counts over all documents and over the trusted ones.

    Every task adds up its own documents, so at most BUCKETS rows per task are shuffled.
    """
    own = docs.select(col(key).alias("key"), col(text).alias("text"))
    marked = own.join(_sent(trusted.where("label = 1")), F.col("key") == F.col("label_id"), "left")
    picked = marked.select("text", F.coalesce(F.col("label") == 1, F.lit(False)).alias("good"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        known: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for part in _pieces(batch, 0):
                texts = [_words(t) for t in part.column(0).to_pylist()]
                good = np.repeat(part.column(1).to_numpy(zero_copy_only=False), list(map(len, texts)))
                flat = [w for t in texts for w in t]
                distinct = list(dict.fromkeys(flat))
                number = dict(zip(distinct, range(len(distinct))))
                places = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
                buckets, owners = _buckets(distinct)
                for row, chosen in enumerate((places, places[good])):
                    times = np.bincount(chosen, minlength=len(distinct))
                    if chosen.size:
                        total[row] += np.bincount(buckets, weights=times[owners], minlength=BUCKETS).astype(np.int64)
        seen = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(total[0][seen]), pa.array(total[1][seen])], names=["bucket", "raw", "target"]
        )

    partial = picked.mapInArrow(run, "bucket int, raw bigint, target bigint")
    return partial.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def ratios(counts: DataFrame) -> np.ndarray:
    """log(trusted / raw) per bucket; at most BUCKETS rows reach the driver."""
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.collect():
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    if not target.sum():
        return np.zeros(BUCKETS, np.float32)
    share = lambda c: (c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS)
    return (np.log(share(target)) - np.log(share(raw))).astype(np.float32)


FIELDS = [
    *[T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("score", T.DoubleType()),
]


def _repeated(numbers: np.ndarray, distinct: int) -> int:
    """Words in three-word windows that occur at least twice."""
    if len(numbers) < 4:
        return 0
    wide = numbers.astype(np.int64)
    if distinct >= MANY:  # pairs are numbered first, at most one number per place
        _, pair = np.unique(wide[:-2] * distinct + wide[1:-1], return_inverse=True)
        windows = pair * distinct + wide[2:]
    else:
        windows = (wide[:-2] << 42) | (wide[1:-1] << 21) | wide[2:]
    order = np.sort(windows)
    twice = order[1:][order[1:] == order[:-1]]
    if not twice.size:
        return 0
    hit = np.isin(windows, twice)
    covered = np.zeros(len(numbers), bool)
    for shift in range(3):
        covered[shift : shift + len(hit)] |= hit
    return int(covered.sum())


def scored(docs: DataFrame, log_ratio: np.ndarray, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` with the base figures, base_failed and score."""
    shared = docs.sparkSession.sparkContext.broadcast(log_ratio)  # BUCKETS numbers

    def make():
        ratio = shared.value

        def values(words: list[bytes]) -> np.ndarray:
            buckets, owners = _buckets(words)
            sums = np.bincount(owners, weights=ratio[buckets], minlength=len(words))
            return np.stack([sums, np.bincount(owners, minlength=len(words))], axis=1)

        table = Table(values, 2)

        def compute(texts: list) -> list[pa.Array]:
            bodies = [t or "" for t in texts]
            rows, places, ends = table.rows([_words(t) for t in bodies])
            sums = per_text(rows[places], ends)
            n_words = np.diff(ends)
            chars = [len(t) - sum(map(t.count, SPACES)) for t in bodies]
            symbols = [sum(map(t.count, SYMBOLS)) for t in bodies]
            dups = []
            for t in bodies:
                lines = [x for x in t.split("\n") if x.strip(SPACES)]
                dups.append(len(lines) - len(set(lines)))
            again = np.array([_repeated(places[a:b], len(rows)) for a, b in zip(ends, ends[1:])], np.int64)
            failed = (n_words < MIN_WORDS) | (100 * again > 50 * n_words)
            score = sums[:, 0] / np.maximum(sums[:, 1], 1)
            return [
                *[pa.array(x, pa.int64()) for x in (n_words, chars, symbols, dups, again)],
                pa.array(failed, pa.bool_()),
                pa.array(score, pa.float64()),
            ]

        return compute

    return over_texts(docs, keep, FIELDS, make, text)


def threshold(judged: DataFrame) -> float:
    """Where the labelled documents (label, score) separate best; minus infinity without both classes."""
    points = stored(judged.groupBy("score").agg(*[F.count_if(F.col("label") == v).alias(n) for n, v in (("good", 1), ("bad", 0))]))
    total = points.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    if not total.good or not total.bad:
        return float("-inf")
    upto = ordered_scan(points, [F.col("score")], {"good_upto": F.col("good"), "bad_upto": F.col("bad")})
    kept = F.lit(1.0) - (F.col("good_upto") - F.col("good")) / F.lit(float(total.good))
    dropped = (F.col("bad_upto") - F.col("bad")) / F.lit(float(total.bad))
    best = upto.where(kept >= KEEP_GOOD).agg(F.max(F.struct((kept + dropped).alias("value"), (-F.col("score")).alias("low"))).alias("best"))
    point = -best.first().best.low
    below = points.where(F.col("score") < F.lit(point)).agg(F.max("score").alias("score")).first().score
    return float(((point - 1.0 if below is None else below) + point) / 2)


def judge(docs: DataFrame, labels: DataFrame, keep: list[str], text: str = "text", key: str = "doc_id") -> DataFrame:
    """Columns ``keep``, the base figures, base_failed, score and kept for every document."""
    sample = stored(labelled_sample(docs, labels, key=key, text=text))  # ids and labels, no texts
    ratio = ratios(counted(docs, sample, key, text))
    own = docs.select(col(key).alias("key"), col(text).alias("text"))
    chosen = own.join(_sent(sample), F.col("key") == F.col("label_id"))
    # one text per id, however often it is repeated
    chosen = chosen.groupBy("label_id").agg(F.max("label").alias("label"), F.max("text").alias("text"))
    limit = threshold(scored(chosen, ratio, ["label"]).where("not base_failed"))
    return scored(docs, ratio, keep, text).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= limit))
