"""Approximate nearest neighbours of wide vectors: random-projection buckets with probes fitted to a recall.

Boxes stop pruning when vectors have dozens of coordinates.  Here every tree draws one random direction per
level and halves its buckets at their medians, taken from a bounded sample; a row lands in one bucket per
tree.  A query visits, in every tree, the buckets whose half-spaces are closest to it.  How many is measured:
the exact neighbours of a few queries are found in one pass over the corpus, and probes are doubled until
the wanted share of them lies in visited buckets.  On vectors without any structure that may mean most
buckets: where that costs more than comparing everything, every row meets every other in a grid of large cells,
and the result is exact.

A bucket is cut by hash into pieces of bounded size, all of which are visited, so one vector repeated in a
third of all rows fills no task; queries per piece are dealt to lanes.  Each visit returns at most k rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, dtype_of, num
from ..functions.hashing import hash_unit
from ..functions.lineage import materialise
from .neighbours import GRID_ROWS, complete, grid, meeting, ranked, vectors

TREES = 4
LEAF_ROWS = 1024
QUERY_ROWS = 2048
MOST_LEVELS = 17  # 131,072 buckets per tree; larger tables have more pieces per bucket
SAMPLE_ROWS = 100_000
NODE_SAMPLE = 16  # sampled rows a median needs
TRIALS = 200  # queries whose exact neighbours fit the probes
VISIT_ROWS = 4096  # rows that could be compared in a grid while a query is sent to one more bucket
MARGIN = 0.02  # of recall, above what was asked, since it is measured on few queries


@dataclass
class Buckets:
    """Per tree: directions (coordinate x level) and, per level, the cut of every bucket."""

    directions: list[np.ndarray]
    cuts: list[list[np.ndarray]]
    levels: int

    def of(self, x: np.ndarray, tree: int) -> np.ndarray:
        """Bucket of every row."""
        along, at = x @ self.directions[tree], np.zeros(len(x), np.int64)
        for level in range(self.levels):
            at = 2 * at + (along[:, level] > self.cuts[tree][level][at])
        return at

    def nearest(self, x: np.ndarray, tree: int, probes: int) -> np.ndarray:
        """The ``probes`` closest buckets of every row, the own one first: a beam through the levels."""
        along, width = x @ self.directions[tree], max(64, 4 * probes)
        at, cost = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
        for level in range(self.levels):
            gap = along[:, level, None] - self.cuts[tree][level][at]
            cost = np.concatenate([cost + np.maximum(gap, 0) ** 2, cost + np.maximum(-gap, 0) ** 2], axis=1)
            # a row on the cut belongs to the left, so the right side costs more than nothing there
            cost[:, len(at[0]) :][gap == 0] += 1e-300
            at = np.concatenate([2 * at, 2 * at + 1], axis=1)
            if at.shape[1] > width:
                best = np.argpartition(cost, width - 1, axis=1)[:, :width]
                at, cost = np.take_along_axis(at, best, 1), np.take_along_axis(cost, best, 1)
        order = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        return np.take_along_axis(at, order, 1)


def build(sample: np.ndarray, levels: int, trees: int, seed: int) -> Buckets:
    draw = np.random.default_rng(seed)
    directions, cuts = [], []
    for _ in range(trees):
        normal = draw.normal(size=(sample.shape[1], max(1, levels)))
        normal = np.linalg.qr(normal)[0] if levels and levels <= sample.shape[1] else normal / np.linalg.norm(normal, axis=0)
        along, at = sample @ normal, np.zeros(len(sample), np.int64)
        own: list[np.ndarray] = []
        for level in range(levels):
            cut = _medians(along[:, level], at, level)
            at = 2 * at + (along[:, level] > cut[at])
            own.append(cut)
        directions.append(normal)
        cuts.append(own)
    return Buckets(directions, cuts, levels)


def _medians(values: np.ndarray, at: np.ndarray, level: int) -> np.ndarray:
    """Median per bucket; buckets with few sampled rows take that of the bucket they came from."""
    out = np.zeros(1)
    for above in range(level + 1):
        group = at >> (level - above)
        order = np.lexsort((values, group))
        n = np.bincount(group, minlength=1 << above)
        first = np.cumsum(n) - n
        out = np.repeat(out, 2) if above else out
        enough = n >= (NODE_SAMPLE if above else 1)
        out[enough] = values[order][(first + (n - 1) // 2)[enough]]
    return out


def _closest(q: np.ndarray, c: np.ndarray, k: int, p: float, banned: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance) of the k closest rows; rows come in key order, which breaks ties."""
    if p == 2:
        rough = np.maximum((q * q).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * q @ c.T, 0)
        room = 1e-9 * (1 + (q * q).sum(1))
    else:
        rough, room = sum(np.abs(q[:, j, None] - c[None, :, j]) ** p for j in range(q.shape[1])), np.zeros(len(q))
    if banned is not None:
        rough[banned] = np.inf
    take = min(k, len(c))
    limit = np.partition(rough, take - 1, axis=1)[:, take - 1]
    r, j = np.nonzero((rough <= (limit + room)[:, None]) & np.isfinite(rough))
    exact = (np.abs(q[r] - c[j]) ** p).sum(axis=1) ** (1 / p)
    order = np.lexsort((j, exact, r))
    r, j, exact = r[order], j[order], exact[order]
    kept = np.arange(len(r)) - np.searchsorted(r, r) < take
    return r[kept], j[kept], exact[kept]


def _fitted_probes(base: DataFrame, trial: pa.Table, buckets: Buckets, k: int, p: float, recall: float, exclude_self: bool) -> int:
    """The least power of two whose buckets hold the wanted share of the trial queries' exact neighbours."""
    width = buckets.directions[0].shape[0]
    asked, keys = vectors(trial, width), np.array(trial["key"].to_pylist(), object)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = None  # (query, distance, vector) of the best so far
        for batch in batches:
            for start in range(0, batch.num_rows, LEAF_ROWS):
                part = batch.slice(start, LEAF_ROWS)
                c = vectors(part, width)
                banned = keys[:, None] == np.array(part.column("key").to_pylist(), object)[None, :] if exclude_self else None
                r, j, far = _closest(asked, c, k, p, banned)
                new = r, far, c[j]
                rows = new if rows is None else tuple(np.concatenate(x) for x in zip(rows, new))
                order = np.lexsort((rows[1], rows[0]))
                rows = tuple(x[order] for x in rows)
                kept = np.arange(len(order)) - np.searchsorted(rows[0], rows[0]) < k
                rows = tuple(x[kept] for x in rows)
        if rows is not None and len(rows[0]):
            ends = pa.array(np.arange(len(rows[0]) + 1) * width, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0].astype(np.int64)), pa.array(rows[1]), pa.ListArray.from_arrays(ends, pa.array(rows[2].ravel()))],
                names=["q", "far", "v"],
            )

    near = base.select("key", "v").mapInArrow(best, "q bigint, far double, v array<double>")
    rank = F.row_number().over(Window.partitionBy("q").orderBy("far"))
    found = near.withColumn("r", rank).where(F.col("r") <= k).select("q", "v").toArrow()  # at most TRIALS x k rows
    if not found.num_rows:
        return 1
    q, c = found["q"].to_numpy(), vectors(found, width)
    homes = [buckets.of(c, t) for t in range(len(buckets.cuts))]
    probes, most = 1, 1 << buckets.levels
    while probes < most:
        hit = np.zeros(len(q), bool)
        for t, home in enumerate(homes):
            hit |= (buckets.nearest(asked, t, probes)[q] == home[:, None]).any(axis=1)
        if hit.mean() >= min(1.0, recall + MARGIN):
            break
        probes *= 2
    return probes


def knn_approx(
    queries: DataFrame,
    corpus: DataFrame,
    query_key: str,
    corpus_key: str,
    columns: Sequence[str],
    k: int,
    p: float = 2.0,
    exclude_self: bool = False,
    carry: Sequence[str] = (),
    recall: float = 0.95,
    trees: int = TREES,
    leaf_rows: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """(query_key, neighbour, distance, rank, carried columns): at least about ``recall`` of what the exact
    join returns, with exact distances.

    Ties are broken by corpus key; rows with a missing coordinate are left out.  A query gets fewer than k
    rows only if the visited buckets, or the corpus, have no more.
    """
    spark, leaf_rows = corpus.sparkSession, leaf_rows or LEAF_ROWS
    extra = [f"c{i}" for i in range(len(carry))]

    def slim(df: DataFrame, key: str, more: Sequence[str]) -> DataFrame:
        v = F.array(*[num(df, c).cast("double") for c in columns]).alias("v")
        out = df.select(col(key).alias("key"), v, *[col(c).alias(x) for c, x in zip(more, extra)])
        return complete(out, len(columns))

    base, ask = slim(corpus, corpus_key, carry), slim(queries, query_key, ())
    q_type, c_type = dtype_of(ask, "key").simpleString(), dtype_of(base, "key").simpleString()
    more = "".join(f", {x} {dtype_of(base, x).simpleString()}" for x in extra)
    out_ddl = f"query {q_type}, neighbour {c_type}, distance double{more}"
    n, width = base.count(), len(columns)
    levels = max(0, min(MOST_LEVELS, math.ceil(math.log2(n / leaf_rows)))) if n > leaf_rows else 0
    share = min(1.0, min(SAMPLE_ROWS, 2 * NODE_SAMPLE << levels) / max(1, n))
    # keys drawn by hash; a repeated key may bring more rows, so the size is held as well
    sample = base.where(hash_unit("key", "buckets") < share).select("v").limit(2 * SAMPLE_ROWS).toArrow()
    if not sample.num_rows:
        sample = base.select("v").limit(SAMPLE_ROWS).toArrow()
    buckets = build(vectors(sample, width), levels if sample.num_rows else 0, trees if levels else 1, seed)
    probes, total = 1, ask.count()
    if buckets.levels:
        trial = ask.where(hash_unit("key", "trial") < min(1.0, 2 * TRIALS / max(1, total))).limit(TRIALS).toArrow()
        probes = _fitted_probes(base, trial, buckets, k, p, recall, exclude_self) if trial.num_rows else 1
    visits = len(buckets.cuts) * probes
    if visits >= 1 << buckets.levels or (n > GRID_ROWS and visits * VISIT_ROWS >= n):
        found = grid(ask, base, total, n, meeting(k, p, False, exclude_self, extra, width), k, extra, out_ddl)
        return _renamed(ranked(found, k), query_key, extra, carry)
    shared = spark.sparkContext.broadcast(buckets)  # at most trees x (2^17 cuts + directions)

    def placed(each):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            made = shared.value
            for batch in batches:
                for start in range(0, batch.num_rows, LEAF_ROWS):
                    part = batch.slice(start, LEAF_ROWS)
                    x = vectors(part, width)
                    for t in range(len(made.cuts)):
                        at = each(made, x, t)
                        rows = pa.array(np.repeat(np.arange(len(x)), at.shape[1]))
                        block = pa.array((at + (t << made.levels)).ravel())
                        yield pa.RecordBatch.from_arrays([*[c.take(rows) for c in part.columns], block], names=[*part.schema.names, "bucket"])

        return run

    def with_bucket(df: DataFrame, each) -> DataFrame:
        return df.mapInArrow(placed(each), T.StructType([*df.schema.fields, T.StructField("bucket", T.LongType())]))

    homes = materialise(with_bucket(base, lambda b, x, t: b.of(x, t)[:, None]))
    pieces = homes.groupBy("bucket").agg(F.ceil(F.count("*") / F.lit(2.0 * leaf_rows)).alias("pieces"))
    # one row per bucket: at most trees x 2^MOST_LEVELS
    pieces = F.broadcast(materialise(pieces))
    cut = homes.join(pieces, "bucket").withColumn("piece", F.pmod(F.xxhash64("key", F.monotonically_increasing_id()), F.col("pieces")))
    asked = with_bucket(ask, lambda b, x, t: b.nearest(x, t, probes)).join(pieces, "bucket")
    asked = asked.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1))).drop("pieces")
    asked = materialise(asked)
    lanes = asked.groupBy("bucket", "piece").agg(F.ceil(F.count("*") / F.lit(float(QUERY_ROWS))).alias("lanes"))
    lanes = materialise(lanes)  # as many rows as pieces of the corpus
    left = asked.join(lanes, ["bucket", "piece"]).withColumn("lane", F.pmod(F.xxhash64("key", F.lit(7)), F.col("lanes")))
    right = cut.drop("pieces").join(lanes, ["bucket", "piece"])
    right = right.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("lanes") - 1)))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        out = {x: [] for x in ("r", "j", "far")}
        if a.num_rows and b.num_rows:
            b = b.sort_by("key")
            c, theirs = vectors(b, width), np.array(b["key"].to_pylist(), object)
            for start in range(0, a.num_rows, 256):
                part = a.slice(start, 256)
                banned = np.array(part["key"].to_pylist(), object)[:, None] == theirs[None, :] if exclude_self else None
                r, j, far = _closest(vectors(part, width), c, k, p, banned)
                for x, y in zip(out, (r + start, j, far)):
                    out[x].append(y)
        r, j, far = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out.values())
        columns = [a["key"].take(pa.array(r)), b["key"].take(pa.array(j)), pa.array(far.astype(float)), *[b[x].take(pa.array(j)) for x in extra]]
        return pa.table(columns, names=["query", "neighbour", "distance", *extra])

    group = ["bucket", "piece", "lane"]
    pairs = left.select(*group, "key", "v").groupBy(*group).cogroup(right.select(*group, "key", "v", *extra).groupBy(*group))
    found = pairs.applyInArrow(meet, out_ddl)
    if len(buckets.cuts) > 1:  # the same row met in several trees
        best = F.row_number().over(Window.partitionBy("query", "neighbour").orderBy("distance"))
        found = found.withColumn("rank", best).where("rank = 1").drop("rank")
    return _renamed(ranked(found, k), query_key, extra, carry)


def _renamed(found: DataFrame, query_key: str, extra: Sequence[str], carry: Sequence[str]) -> DataFrame:
    return found.select(
        F.col("query").alias(query_key), "neighbour", "distance", "rank", *[F.col(x).alias(c) for x, c in zip(extra, carry)]
    )
