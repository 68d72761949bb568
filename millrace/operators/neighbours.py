"""Exact nearest neighbours as a pruned block join, or as a grid where boxes don't prune.

The corpus is cut into blocks of bounded size along a k-d tree whose split points come from a small
sample (the sample steers only how well blocks separate; the result does not depend on it).  Crowded
leaves, even one holding a third of all rows, are cut further by hash, so a block never grows with
the data.  Each block is summarised by its bounding box.  A query first visits the closest block,
which gives an upper bound for its k-th distance, and then only the blocks whose box can still beat
that bound; each visited block returns at most k rows, and the bests are merged by key.  Query groups
are salted to a bounded size as well.  No pair of rows is ever emitted beyond those k per visit.

At dozens of coordinates hardly any box can be ruled out, and a query sent to every block is all that
moves.  So the share of blocks that a few queries have to visit is measured first.  Where it is large, where
rows would be sent many times over, and on tables of few pairs, queries and corpus are dealt at random to lanes and blocks of at most GRID_ROWS rows
and every lane meets every block once; blocks are read where they were written instead of shuffled to every lane.  All pairs are still compared, as no bound on distances rules one
out, but as matrix products: :func:`closest` estimates distances, and those that the estimate's
error does not rule out are computed in full.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, dtype_of, num
from ..functions.hashing import hash_unit
from ..functions.lineage import materialise

BLOCK_ROWS = 4096
QUERY_ROWS = 2048
MAX_BLOCKS = 32_768
SAMPLE_LIMIT = 200_000
MAX_PATTERNS = 64
BOX_CELLS = 1_000_000
GRID_ROWS = 65_536  # rows of a lane or block of the grid
GRID_CELLS = 8  # cells of the grid a core gets at least, unless their sides fall under BLOCK_ROWS
TRIALS = 200  # queries that tell how well boxes prune
VISIT_ROWS = 1000  # rows that could be compared in a grid while a query is sent to one more block
SENT = 16  # times that visits may send a row on average, unless they spare all but one in
RARE = 64  # of the pairs that a grid compares
ASKED, FIRST, NEXT = 256, 1024, 2048  # queries, first and further corpus rows compared at once
HUGE = 1e15  # beyond this squares leave the range of short floats


@dataclass
class Tree:
    """Split dimension, split value and children of each node; a leaf has dimension -1."""

    dim: np.ndarray
    at: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        while True:
            d = self.dim[node]
            moving = d >= 0
            if not moving.any():
                return node
            rows = np.nonzero(moving)[0]
            v = x[rows, d[rows]]
            go_right = v > self.at[node[rows]]  # a missing value compares false and goes left
            node[rows] = np.where(go_right, self.right[node[rows]], self.left[node[rows]])


def build_tree(sample: np.ndarray, leaves: int) -> Tree:
    dim, at, left, right = [-1], [0.0], [-1], [-1]
    queue = [(0, np.nan_to_num(sample), leaves)]
    while queue:
        node, x, want = queue.pop()
        if want <= 1 or len(x) < 4:
            continue
        d = int(np.argmax(x.max(axis=0) - x.min(axis=0)))
        cut = float(np.median(x[:, d]))
        if cut >= x[:, d].max():
            smaller = x[x[:, d] < cut, d]
            if not len(smaller):
                continue
            cut = float(smaller.max())
        dim[node], at[node] = d, cut
        for side, child in ((x[x[:, d] <= cut], left), (x[x[:, d] > cut], right)):
            child[node] = len(dim)
            dim.append(-1)
            at.append(0.0)
            left.append(-1)
            right.append(-1)
            queue.append((child[node], side, want // 2 if child is right else want - want // 2))
    return Tree(np.array(dim), np.array(at), np.array(left), np.array(right))


def _distances(q: np.ndarray, c: np.ndarray, p: float, partial: bool) -> np.ndarray:
    """|queries| x |corpus| distances; ``partial`` averages over shared coordinates (nan-Euclidean)."""
    total = np.zeros((len(q), len(c)))
    if not partial:
        for j in range(q.shape[1]):
            gap = np.abs(q[:, j, None] - c[None, :, j])
            total += gap * gap if p == 2 else gap if p == 1 else gap**p
        return np.sqrt(total) if p == 2 else total if p == 1 else total ** (1.0 / p)
    shared = np.zeros((len(q), len(c)))
    for j in range(q.shape[1]):
        gap = q[:, j, None] - c[None, :, j]
        ok = ~np.isnan(gap)
        total += np.where(ok, gap * gap, 0.0)
        shared += ok
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(shared > 0, np.sqrt(total * q.shape[1] / shared), np.nan)


def _exact(q: np.ndarray, c: np.ndarray, r: np.ndarray, j: np.ndarray, p: float, partial: bool) -> np.ndarray:
    """Distances of the pairs (r, j) before the root, summed in the order of the coordinates."""
    out = np.empty(len(r))
    step = max(1, BOX_CELLS // q.shape[1])
    for s in range(0, len(r), step):
        gap = np.abs(q[r[s : s + step]] - c[j[s : s + step]])
        power = gap * gap if p == 2 or partial else gap if p == 1 else gap**p
        if partial:
            shared = (~np.isnan(gap)).sum(axis=1)
            total = np.cumsum(np.nan_to_num(power, posinf=np.inf), axis=1)[:, -1]
            with np.errstate(divide="ignore", invalid="ignore"):
                out[s : s + step] = np.where(shared > 0, total * q.shape[1] / shared, np.nan)
        else:
            out[s : s + step] = np.cumsum(power, axis=1)[:, -1]
    return out


def _scores(q: np.ndarray, c: np.ndarray, p: float, partial: bool):
    """A function of slices of q and c giving their scores (larger is closer), and base, factor and room per query:
    a pair of distance x before the root scores at least base - factor * x - room."""
    most = max((float(np.nanmax(np.abs(m), initial=0.0)) for m in (q, c)), default=0.0)
    d = q.shape[1]
    if (p != 2 and not partial) or not most < HUGE:
        # scores are the negative distances themselves

        def direct(a: slice, b: slice) -> np.ndarray:
            x = _distances(q[a], c[b], p, partial)
            with np.errstate(invalid="ignore", over="ignore"):
                x = x * x if p == 2 or partial else x if p == 1 else x**p
            return np.where(np.isnan(x), -np.inf, -x)

        return direct, np.zeros(len(q)), 1.0, lambda a, bound: 1e-9 * np.where(np.isfinite(bound), bound, 0.0)
    has = ~np.isnan(c)
    centre = np.where(has, c, 0.0).sum(axis=0) / np.maximum(has.sum(axis=0), 1)
    q, c = q - centre, c - centre
    q0, c0 = (np.nan_to_num(q), np.nan_to_num(c)) if partial else (q, c)
    q_len, c_len = np.sqrt((q0 * q0).sum(axis=1)), np.sqrt((c0 * c0).sum(axis=1))
    wide = float(c_len.max(initial=0.0))
    width = (d + 8) * (4 if partial else 1)
    # short floats where their error is small beside the distances
    error = width * 2.0**-23 * (float(q_len.max(initial=0.0)) + wide) ** 2
    short = error * (d if partial else 1) <= 1e-2 * float(np.median(c_len)) ** 2
    kind = np.float32 if short else np.float64
    room = width * (2.0**-23 if short else 2.0**-52) * (q_len + wide) ** 2
    if not partial:
        left = np.concatenate([q, np.ones((len(q), 1))], axis=1).astype(kind)
        right = np.concatenate([c, -0.5 * (c_len**2)[:, None]], axis=1).astype(kind)
        return lambda a, b: left[a] @ right[b].T, 0.5 * q_len**2, 0.5, lambda a, bound: room[a]
    q_has, c_has = ~np.isnan(q), has
    left = np.concatenate([q0 * q0, q_has, -2 * q0], axis=1).astype(kind)
    right = np.concatenate([c_has, c0 * c0, c0], axis=1).astype(kind)
    q_has, c_has = q_has.astype(kind), c_has.astype(kind)

    def shared(a: slice, b: slice) -> np.ndarray:
        both = q_has[a] @ c_has[b].T
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(both > 0, left[a] @ right[b].T / both * -d, -np.inf)

    return shared, np.zeros(len(q)), 1.0, lambda a, bound: d * room[a]


def _places(few: np.ndarray) -> np.ndarray:
    """Flat places of the true cells, looked for eight at a time."""
    flat = few.ravel()
    whole = len(flat) // 8 * 8
    eight = np.flatnonzero(flat[:whole].view(np.uint64))
    at, bit = np.nonzero(flat[:whole].reshape(-1, 8)[eight])
    return np.concatenate([8 * eight[at] + bit, whole + np.flatnonzero(flat[whole:])])


def _below(limit: np.ndarray, kind: np.dtype) -> np.ndarray:
    """Limits as a column of that type, never larger."""
    return np.nextafter(limit.astype(kind), kind.type(-np.inf))[:, None]


def _best(r: np.ndarray, j: np.ndarray, far: np.ndarray, p: float, k: int) -> np.ndarray:
    """Places of the k closest of every query r, ties by j; equal roots are equal distances."""
    order = np.lexsort((j, _root(far, p), r))
    r = r[order]
    return order[np.arange(len(r)) - np.searchsorted(r, r) < k]


def _root(far: np.ndarray, p: float) -> np.ndarray:
    return np.sqrt(far) if p == 2 else far if p == 1 else far ** (1.0 / p)


def _repeats(c: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray | None:
    """Rows of c (in key order) but those behind the first k + 1 keys of one vector, which no query can want."""
    same = np.unique(np.ascontiguousarray(c).view(f"V{c.itemsize * c.shape[1]}").ravel(), return_inverse=True)[1].ravel()
    if same.max(initial=-1) + 1 > 0.9 * len(c):
        return None
    order = np.argsort(same, kind="stable")
    group, key = same[order], keys[order]
    fresh = np.ones(len(c), bool)
    fresh[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
    nth = np.cumsum(fresh)
    first = np.maximum.accumulate(np.where(np.r_[True, group[1:] != group[:-1]], nth, 0))
    return np.sort(order[nth - first <= k])


def closest(
    q: np.ndarray, c: np.ndarray, k: int, p: float = 2.0, partial: bool = False, q_keys: np.ndarray | None = None, c_keys: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance) of the k closest rows of c for every row of q, ties by row.

    Pairs of equal ``q_keys`` and ``c_keys`` are left out.  Scores estimate distances by a matrix product; each
    query's k-th exact distance so far tells which scores, less their rounding error, are still worth a full distance.
    """
    p = 2.0 if partial else p
    none = np.zeros(0, np.int64)
    if not len(q) or not len(c):
        return none, none, np.zeros(0)
    kept = _repeats(c, np.arange(len(c)) if c_keys is None else c_keys, k)
    if kept is not None:
        c, c_keys = c[kept], None if c_keys is None else c_keys[kept]
    need = k if c_keys is None else k + int(np.unique(c_keys, return_counts=True)[1].max())
    score, base, factor, room_of = _scores(q, c, p, partial)
    cuts = [0, *range(min(max(FIRST, 2 * need), len(c)), len(c), NEXT), len(c)]
    found = []
    for s in range(0, len(q), ASKED):
        a = slice(s, min(s + ASKED, len(q)))
        n = a.stop - s
        bound = np.full(n, np.inf)
        best = none, none, np.zeros(0)  # query within the slice, row, distance before the root
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            got = score(a, slice(lo, hi))
            room = room_of(a, bound)
            least = base[a] - factor * bound - room
            pairs = got >= _below(least, got.dtype)
            if np.count_nonzero(pairs) > 4 * need * n and hi - lo > need:
                many = np.flatnonzero(np.count_nonzero(pairs, axis=1) > 4 * need)
                kth = np.partition(got[many], hi - lo - need, axis=1)[:, hi - lo - need].astype(float)
                tight = np.maximum(least[many], kth - 2 * room[many])
                pairs[many] = got[many] >= _below(tight, got.dtype)
            r, j = np.divmod(_places(pairs), hi - lo)
            j += lo
            if c_keys is not None:
                other = q_keys[s + r] != c_keys[j]
                r, j = r[other], j[other]
            if not len(r):
                continue
            far = _exact(q[a], c, r, j, p, partial)
            real = ~np.isnan(far)
            best = tuple(np.concatenate([x, y[real]]) for x, y in zip(best, (r, j, far)))
            top = _best(*best, p, k)
            best = tuple(x[top] for x in best)
            full = np.bincount(best[0], minlength=n) == k
            last = np.searchsorted(best[0], np.arange(n), "right") - 1
            bound[full] = best[2][last[full]]
        found.append((best[0] + s, best[1], _root(best[2], p)))
    r, j, far = (np.concatenate(x) for x in zip(*found))
    return r, j if kept is None else kept[j], far


def _codes(a: pa.ChunkedArray, b: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that are equal where keys are; null numbers and times equal nothing."""
    both = pa.chunked_array([*a.chunks, *b.cast(a.type).chunks], a.type).combine_chunks()
    codes = both.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    mine, theirs = codes[: len(a)], codes[len(a) :]
    if pa.types.is_integer(a.type) or pa.types.is_floating(a.type) or pa.types.is_timestamp(a.type):
        theirs = np.where(theirs < 0, -2, theirs)
    return mine, theirs


def meeting(k: int, p: float, partial: bool, exclude_self: bool, extra: Sequence[str], width: int):
    """A function of two Arrow tables, queries and corpus, to the k closest rows per query, with its row."""

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        r, j, far = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if a.num_rows and b.num_rows:
            b = b.take(pc.array_sort_indices(b["key"], null_placement="at_start"))
            codes = _codes(a["key"], b["key"]) if exclude_self else (None, None)
            r, j, far = closest(vectors(a, width), vectors(b, width), k, p, partial, *codes)
        mine, theirs = pa.array(r), pa.array(j)
        columns = [mine, a["key"].take(mine), b["key"].take(theirs), pa.array(far, pa.float64()), *[b[x].take(theirs) for x in extra]]
        return pa.table(columns, names=["row", "query", "neighbour", "distance", *extra])

    return meet


def _narrow(rows: pa.Table) -> pa.Table:
    """Vectors as short floats where that loses nothing: half of what travels."""
    flat = pa.chunked_array([c.flatten() for c in rows["v"].chunks], pa.float64()).to_numpy()
    with np.errstate(over="ignore"):
        if not np.array_equal(flat.astype(np.float32), flat, equal_nan=True):
            return rows
    return rows.set_column(rows.schema.get_field_index("v"), "v", rows["v"].cast(pa.list_(pa.float32()), safe=False))


def _bundles(df: DataFrame, parts: int, most: int, name: str) -> DataFrame:
    """The rows dealt at random to so many tasks, as Arrow bytes of about ``most`` rows each.

    Neither copies of a row nor of a key crowd a task.
    """
    schema = df.schema
    number = F.lit(0) if parts == 1 else F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int")
    own = df.withColumn("part", number)
    # written first, so that a task run again deals its rows as before
    own = own if parts == 1 else materialise(own)
    own = own.repartitionById(parts, "part").select(*schema.names)

    def bundled(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = _narrow(pa.Table.from_batches(held))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as out:
            out.write_table(rows)
        return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=[name])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, most - n)
                held, n, batch = [*held, part], n + part.num_rows, batch.slice(part.num_rows)
                if n == most:
                    yield bundled(held)
                    held, n = [], 0
        if held:
            yield bundled(held)

    return own.mapInArrow(run, f"{name} binary")


def grid(ask: DataFrame, base: DataFrame, n_ask: int, n: int, meet, k: int, extra: Sequence[str], out_ddl: str) -> DataFrame:
    """Every row of ``ask`` (key, v) meets every row of ``base`` (key, v, extra): the k closest of each.

    Queries are dealt to lanes and the corpus to pieces.  A task reads its lane and, block after block, its
    piece from where they were written, and keeps k rows per query, so no row is shuffled once per lane
    or block.  The larger the tables, the fewer pieces: with lanes enough for all cores there is one.
    """
    cells = GRID_CELLS * ask.sparkSession.sparkContext.defaultParallelism
    side = min(GRID_ROWS, max(BLOCK_ROWS, math.ceil(math.sqrt(max(1, n_ask) * n / cells))))
    lanes = max(1, math.ceil(n_ask / side))
    pieces = max(1, min(math.ceil(n / side), math.ceil(cells / lanes)))
    asked = _bundles(ask.select("key", "v"), lanes, 2 * side, "asked")
    asked = materialise(asked.withColumn("lane", F.monotonically_increasing_id()))
    found = materialise(_bundles(base.select("key", "v", *extra), pieces, side, "found"))
    order = [(x, "ascending") for x in ("row", "distance", "neighbour")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, pa.Table] = {}  # of the one lane of this task
        for batch in batches:
            for lane, a, b in zip(batch.column("lane").to_pylist(), batch.column("asked"), batch.column("found")):
                a, b = (pa.ipc.open_stream(x.as_buffer()).read_all() for x in (a, b))
                new = meet(a, b)
                if lane in best:
                    both = pa.concat_tables([best[lane], new])
                    both = both.take(pc.sort_indices(both, sort_keys=order, null_placement="at_start"))
                    row = both["row"].to_numpy()
                    new = both.filter(pa.array(np.arange(len(row)) - np.searchsorted(row, row) < k))
                best[lane] = new
        for rows in best.values():
            yield from rows.drop_columns(["row"]).combine_chunks().to_batches()

    # the right side is read again for every block of the left, one bundle at a time
    return found.crossJoin(asked.hint("shuffle_replicate_nl")).mapInArrow(run, out_ddl)


def _box_gaps(q: np.ndarray, lo: np.ndarray, hi: np.ndarray, p: float, partial: bool) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest possible distance of each query to any row of each block."""
    near = np.zeros((len(q), len(lo)))
    far = np.zeros((len(q), len(lo)))
    shared = np.zeros((len(q), len(lo)))
    for j in range(q.shape[1]):
        below, above = lo[None, :, j] - q[:, j, None], q[:, j, None] - hi[None, :, j]
        inner = np.maximum(np.maximum(below, above), 0.0)
        outer = np.maximum(np.abs(below), np.abs(above))
        ok = ~np.isnan(inner)
        near += np.where(ok, inner**p, 0.0)
        far += np.where(ok, outer**p, 0.0)
        shared += ok
    if partial:
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(shared > 0, q.shape[1] / shared, np.inf)
            near, far = near * scale, far * scale
        near, far = np.where(shared > 0, near, np.inf), np.where(shared > 0, far, np.inf)
    # leave room for rounding so that no block is skipped by a last-bit difference
    return near ** (1.0 / p) * (1.0 - 1e-9), far ** (1.0 / p) * (1.0 + 1e-9)


def vectors(batch: pa.RecordBatch | pa.Table, width: int) -> np.ndarray:
    """Column ``v`` as a matrix; missing entries are NaN."""
    column = batch.column("v")
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def complete(df: DataFrame, width: int) -> DataFrame:
    """Rows without missing entries.

    A filter over many columns would do, but the optimiser restates it for every subset of their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~np.isnan(vectors(batch, width)).any(axis=1)))

    return df.mapInArrow(run, df.schema)


def _with(batch: pa.RecordBatch, **more) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, more.values())], names=[*batch.schema.names, *more])


def _boxes(blocked: DataFrame, width: int) -> pd.DataFrame:
    """block, n, lo, hi of every block: one partial row per task and block, merged per block."""
    ddl = "block bigint, n bigint, lo array<double>, hi array<double>"

    def rows(found: dict[int, tuple]) -> pd.DataFrame:
        return pd.DataFrame([(b, n, lo, hi) for b, (n, lo, hi) in found.items()], columns=["block", "n", "lo", "hi"])

    def joined(a: tuple | None, n: int, lo: np.ndarray, hi: np.ndarray) -> tuple:
        return (n, lo, hi) if a is None else (a[0] + n, np.fmin(a[1], lo), np.fmax(a[2], hi))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, block = vectors(batch, width), batch.column("block").to_numpy()
            order = np.argsort(block, kind="stable")
            names, first, n = np.unique(block[order], return_index=True, return_counts=True)
            lo, hi = np.fmin.reduceat(x[order], first, axis=0), np.fmax.reduceat(x[order], first, axis=0)
            for i, b in enumerate(names.tolist()):
                found[b] = joined(found.get(b), int(n[i]), lo[i], hi[i])
        if found:
            yield pa.RecordBatch.from_pandas(rows(found), preserve_index=False)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        total = None
        for r in pdf.itertuples():
            total = joined(total, r.n, np.asarray(r.lo, float), np.asarray(r.hi, float))
        return rows({int(pdf["block"].iloc[0]): total})

    merged = blocked.select("block", "v").mapInArrow(partial, ddl).groupBy("block").applyInPandas(merge, ddl)
    return merged.toPandas().sort_values("block")


def knn_join(
    queries: DataFrame,
    corpus: DataFrame,
    query_key: str,
    corpus_key: str,
    columns: Sequence[str],
    k: int,
    p: float = 2.0,
    exclude_self: bool = False,
    carry: Sequence[str] = (),
    allow_missing: bool = False,
    block_rows: int | None = None,
    query_rows: int | None = None,
    mode: str = "exact",
    recall: float = 0.95,
) -> DataFrame:
    """(query_key, neighbour, distance, rank, carried columns) for the k nearest corpus rows.

    Ties are broken by corpus key.  ``allow_missing`` switches to nan-Euclidean distance; otherwise
    rows with a missing coordinate are left out.  Mode ``approx`` finds about ``recall`` of them by
    random-projection buckets; it is meant for wide vectors, where boxes no longer prune.
    """
    if mode == "approx":
        if allow_missing:
            raise ValueError("mode approx needs complete rows")
        from .approximate import knn_approx

        return knn_approx(queries, corpus, query_key, corpus_key, columns, k, p, exclude_self, carry, recall)
    if mode != "exact":
        raise ValueError("mode must be exact or approx")
    spark = corpus.sparkSession
    d = len(columns)
    extra = [f"c{i}" for i in range(len(carry))]

    def slim(df: DataFrame, key: str, more: Sequence[str]) -> DataFrame:
        # one array, since hundreds of columns make the optimiser slow
        v = F.array(*[num(df, c).cast("double") for c in columns]).alias("v")
        out = df.select(col(key).alias("key"), v, *[col(c).alias(x) for c, x in zip(more, extra)])
        return out if allow_missing else complete(out, d)

    wanted = block_rows is not None
    block_rows, query_rows = block_rows or BLOCK_ROWS, query_rows or QUERY_ROWS
    base, ask = slim(corpus, corpus_key, carry), slim(queries, query_key, ())
    q_type, c_type = dtype_of(ask, "key").simpleString(), dtype_of(base, "key").simpleString()
    n = base.count()
    carry_ddl = "".join(f", {x} {dtype_of(base, x).simpleString()}" for x in extra)
    out_ddl = f"query {q_type}, neighbour {c_type}, distance double{carry_ddl}"
    if n == 0:
        return _named(spark.createDataFrame([], out_ddl).withColumn("rank", F.lit(1)), query_key, carry)
    n_ask = ask.count()
    meet = meeting(k, p, allow_missing, exclude_self, extra, d)

    def on_grid() -> DataFrame:
        return _named(ranked(grid(ask, base, n_ask, n, meet, k, extra, out_ddl), k), query_key, carry)

    if n <= block_rows or (not wanted and n * n_ask <= GRID_ROWS * GRID_ROWS):
        return on_grid()
    block_rows = max(block_rows, math.ceil(2 * n / MAX_BLOCKS))

    # --- blocks
    mark = F.transform("v", lambda x: F.when(x.isNull(), "0").otherwise("1"))
    base = base.withColumn("pattern", F.array_join(mark, "") if allow_missing else F.lit(""))
    pure, leaves = True, math.ceil(n / block_rows)
    if allow_missing:
        # blocks hold one pattern of missing coordinates each, unless there are too many patterns
        patterns = base.select("pattern").distinct().limit(MAX_PATTERNS + 1).count()
        pure = patterns <= MAX_PATTERNS
        if not pure:
            return on_grid()
        leaves = max(1, min(leaves, MAX_BLOCKS // (2 * patterns)))
    if leaves > 1:
        share = min(1.0, min(SAMPLE_LIMIT, 32 * leaves) / n)
        sample = base.where(hash_unit("key", "tree") < F.lit(share)).select("v").limit(2 * SAMPLE_LIMIT).toArrow()
        tree = build_tree(vectors(sample, d), leaves) if sample.num_rows else None
    else:
        tree = None
    if tree is None:
        placed = base.withColumn("leaf", F.lit(0).cast("bigint"))
    else:

        def place(batches):
            for batch in batches:
                yield _with(batch, leaf=tree.leaves(vectors(batch, d)))

        placed = base.mapInArrow(place, T.StructType(base.schema.fields + [T.StructField("leaf", T.LongType())]))
    placed = materialise(placed)
    group = ["leaf", "pattern"] if pure else ["leaf"]
    sizes = sorted(
        tuple(r) for r in placed.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).collect()
    )
    first, rows = 0, []
    for *names, size in sizes:
        pieces = math.ceil(size / block_rows)
        rows.append((*names, first, pieces))
        first += pieces
    n_blocks = first
    names_ddl = "leaf bigint, pattern string" if pure else "leaf bigint"
    plan = spark.createDataFrame(rows, f"{names_ddl}, first bigint, pieces bigint")
    # the plan has one row per leaf, bounded by MAX_BLOCKS
    blocked = placed.join(F.broadcast(plan), group).select(
        (F.col("first") + F.pmod(F.xxhash64("key"), F.col("pieces"))).alias("block"), "key", "v", *extra
    )

    # --- bounding boxes
    if n_blocks == 1:
        return on_grid()
    boxes = _boxes(blocked, d)
    ids, counts = boxes["block"].to_numpy(dtype=np.int64), boxes["n"].to_numpy(dtype=float)
    lo, hi = (np.stack([np.asarray(v, float) for v in boxes[c]]) for c in ("lo", "hi"))
    visits = len(ids) * _share_visited(ask, base, n_ask, k, p, allow_missing, exclude_self, lo, hi)
    if visits * (block_rows + VISIT_ROWS) > n or _sends_much(visits, len(ids), n_ask, n, query_rows):
        return on_grid()
    shared = spark.sparkContext.broadcast((ids, counts, lo, hi))
    need = k + (1 if exclude_self else 0)

    def first_block(batches):
        ids, counts, lo, hi = shared.value
        for batch in batches:
            q = vectors(batch, d)
            best = np.empty(len(q), dtype=np.int64)
            bound = np.full(len(q), np.inf)
            step = max(8, BOX_CELLS // len(ids))
            for s in range(0, len(q), step):
                near, far = _box_gaps(q[s : s + step], lo, hi, p, allow_missing)
                # among boxes that contain the query the tightest one is visited first
                pull = near + 1e-12 * np.nan_to_num(far, posinf=0.0)
                best[s : s + step] = ids[np.argmin(pull, axis=1)]
                order = np.argsort(far, axis=1)
                reach = np.cumsum(counts[order], axis=1) >= need
                enough = reach.any(axis=1)
                at = np.argmax(reach, axis=1)
                limit = np.take_along_axis(far, np.take_along_axis(order, at[:, None], 1), 1)[:, 0]
                bound[s : s + step] = np.where(enough, limit, np.inf)
            yield _with(batch, block=best, bound=bound)

    def other_blocks(batches):
        ids, counts, lo, hi = shared.value
        for batch in batches:
            q, own = vectors(batch, d), batch.column("block").to_numpy()
            bound = batch.column("bound").to_numpy(zero_copy_only=False).astype(float)
            slim = batch.select(["key", "v"])
            step = max(8, BOX_CELLS // len(ids))
            for s in range(0, len(q), step):
                part = slice(s, s + step)
                keep = _box_gaps(q[part], lo, hi, p, allow_missing)[0] <= bound[part, None]
                keep &= ids[None, :] != own[part, None]
                r, b = np.nonzero(keep)
                if len(r):
                    yield _with(slim.take(pa.array(r + s)), block=ids[b])

    def visit(asked: DataFrame) -> DataFrame:
        """Meet every query with the block it names, in groups of bounded size on both sides."""
        loads = {r["block"]: r["n"] for r in asked.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()}
        lanes = spark.createDataFrame(
            [(b, max(1, math.ceil(m / query_rows))) for b, m in loads.items()], "block bigint, lanes bigint"
        )
        # one row per block, bounded by MAX_BLOCKS
        left = asked.join(F.broadcast(lanes), "block").withColumn("lane", F.pmod(F.xxhash64("key", F.lit(7)), F.col("lanes")))
        right = blocked.join(F.broadcast(lanes), "block").withColumn(
            "lane", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("lanes") - 1))
        )
        pairs = left.select("block", "lane", "key", "v").groupBy("block", "lane").cogroup(
            right.select("block", "lane", "key", "v", *extra).groupBy("block", "lane")
        )
        return pairs.applyInArrow(lambda a, b: meet(a, b).drop_columns(["row"]), out_ddl)

    fields = ask.schema.fields + [T.StructField("block", T.LongType()), T.StructField("bound", T.DoubleType())]
    start = materialise(ask.mapInArrow(first_block, T.StructType(fields)))
    opening = materialise(visit(start))
    kth = opening.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far"))
    kth = kth.select(F.col("query").alias("key"), F.when(F.col("n") >= k, F.col("far")).alias("far"))
    tightened = start.join(kth, "key", "left").select(
        "key", "v", "block", F.least(F.col("bound"), F.coalesce("far", F.lit(float("inf")))).alias("bound")
    )
    fields = ask.schema.fields + [T.StructField("block", T.LongType())]
    rest = materialise(tightened.mapInArrow(other_blocks, T.StructType(fields)))
    return _named(ranked(opening.unionByName(visit(rest)), k), query_key, carry)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k closest of every query."""
    w = Window.partitionBy("query").orderBy("distance", "neighbour")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _sends_much(visits: float, n_blocks: int, n_ask: int, n: int, query_rows: int) -> bool:
    """Whether rows sent by visits, every query to each of its blocks and a block to each group of its queries, are
    many times the tables.  Visits grow with the number of blocks, so what is shuffled and written would grow with
    the square of the table; a grid deals every row a fixed number of times, but compares all pairs."""
    sent = n_ask * visits * (1 + n / n_blocks / query_rows)
    return sent > SENT * (n_ask + n) and visits * RARE > n_blocks


def _share_visited(
    ask: DataFrame, base: DataFrame, n_ask: int, k: int, p: float, partial: bool, exclude_self: bool, lo: np.ndarray, hi: np.ndarray
) -> float:
    """Share of the boxes that can hold neighbours of a query, on average over about TRIALS of them.

    One pass over the corpus gives their exact k-th distances: it decides how the join is done, never what it finds.
    """
    width = lo.shape[1]
    draw = hash_unit("key", "trial") < F.lit(min(1.0, TRIALS / max(1, n_ask)))
    trial = ask.where(draw).select("v").limit(TRIALS).toArrow()
    if not trial.num_rows:
        return 1.0
    asked, wanted = vectors(trial, width), k + (1 if exclude_self else 0)

    def nearby(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = np.full((len(asked), wanted), np.inf)
        for batch in batches:
            r, _, far = closest(asked, vectors(batch, width), wanted, p, partial)
            new = np.full((len(asked), wanted), np.inf)
            new[r, np.arange(len(r)) - np.searchsorted(r, r)] = far
            near = np.sort(np.concatenate([near, new], axis=1), axis=1)[:, :wanted]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(near)), pa.int64()), pa.array(near.tolist(), pa.list_(pa.float64()))], names=["q", "far"])

    tasks = base.select("v").mapInArrow(nearby, "q bigint, far array<double>")
    last = tasks.groupBy("q").agg(F.sort_array(F.flatten(F.collect_list("far")))[wanted - 1].alias("far")).toPandas()  # TRIALS rows
    bound = last.sort_values("q")["far"].to_numpy(dtype=float)
    near, _ = _box_gaps(asked, lo, hi, p, partial)
    return float((near <= bound[:, None]).mean())


def _named(found: DataFrame, query_key: str, carry: Sequence[str]) -> DataFrame:
    return found.select(
        F.col("query").alias(query_key),
        "neighbour",
        "distance",
        "rank",
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)],
    )


def knn_predict(
    train: DataFrame,
    test: DataFrame,
    train_key: str,
    test_key: str,
    features: Sequence[str],
    target: str,
    k: int = 5,
    weights: str = "uniform",
    p: float = 2.0,
    output: str = "prediction",
    mode: str = "exact",
) -> DataFrame:
    """Mean target of the k nearest training rows, optionally weighted by inverse distance."""
    near = knn_join(test, train, test_key, train_key, features, k, p, carry=[target], mode=mode)
    y = F.col(target).cast("double")
    if weights == "uniform":
        value = F.avg(y)
    elif weights == "distance":
        # a training row at distance zero decides alone
        exact = F.avg(F.when(F.col("distance") == 0, y))
        w = F.try_divide(F.lit(1.0), F.col("distance"))
        value = F.coalesce(exact, F.sum(w * y) / F.sum(w))
    else:
        raise ValueError("weights must be uniform or distance")
    return near.groupBy(col(test_key)).agg(value.alias(output))


def knn_impute(df: DataFrame, key: str, columns: Sequence[str], k: int = 5, donors_from: DataFrame | None = None) -> DataFrame:
    """Fill each missing cell with the mean of the column over the k nearest rows that have it.

    The rows are those of ``donors_from`` (a training table with the same columns), else of ``df``.

    Distance is nan-Euclidean over all ``columns``; a cell without any comparable row gets the
    column mean.
    """
    from ..functions.moments import moments

    source = df if donors_from is None else donors_from
    means = moments(source, columns, ["mean"])
    gaps = moments(df, columns, ["n", "n_rows"])
    slim = df.select(col(key), *[num(df, c).alias(c) for c in columns])
    giving = source.select(col(key), *[num(source, c).alias(c) for c in columns])
    out = df
    for c in columns:
        if gaps[c]["n"] == gaps[c]["n_rows"]:
            continue
        ask = slim.where(col(c).isNull())
        donors = giving.where(col(c).isNotNull()).withColumn("__donor", col(c))
        near = knn_join(ask, donors, key, key, columns, k, carry=["__donor"], allow_missing=True)
        fills = near.groupBy(col(key).alias("__key")).agg(F.avg("__donor").alias("__fill"))
        joined = out.join(fills, col(key) == F.col("__key"), "left")
        value = F.coalesce(num(df, c), F.col("__fill"), F.lit(means[c]["mean"]))
        out = joined.select(*[value.alias(n) if n == c else col(n) for n in df.columns])
    return out


@dataclass
class NeighbourFill:
    """:func:`knn_impute` as a fitted step: the donors are the training rows."""

    key: str
    columns: list[str]
    donors: DataFrame
    k: int = 5

    def transform(self, df: DataFrame) -> DataFrame:
        return knn_impute(df, self.key, self.columns, self.k, self.donors)
