"""Rank correlation of many columns in a fixed number of shuffles.

All columns are ranked side by side: their cells are stacked, counted by (column, value) and scanned once
in that order.  A pair of columns is ranked on the rows where both are present, so a column needs one rank
per pattern of missing rows among the others, not one per partner; columns missing in the same rows share
theirs.  The scan carries one running count per pattern.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import local_rows, num
from ..functions.lineage import materialise, spread_out
from ..functions.treesum import rows_of, tree_sum
from .lookup import lookup_join
from .ordered import SMALL_VALUES, ordered_scan

CELLS = 1 << 21  # numbers of one working array


def _patterns(slim: DataFrame, p: int) -> tuple[list[int], list[int]]:
    """Pattern number of every column, and a column for every pattern.

    Columns are missing in the same rows if as many rows are missing and two sums of 64-bit row hashes
    over them agree; hashes are only read for columns that share their number of missing rows.
    """
    gap = [F.col(f"v{i}").isNull() for i in range(p)]
    missing = list(slim.agg(*[F.count_if(g).alias(f"n{i}") for i, g in enumerate(gap)]).collect()[0])
    alike = [i for i, m in enumerate(missing) if m and missing.count(m) > 1]
    sums = {}
    if alike:
        marks = [F.xxhash64(F.lit(salt), *[F.col(f"v{i}") for i in range(p)]).cast("decimal(20,0)") for salt in (1, 2)]
        marked = slim.select("*", *[m.alias(f"h{k}") for k, m in enumerate(marks)])
        sums = marked.agg(
            *[F.sum(F.when(gap[i], F.col(f"h{k}"))).alias(f"s{k}_{i}") for i in alike for k in (0, 1)]
        ).collect()[0].asDict()
    found: dict[tuple, int] = {}
    of = [found.setdefault((m, sums.get(f"s0_{i}"), sums.get(f"s1_{i}")), len(found)) for i, m in enumerate(missing)]
    return of, [of.index(g) for g in range(len(found))]


def _cells(slim: DataFrame, p: int, heads: Sequence[int], keep: Sequence[str] = ()) -> DataFrame:
    """Present cells as (keep..., c, value, present in pattern 0, 1, ...)."""
    flags = [F.col(f"v{h}").isNotNull().cast("int").alias(f"p{g}") for g, h in enumerate(heads)]
    stacked = slim.select("*", *flags).unpivot(
        [*keep, *[f"p{g}" for g in range(len(heads))]], [f"v{i}" for i in range(p)], "c", "value"
    )
    return stacked.where(F.col("value").isNotNull()).withColumn("c", F.expr("CAST(substring(c, 2) AS INT)"))


def _pair_sums(ranks: np.ndarray, present: np.ndarray, of: np.ndarray) -> dict[str, np.ndarray]:
    """Sums of products and of squares for every pair; ``ranks`` are (row, column, pattern), 0 where missing."""
    if ranks.shape[2] == 1:
        own = ranks[:, :, 0]
        return {"xy": own.T @ own, "xx": np.repeat((own * own).sum(axis=0)[:, None], own.shape[1], axis=1)}
    against = np.where(present[:, :, None] & present[:, None, :], ranks[:, :, of], 0.0)
    return {"xy": np.einsum("kab,kba->ab", against, against), "xx": np.einsum("kab,kab->ab", against, against)}


def _added(parts: Iterator[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for part in parts:
        total = {k: total[k] + v for k, v in part.items()} if total else part
    if total:
        yield rows_of(total)


def _looked_up(slim: DataFrame, ranks: DataFrame, p: int, of: np.ndarray) -> DataFrame:
    """Pair sums per task where the ranks are few enough to travel to every task."""
    few = ranks.select("c", "value", "r").toPandas().sort_values(["c", "value"])
    g = int(of.max()) + 1
    tables = []
    for i in range(p):
        mine = few[few["c"] == i]
        tables.append((mine["value"].to_numpy(float), np.array(mine["r"].tolist(), float).reshape(-1, g)))
    step = max(1, CELLS // (p * max(p, g)))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                rows = batch.slice(start, step)
                ranked, present = np.zeros((rows.num_rows, p, g)), np.zeros((rows.num_rows, p), bool)
                for i, (values, mine) in enumerate(tables):
                    column = rows.column(i)
                    present[:, i] = column.is_valid().to_numpy(zero_copy_only=False)
                    here = present[:, i]
                    x = column.to_numpy(zero_copy_only=False)[here]
                    ranked[here, i] = mine[np.searchsorted(values, x)]
                yield _pair_sums(ranked, present, of)

    return slim.mapInArrow(lambda batches: _added(parts(batches)), "block string, v array<double>")


def _joined(slim: DataFrame, ranks: DataFrame, p: int, heads: Sequence[int], of: np.ndarray) -> DataFrame:
    """Pair sums per task where ranks are joined to the cells and the cells brought back to their rows."""
    numbered = materialise(slim.withColumn("id", F.monotonically_increasing_id()))
    cells = _cells(numbered, p, heads, ["id"]).select("id", "c", F.struct("c", "value").alias("cell"))
    table = ranks.select(F.struct("c", "value").alias("__value"), "r", F.col("n").alias("__n"))
    rows = lookup_join(cells, F.col("cell"), table, "__value", "__n", False).select("id", "c", "r")
    rows = rows.repartition("id").sortWithinPartitions("id")
    g = len(heads)
    step = max(1, CELLS // (p * max(p, g)))

    def sums(ids: np.ndarray, c: np.ndarray, r: np.ndarray) -> Iterator[dict[str, np.ndarray]]:
        row = np.cumsum(np.r_[0, ids[1:] != ids[:-1]])
        for start in range(0, int(row[-1]) + 1, step):
            a, b = np.searchsorted(row, [start, start + step])
            at = row[a:b] - start
            ranked, present = np.zeros((int(at[-1]) + 1, p, g)), np.zeros((int(at[-1]) + 1, p), bool)
            ranked[at, c[a:b]], present[at, c[a:b]] = r[a:b], True
            yield _pair_sums(ranked, present, of)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("r").flatten().to_numpy(zero_copy_only=False).reshape(-1, g)
            new = (batch.column("id").to_numpy(), batch.column("c").to_numpy(), flat)
            ids, c, r = new if held is None else [np.concatenate(both) for both in zip(held, new)]
            # the cells of the last row may go on in the next batch
            cut = int(np.searchsorted(ids, ids[-1]))
            if cut:
                yield from sums(ids[:cut], c[:cut], r[:cut])
            held = (ids[cut:], c[cut:], r[cut:])
        if held is not None:
            yield from sums(*held)

    return rows.mapInArrow(lambda batches: _added(parts(batches)), "block string, v array<double>")


def rank_correlations(df: DataFrame, columns: Sequence[str], small: bool | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows used, Spearman correlation) of every pair, each on the rows where both are present.

    Ties share their mean rank; a pair without spread or without shared rows is NaN.  Up to
    ``SMALL_VALUES`` distinct cells the ranks travel to the rows, beyond that they are joined.  What the
    driver holds are numbers per pair of columns.
    """
    p = len(columns)
    n, r = np.zeros((p, p)), np.full((p, p), np.nan)
    if not p:
        return n, r
    # adding zero makes one value of the two zeros
    slim = spread_out(df.select(*[(num(df, c) + F.lit(0.0)).alias(f"v{i}") for i, c in enumerate(columns)]))
    of, heads = _patterns(slim, p)
    width = range(len(heads))
    counted = _cells(slim, p, heads).groupBy("c", "value")
    counts = materialise(counted.agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"p{g}").alias(f"n{g}") for g in width]))
    totals = counts.groupBy("c").agg(F.count(F.lit(1)).alias("cells"), *[F.sum(f"n{g}").alias(f"n{g}") for g in width])
    totals = {t["c"]: t for t in totals.collect()}
    if not totals:
        return n, r
    shared = np.array([[totals[i][f"n{g}"] if i in totals else 0 for g in width] for i in range(p)])
    n = shared[:, of].astype(float)
    earlier = np.cumsum(shared, axis=0) - shared
    if small is None:
        small = sum(t["cells"] for t in totals.values()) <= SMALL_VALUES
    scan = ordered_scan(
        counts, [F.col("c"), F.col("value")], {f"cum{g}": F.col(f"n{g}") for g in width}, small=small
    )
    # distance from the mean rank: rows up to here less half of the ties, less half of all rows
    middle = (earlier + shared / 2.0).tolist()
    middles = local_rows(df.sparkSession, list(enumerate(middle)), "c int, middle array<double>")
    centred = [F.col(f"cum{g}") - F.col(f"n{g}") / F.lit(2.0) - F.col("middle")[g] for g in width]
    ranks = scan.join(F.broadcast(middles), "c").select("c", "value", "n", F.array(*centred).alias("r"))
    of = np.array(of)
    found = tree_sum(_looked_up(slim, ranks, p, of) if small else _joined(slim, materialise(ranks), p, heads, of))
    xy, xx = found["xy"].reshape(p, p), found["xx"].reshape(p, p)
    spread = np.sqrt(xx) * np.sqrt(xx.T)
    np.divide(xy, spread, out=r, where=spread > 0)
    r = np.clip(r, -1.0, 1.0)
    r[np.diag_indices(p)] = np.where(np.diag(xx) > 0, 1.0, np.nan)
    return n, r
