"""Cross-product matrices of many columns from one scan.

Up to a dozen columns the products are ordinary aggregates.  Beyond that each task multiplies its
own batches with numpy and emits one array per matrix; the arrays are added in a tree, so that a few
p x p matrices reach the driver, whatever the number of rows.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import correlation, num
from .treesum import rows_of, tree_sum

EXPRESSION_WIDTH = 12


def _slim(df: DataFrame, columns: Sequence[str], shift: Sequence[float]) -> DataFrame:
    return df.select(*[(num(df, c) - F.lit(float(s))).alias(f"g{i}") for i, (c, s) in enumerate(zip(columns, shift))])


def _partials(slim: DataFrame, p: int, blocks) -> dict[str, np.ndarray]:
    names = [f"g{i}" for i in range(p)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = None
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1).astype(float)
            part = blocks(x)
            acc = part if acc is None else {k: acc[k] + part[k] for k in part}
        if acc is not None:
            yield rows_of(acc)

    sums = tree_sum(slim.mapInArrow(run, "block string, v array<double>"))
    return {k: v.reshape(p, p) for k, v in sums.items()}


def gram_matrix(df: DataFrame, columns: Sequence[str], shift: Sequence[float] | None = None) -> tuple[int, np.ndarray]:
    """(rows used, X'X) over the rows complete in every column, columns shifted by ``shift``."""
    p = len(columns)
    shift = list(shift) if shift is not None else [0.0] * p
    slim = _slim(df, columns, shift).na.drop()
    if p <= EXPRESSION_WIDTH:
        pairs = [(i, j) for i in range(p) for j in range(i, p)]
        row = slim.agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(F.col(f"g{i}") * F.col(f"g{j}")).alias(f"s{i}_{j}") for i, j in pairs],
        ).collect()[0]
        g = np.zeros((p, p))
        for i, j in pairs:
            g[i, j] = g[j, i] = row[f"s{i}_{j}"] or 0.0
        return row["n"], g
    got = _partials(slim, p, lambda x: {"xx": x.T @ x, "n": np.full((p, p), float(len(x)))})
    if not got:
        return 0, np.zeros((p, p))
    return int(got["n"][0, 0]), got["xx"]


def pairwise_moments(df: DataFrame, columns: Sequence[str], shift: Sequence[float]) -> dict[str, np.ndarray]:
    """Pairwise-complete sums: n, sum x, sum x^2 and sum xy for every ordered pair (x over rows with y)."""
    p = len(columns)
    slim = _slim(df, columns, shift)

    def blocks(x):
        present = ~np.isnan(x)
        z = np.where(present, x, 0.0)
        m = present.astype(float)
        return {"n": m.T @ m, "sx": z.T @ m, "sxx": (z * z).T @ m, "sxy": z.T @ z}

    got = _partials(slim, p, blocks)
    return got or {k: np.zeros((p, p)) for k in ("n", "sx", "sxx", "sxy")}


def pairwise_correlation(df: DataFrame, columns: Sequence[str], means: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
    """(n, r) matrices over pairwise-complete rows."""
    p = len(columns)
    if p <= EXPRESSION_WIDTH:
        slim = _slim(df, columns, means)
        pairs = [(i, j) for i in range(p) for j in range(i + 1, p)]
        one = slim.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count(f"g{i}").alias(f"n{i}") for i in range(p)],
            *[F.var_pop(f"g{i}").alias(f"v{i}") for i in range(p)],
            *[F.covar_pop(f"g{i}", f"g{j}").alias(f"c{i}_{j}") for i, j in pairs],
        ).collect()[0]
        n, r = np.zeros((p, p)), np.full((p, p), np.nan)
        for i in range(p):
            n[i, i] = one[f"n{i}"]
            if one[f"v{i}"]:
                r[i, i] = 1.0
        gaps = [(i, j) for i, j in pairs if min(one[f"n{i}"], one[f"n{j}"]) < one["rows"]]
        for i, j in pairs:
            n[i, j] = n[j, i] = one["rows"]
            if one[f"v{i}"] and one[f"v{j}"] and one[f"c{i}_{j}"] is not None:
                r[i, j] = r[j, i] = one[f"c{i}_{j}"] / np.sqrt(one[f"v{i}"] * one[f"v{j}"])
        if gaps:
            # pairs touched by nulls need the variances of their shared rows
            row = slim.agg(
                *[correlation(F.col(f"g{i}"), F.col(f"g{j}")).alias(f"r{i}_{j}") for i, j in gaps],
                *[F.count(F.col(f"g{i}") + F.col(f"g{j}")).alias(f"n{i}_{j}") for i, j in gaps],
            ).collect()[0]
            for i, j in gaps:
                n[i, j] = n[j, i] = row[f"n{i}_{j}"]
                value = row[f"r{i}_{j}"]
                r[i, j] = r[j, i] = np.nan if value is None else value
        return n, r
    m = pairwise_moments(df, columns, means)
    n, sx, sxx, sxy = m["n"], m["sx"], m["sxx"], m["sxy"]
    with np.errstate(divide="ignore", invalid="ignore"):
        cov = sxy - sx * sx.T / n
        vx = sxx - sx * sx / n
        vy = sxx.T - sx.T * sx.T / n
        r = cov / np.sqrt(vx * vy)
    r = np.where((vx > 0) & (vy > 0), np.clip(r, -1.0, 1.0), np.nan)
    return n, r
