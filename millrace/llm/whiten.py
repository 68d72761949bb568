"""Whitening of embeddings by principal components, with eigenvectors refined in higher precision.

Entries c become whole numbers x = floor(SCALE * c) + SHIFT.  The covariance is that of every distinct
vector once: task by task, vectors are centred at the rounded means, multiplied and added in a tree; the
means' fractions are taken off exactly.  With entries of usual size all products and sums are whole numbers
below 2^53, so the matrix doesn't depend on how the rows are dealt.

Its eigenvectors come from a float32 decomposition and are corrected by the matrix-multiplication
iteration of Ogita and Aishima in extended precision, which squares the error each time.  Eigenvalues closer
than the current error can't be told apart that way: they form a cluster, whose columns are turned by the
eigenvectors of the cluster's own small matrix, shifted by its mean so that the differences are resolved.

* vectors that are null, empty, hold null or non-finite entries, or have another length than the most
  frequent (of equals the longest) are dropped
* repeated vectors count once in the fit and each gets its rows
* equal eigenvalues: any basis of their space
* components without variance (fewer distinct vectors than dimensions, constant entries) have whitened
  values null; an empty table gives no rows
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from ..functions.treesum import rows_of, tree_sum
from .batches import stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
STEPS = 12  # iterations at most; each squares the error
WIDE = np.longdouble


@dataclass
class Model:
    n: int  # distinct vectors
    sums: np.ndarray  # whole numbers per dimension
    vectors: np.ndarray  # dimension x component
    values: np.ndarray  # eigenvalues, falling
    trace: float
    identity_error: float | None


def usable(vector: Column) -> Column:
    """Neither null nor empty nor with null or non-finite entries."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def whole(df: DataFrame, keep: list[str], vector: str) -> DataFrame:
    """``keep`` and ``__x``, the whole numbers, of the rows that count."""
    rows = df.select(*[col(c).alias(c) for c in keep], col(vector).alias("__v")).where(usable(F.col("__v")))
    sizes = rows.groupBy(F.size("__v").alias("size")).agg(F.count("*").alias("n"))
    size = sizes.orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    x = F.transform("__v", lambda c: F.floor(c.cast("double") * SCALE).cast("bigint") + SHIFT)
    return rows.where(F.size("__v") == (size[0]["size"] if size else 0)).select(*keep, x.alias("__x"))


def _matrix(batch: pa.RecordBatch, column: int) -> np.ndarray:
    flat = batch.column(column).flatten().to_numpy()
    return flat.reshape(batch.num_rows, -1)


def _sums(fit: DataFrame, blocks, kind: str) -> dict[str, np.ndarray]:
    """Blocks of numbers per batch of vectors, added up over the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[str, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                for k, v in blocks(_matrix(batch, 0)).items():
                    acc[k] = acc[k] + v if k in acc else v
        if acc:
            yield rows_of(acc)

    return tree_sum(fit.select("__x").mapInArrow(run, f"block string, v array<{kind}>"))


def covariance(fit: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """(vectors, sums, covariance in extended precision) of a table of whole vectors."""
    first = _sums(fit, lambda x: {"sums": x.sum(axis=0), "n": np.array([len(x)])}, "bigint")
    if not first:
        return 0, np.zeros(0, np.int64), np.zeros((0, 0), WIDE)
    n, sums = int(first["n"][0]), first["sums"]
    middle = np.rint(sums / n).astype(np.int64)

    def products(x: np.ndarray) -> dict[str, np.ndarray]:
        y = (x - middle).astype(np.float64)
        return {"products": y.T @ y}

    got = _sums(fit, products, "double")["products"].reshape(len(sums), -1)
    rest = (sums - n * middle).astype(WIDE) / n  # at most one half
    v = got.astype(WIDE) / n - np.outer(rest, rest)
    return n, sums, (v + v.T) / 2


def _clusters(values: np.ndarray, near: WIDE) -> list[np.ndarray]:
    """Runs of sorted eigenvalues with gaps up to ``near``."""
    order = np.argsort(-values, kind="stable")
    cuts = np.flatnonzero(-np.diff(values[order]) > near) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def _improved(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, WIDE]:
    """One iteration: (better eigenvectors, eigenvalues, largest correction)."""
    eye = np.eye(len(a), dtype=WIDE)
    r, s = eye - x.T @ x, x.T @ a @ x
    values = np.diag(s) / (1 - np.diag(r))
    norm = np.sqrt((a * a).sum())
    near = 2 * (np.sqrt(((s - np.diag(values)) ** 2).sum()) + norm * np.sqrt((r * r).sum()))
    gaps = values[None, :] - values[:, None]
    apart = np.abs(gaps) > near
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gaps, 1), r / 2)
    return x + x @ e, values, np.abs(e).max()


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors) of a symmetric matrix in extended precision.

    The iteration ends when a step corrects less than double precision can show.
    """
    a = np.asarray(a, WIDE)
    if not len(a):
        return np.zeros(0, WIDE), a
    scale = np.abs(a).max()
    if not scale:
        return np.zeros(len(a), WIDE), np.eye(len(a), dtype=WIDE)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    for _ in range(STEPS):
        x, values, change = _improved(a, x)
        s = x.T @ a @ x
        off = np.abs(s - np.diag(np.diag(s)))
        for these in _clusters(values, 4 * np.sqrt((off**2).sum()) + 64 * np.finfo(WIDE).eps):
            block = x[:, these]
            block = block + block @ (np.eye(len(these), dtype=WIDE) - block.T @ block) / 2
            middle = values[these].mean()
            small = block.T @ (a @ block - middle * block)
            x[:, these] = block @ _turned((small + small.T) / 2)
        if change < 1e-17:
            break
    for _ in range(3):  # columns of nearly equal, tiny eigenvalues
        x = x + x @ (np.eye(len(a), dtype=WIDE) - x.T @ x) / 2
    values = np.diag(x.T @ a @ x)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


def _turned(small: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors of a cluster's own matrix, scaled up so that its differences show."""
    size = np.abs(small).max()
    if not size:
        return np.eye(len(small), dtype=WIDE)
    w = np.linalg.eigh((small / size).astype(np.float64))[1].astype(WIDE)
    return w + w @ (np.eye(len(w), dtype=WIDE) - w.T @ w) / 2


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Model:
    """Whitening learnt from every distinct vector of the table."""
    return _fit(stored(whole(df, [], vector).distinct()), components)


def _fit(distinct: DataFrame, components: int) -> Model:
    n, sums, v = covariance(distinct)
    values, vectors = eigen(v)
    trace = float(np.trace(v)) if n else 0.0
    model = Model(n, sums, vectors[:, :components].astype(float), values[:components].astype(float), trace, None)
    kept = _varying(model)
    if kept.any():
        made = _sums(distinct, lambda x: _moments(_whitened(x, model)[:, kept]), "double")
        mean = made["sum"] / n
        off = made["products"].reshape(len(mean), -1) / n - np.outer(mean, mean) - np.eye(len(mean))
        model.identity_error = float(np.abs(off).max())
    return model


def _moments(z: np.ndarray) -> dict[str, np.ndarray]:
    return {"sum": z.sum(axis=0), "products": z.T @ z}


def _varying(model: Model) -> np.ndarray:
    """Components whose variance is more than what rounding leaves."""
    return model.values > model.trace * max(1, len(model.sums)) * np.finfo(float).eps


def _whitened(x: np.ndarray, model: Model) -> np.ndarray:
    middle = model.sums // max(1, model.n)
    centred = (x - middle) - (model.sums - model.n * middle) / model.n  # whole numbers first: nothing cancels
    with np.errstate(divide="ignore", invalid="ignore"):
        return centred @ model.vectors / np.sqrt(np.maximum(model.values, 0))


def _deviations(x: np.ndarray, model: Model) -> np.ma.MaskedArray:
    """Sum over dimensions of (n x - S)^2, masked where a long can't hold it."""
    rough = ((x.astype(float) * model.n - model.sums) ** 2).sum(axis=1)
    large = (rough >= 2.0**62) | (np.abs(x).max(axis=1).astype(float) * model.n >= 2.0**62)
    out = np.zeros(len(x), np.int64)
    out[~large] = ((x[~large] * model.n - model.sums) ** 2).sum(axis=1)
    return np.ma.array(out, mask=large)


def apply(df: DataFrame, model: Model, keep: list[str], vector: str = "embedding") -> DataFrame:
    """``keep``, component (from 1), n, deviation, whitened, explained, identity_error: a row per vector that
    counts and component.  A deviation over 2^62 is null."""
    rows = whole(df, keep, vector)
    fields = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    schema = T.StructType([*rows.schema.fields[:-1], *T._parse_datatype_string(fields).fields])
    width, k, kept = len(keep), len(model.values), _varying(model)
    share = model.values / model.trace if model.trace else np.full(k, np.nan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m or not k:
                continue
            x = _matrix(batch, width)
            deviation = _deviations(x, model)
            each = pa.array(np.repeat(np.arange(m), k))
            error = pa.nulls(m * k, pa.float64()) if model.identity_error is None else pa.array(np.full(m * k, model.identity_error))
            new = [
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n)),
                pa.array(deviation.data, mask=np.ma.getmaskarray(deviation)).take(each),
                pa.array(_whitened(x, model).ravel(), mask=np.tile(~kept, m)),
                pa.array(np.tile(share, m), mask=np.tile(np.isnan(share), m)),
                error,
            ]
            yield pa.RecordBatch.from_arrays([*[c.take(each) for c in batch.columns[:width]], *new], names=schema.names)

    return rows.mapInArrow(run, schema)
