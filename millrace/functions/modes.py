"""The exact most frequent value of many columns, without shuffling every distinct value.

Counts of hash buckets bound the counts of the values in them.  The fullest bucket of each column is counted
by value first; from then on only buckets that hold at least as many rows as the best value so far can
matter.  They are counted in slices of bounded size, fullest first, until none is left.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import col, dtype_of, local_rows, num, present
from .lineage import materialise, spread_out

BUCKETS = 65_536
SLICE = 10_000_000_000  # rows counted by value in one pass
FEW = 10_000_000  # rows of a table whose values are simply counted
BROADCAST = 1_000_000  # buckets of a slice, two small numbers each


def _kind(df: DataFrame, name: str, as_text: bool) -> str:
    """The type a column is counted in: whole numbers and decimals stay exact, dates and times stay themselves."""
    dtype = dtype_of(df, name)
    if as_text or isinstance(dtype, T.StringType):
        return "string"
    if isinstance(dtype, T.IntegralType):
        return "bigint"
    if isinstance(dtype, (T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return dtype.simpleString()
    return "double"


def _stacked(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """Present cells of columns of one kind as (c, value)."""

    def cell(name):
        if kind == "string":
            return col(name).cast("string")
        # adding zero makes one value of the two zeros
        return num(df, name) + F.lit(0.0) if kind == "double" else present(df, name).cast(kind)

    slim = df.select(*[cell(c).alias(f"v{i}") for i, c in enumerate(columns)])
    long = spread_out(slim).unpivot([], [f"v{i}" for i in range(len(columns))], "c", "value")
    return long.where(F.col("value").isNotNull()).withColumn("c", F.expr("CAST(substring(c, 2) AS INT)"))


def _best(cells: DataFrame) -> list:
    """(c, count, smallest value of that count, distinct values) of every column in ``cells``."""
    counted = cells.groupBy("c", "value").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("n"), "value"))
    return counted.groupBy("c").agg(first.alias("first"), F.count(F.lit(1)).alias("distinct")).collect()


def _by_buckets(cells: DataFrame, buckets: int, limit: int) -> dict[int, tuple]:
    bucket = F.pmod(F.xxhash64("value"), F.lit(buckets)).cast("int")
    cells = cells.withColumn("b", bucket)
    sizes = cells.groupBy("c", "b").agg(F.count(F.lit(1)).alias("n"))
    fullest = Window.partitionBy("c").orderBy(F.desc("n"), "b")
    upto = fullest.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # at most ``buckets`` rows per column
    sizes = materialise(sizes.select("*", F.row_number().over(fullest).alias("rank"), F.sum("n").over(upto).alias("rows")))
    best: dict[int, tuple] = {}
    done = {r["c"]: (0, 0) for r in sizes.select("c").distinct().collect()}
    first = True
    while done:
        # per column: rank reached, rows up to there, rows a bucket needs to matter
        state = [(c, rank, rows, best[c][0] if c in best else 0) for c, (rank, rows) in done.items()]
        known = local_rows(cells.sparkSession, state, "c int, reached int, before bigint, needed bigint")
        near = F.col("rank") == F.col("reached") + 1
        if not first:
            near |= F.col("rows") - F.col("before") <= F.lit(max(1, limit // len(done)))
        chosen = sizes.join(F.broadcast(known), "c").where(near & (F.col("rank") > F.col("reached")) & (F.col("n") >= F.col("needed")))
        moved = chosen.groupBy("c").agg(F.max("rank").alias("rank"), F.max("rows").alias("rows"), F.count(F.lit(1)).alias("k")).collect()
        if not moved:
            break
        chosen = chosen.select("c", "b")
        few = sum(m["k"] for m in moved) <= BROADCAST
        for r in _best(cells.join(F.broadcast(chosen) if few else chosen, ["c", "b"], "left_semi")):
            found = (-r["first"]["n"], r["first"]["value"])
            held = best.get(r["c"])
            if held is None or found[0] > held[0] or (found[0] == held[0] and found[1] < held[1]):
                best[r["c"]] = found
        done = {m["c"]: (m["rank"], m["rows"]) for m in moved}
        first = False
    return best


def exact_modes(
    df: DataFrame,
    columns: Sequence[str],
    as_text: bool = False,
    few: bool | None = None,
    buckets: int = BUCKETS,
    limit: int = SLICE,
) -> dict[str, object]:
    """Most frequent value per column, the smallest of equally frequent ones, None without values.

    Whole numbers, decimals, dates and times are counted in their own type.  Tables of up to ``FEW`` rows
    are counted by value at once.  Beyond that a pass shuffles bucket counts or at most ``limit`` cells;
    a column of which hardly any value repeats leaves nothing to rule out and takes all its slices.
    """
    out: dict[str, object] = {c: None for c in columns}
    if not out:
        return out
    if few is None:
        few = df.limit(FEW + 1).count() <= FEW
    kinds: dict[str, list[str]] = {}
    for c in out:
        kinds.setdefault(_kind(df, c, as_text), []).append(c)
    for kind, names in kinds.items():
        cells = _stacked(df, names, kind)
        if few:
            best = {r["c"]: (-r["first"]["n"], r["first"]["value"]) for r in _best(cells)}
        else:
            best = _by_buckets(cells, buckets, limit)
        out.update({names[i]: value for i, (_, value) in best.items()})
    return out


def value_profile(df: DataFrame, columns: Sequence[str], as_text: bool = False) -> dict[str, tuple]:
    """{column: (mode, number of distinct values)}, both exact.

    An ordinary grouped count (map-side combined, spread over the cluster), because an exact number of
    distinct values needs every one of them; only the winner of each column is returned.
    """
    out: dict[str, tuple] = {c: (None, 0) for c in columns}
    kinds: dict[str, list[str]] = {}
    for c in out:
        kinds.setdefault(_kind(df, c, as_text), []).append(c)
    for kind, names in kinds.items():
        for r in _best(_stacked(df, names, kind)):
            out[names[r["c"]]] = (r["first"]["value"], r["distinct"])
    return out
