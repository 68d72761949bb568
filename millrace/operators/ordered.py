"""Global order without a one-task window.

A window without PARTITION BY sends the table to a single task.  Here rows are range-partitioned on
a full ordering (value plus a unique tie-break, so that a value held by a third of the rows still
splits), sorted inside their ranges and written once: the only exchange.  A pass over each range then
reports its row count, totals and last values; with what the ranges before it add up to, a second pass
numbers the rows, runs the totals and looks back, batch after batch.
"""

from __future__ import annotations

from itertools import accumulate
from typing import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, present
from ..functions.lineage import materialise

SMALL_VALUES = 100_000


def _few(df: DataFrame) -> bool:
    return df.limit(SMALL_VALUES + 1).count() <= SMALL_VALUES


def _total_type(dtype: T.DataType) -> T.DataType:
    """The type in which Spark adds up values of ``dtype``."""
    if isinstance(dtype, T.DecimalType):
        return T.DecimalType(min(38, dtype.precision + 10), dtype.scale)
    return T.DoubleType() if isinstance(dtype, T.FractionalType) else T.LongType()


def _running(values, start):
    """Running totals of an Arrow array from ``start`` on; nulls add nothing, overflow is an error."""
    import pyarrow as pa
    import pyarrow.compute as pc

    filled = pc.fill_null(values, pa.scalar(0, values.type))
    if pa.types.is_decimal(values.type):
        # Arrow has no running sum of decimals
        return pa.array(list(accumulate(filled.to_pylist(), initial=start.as_py()))[1:], values.type)
    return pc.cumulative_sum_checked(filled, start=start)


def _range_layout(keyed: DataFrame, keys: Sequence[str], keep: Sequence[str], parts: int) -> DataFrame:
    """Rows sorted inside consecutive ranges of ``keys``; one partition is one range, named in ``__range``."""
    ordered = keyed.repartitionByRange(parts, *[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    return ordered.select(*[col(k) for k in keep], F.spark_partition_id().alias("__range"))


def _range_ends(layout: DataFrame, sums: Sequence[str], span: int) -> list:
    """One row per range that holds rows: its number, row count, totals and last ``span`` of ``__value``."""
    import pyarrow as pa

    fields = [T.StructField("__range", T.IntegerType()), T.StructField("n", T.LongType())]
    fields += [T.StructField(s, layout.schema[s].dataType) for s in sums]
    if span:
        fields.append(T.StructField("tail", T.ArrayType(layout.schema["__value"].dataType)))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n, totals, last, types = None, 0, {}, None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            at, n = batch.column("__range")[0], n + batch.num_rows
            for s in sums:
                types[s] = batch.column(s).type
                totals[s] = _running(batch.column(s), totals.get(s, pa.scalar(0, types[s])))[-1]
            if span:
                value = batch.column("__value")
                joined = value if last is None else pa.concat_arrays([last, value])
                last = pa.concat_arrays([joined.slice(max(0, len(joined) - span))])
        if n:
            row = {"__range": pa.array([at.as_py()], pa.int32()), "n": pa.array([n], pa.int64())}
            row |= {s: pa.array([totals[s].as_py()], types[s]) for s in sums}
            if span:
                row["tail"] = pa.array([last.to_pylist()], pa.list_(last.type))
            yield pa.RecordBatch.from_pydict(row)

    return sorted(layout.mapInArrow(ends, T.StructType(fields)).collect(), key=lambda r: r["__range"])


def _range_scan(
    df: DataFrame,
    order: Sequence[Column],
    sums: Mapping[str, Column],
    index: str,
    parts: int,
    lags: Mapping[str, int] | None = None,
    value: Column | None = None,
) -> DataFrame:
    """``df`` with its place, running totals and earlier values, in one exchange.

    What reaches the driver and goes back to the tasks is one row per range: a count, a total per sum
    and as many values as the longest lag.
    """
    import numpy as np
    import pyarrow as pa

    lags = dict(lags or {})
    span = max(lags.values(), default=0)
    added = [s.alias(f"__s{i}") for i, s in enumerate(sums.values())] + ([value.alias("__value")] if span else [])
    keyed = df.select("*", *[o.alias(f"__o{i}") for i, o in enumerate(order)], *added)
    names = [f"__s{i}" for i in range(len(sums))]
    for s in names:
        keyed = keyed.withColumn(s, F.col(s).cast(_total_type(keyed.schema[s].dataType)))
    keep = [*df.columns, *names, *(["__value"] if span else [])]
    layout = materialise(_range_layout(keyed, [f"__o{i}" for i in range(len(order))], keep, parts))

    before, rows, totals, tail = {}, 0, [0] * len(names), [None] * span
    for r in _range_ends(layout, names, span):
        before[r["__range"]] = (rows, list(totals), list(tail))
        rows += r["n"]
        totals = [t + r[s] for t, s in zip(totals, names)]
        tail = (tail + list(r["tail"]))[-span:] if span else tail

    fields = [f for f in layout.schema.fields if f.name in set(df.columns)]
    fields.append(T.StructField(index, T.LongType(), False))
    fields += [T.StructField(n, layout.schema[s].dataType) for n, s in zip(sums, names)]
    fields += [T.StructField(n, layout.schema["__value"].dataType) for n in lags]
    plain, total_names = list(df.columns), list(sums)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, running, last = None, [], None
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            if place is None:
                place, start, values = before[batch.column("__range")[0].as_py()]
                running = [pa.scalar(t, batch.column(s).type) for t, s in zip(start, names)]
                if span:
                    last = pa.array(values, batch.column("__value").type)
            out = {c: batch.column(c) for c in plain}
            out[index] = pa.array(np.arange(place, place + m, dtype=np.int64))
            place += m
            for i, (name, s) in enumerate(zip(total_names, names)):
                out[name] = _running(batch.column(s), running[i])
                running[i] = out[name][-1]
            if span:
                joined = pa.concat_arrays([last, batch.column("__value")])
                out |= {name: joined.slice(span - k, m) for name, k in lags.items()}
                last = pa.concat_arrays([joined.slice(m)])
            yield pa.RecordBatch.from_pydict(out)

    return layout.mapInArrow(scan, T.StructType(fields))


def _range_count(df: DataFrame, partitions: int | None) -> int:
    return partitions or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def ordered_scan(
    df: DataFrame,
    order: Sequence[Column],
    sums: Mapping[str, Column] | None = None,
    index: str = "row_index",
    partitions: int | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Add a dense 0-based ``index`` in the given order and running totals of ``sums``.

    ``order`` must be total, i.e. end in a unique key, or the rows must be indistinguishable.  A
    table counted at ``SMALL_VALUES`` rows or fewer takes a plain window, beyond that the ranged scan.
    """
    sums = dict(sums or {})
    if not (_few(df) if small is None else small):
        return _range_scan(df, order, sums, index, _range_count(df, partitions))
    w = Window.orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(
        *[col(c) for c in df.columns],
        (F.row_number().over(w) - 1).cast("bigint").alias(index),
        *[F.coalesce(F.sum(s).over(upto), F.lit(0)).alias(n) for n, s in sums.items()],
    )


def lagged(
    df: DataFrame,
    order: Sequence[Column],
    lags: Sequence[int],
    value: str,
    partitions: int | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Add ``row_index`` and ``{value}_lag{k}``: the value k rows earlier (null for the first k rows).

    Rows of equal ``order`` follow each other by value, so the result is defined for any table; name a
    unique key last in ``order`` all the same, because indistinguishable rows share one range.
    """
    order = [*order, col(value)]
    if _few(df) if small is None else small:
        w = Window.orderBy(*order)
        return df.select(
            *[col(c) for c in df.columns],
            (F.row_number().over(w) - 1).cast("bigint").alias("row_index"),
            *[F.lag(col(value), k).over(w).alias(f"{value}_lag{k}") for k in lags],
        )
    names = {f"{value}_lag{k}": k for k in lags}
    return _range_scan(df, order, {}, "row_index", _range_count(df, partitions), names, col(value))


def ranked_values(df: DataFrame, name: str) -> tuple[DataFrame, bool]:
    """Distinct non-missing values as (value, rank from 0, n rows), and whether they are few.

    Few means counted at or below ``SMALL_VALUES``; then one sorted task is enough and the result
    may be broadcast.
    """
    values = (
        df.select(present(df, name).alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    n = values.limit(SMALL_VALUES + 1).count()
    if n <= SMALL_VALUES:
        w = Window.orderBy("value")
        return values.select("value", (F.row_number().over(w) - 1).cast("bigint").alias("rank"), "n"), True
    return ordered_scan(values, [F.col("value")], index="rank", small=False).select("value", "rank", "n"), False


def average_ranks(counts: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Add ``avg_rank`` to a table of distinct ``value`` with their multiplicity ``n``.

    Ties share the mean of the ranks they cover.  ``within`` ranks several columns' values side by
    side in one pass: the order is (within..., value), and the rows of earlier groups are taken off.
    """
    # the grouped counts are read several times below (size check, range sample, scan)
    counts = materialise(counts)
    keys = [F.col(k) for k in within] + [F.col("value")]
    scanned = ordered_scan(counts, keys, {"__cum": F.col("n")}).drop("row_index")
    if within:
        totals = counts.groupBy(*within).agg(F.sum("n").alias("__total"))
        base = totals.select(
            *within,
            F.coalesce(
                F.sum("__total").over(
                    Window.orderBy(*[F.col(k) for k in within]).rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("__base"),
        )
        # one row per ranked column
        scanned = scanned.join(F.broadcast(base), list(within))
    else:
        scanned = scanned.withColumn("__base", F.lit(0))
    rank = F.col("__cum") - F.col("__base") - F.col("n") + (F.col("n") + 1) / F.lit(2.0)
    return scanned.withColumn("avg_rank", rank).drop("__cum", "__base")
