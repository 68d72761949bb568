"""Sums of wide arrays over all tasks, added in a tree."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MOST_ADDERS = 64


def tree_sum(parts: DataFrame) -> dict[str, np.ndarray]:
    """Sum of the arrays ``v`` for every ``block``, from rows (block string, v array<double or bigint>).

    Every task should give one row per block.  The rows are dealt to a few adders and only their sums,
    at most MOST_ADDERS rows per block, reach the driver, whatever the number of rows or tasks.
    Arrays of one block have one length; of whole numbers the sums are exact.
    """
    adders = min(MOST_ADDERS, max(2, parts.sparkSession.sparkContext.defaultParallelism))
    kind = parts.schema["v"].dataType.elementType.simpleString()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            blocks, values = batch.column("block").to_pylist(), batch.column("v")
            for i, block in enumerate(blocks):
                v = values.slice(i, 1).flatten().to_numpy(zero_copy_only=False)
                sums[block] = sums[block] + v if block in sums else v
        if sums:
            yield rows_of(sums)

    sums: dict[str, np.ndarray] = {}
    added = parts.select("block", "v").repartition(adders).mapInArrow(add, f"block string, v array<{kind}>")
    for r in added.toArrow().to_batches():
        for i, block in enumerate(r.column("block").to_pylist()):
            v = r.column("v").slice(i, 1).flatten().to_numpy(zero_copy_only=False)
            sums[block] = sums[block] + v if block in sums else v
    return sums


def rows_of(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row per block, for the tasks that feed :func:`tree_sum`."""
    flat = [np.ascontiguousarray(v).ravel() for v in sums.values()]
    ends = np.cumsum([0, *map(len, flat)]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat)))
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), lists], names=["block", "v"])
