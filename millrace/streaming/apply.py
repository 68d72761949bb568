"""Fitted steps and saved models on a stream.

No operator needs a stream; this only shows that fitted steps, being plain projections,
and ``PipelineModel``s apply to a streaming table unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def score_stream(stream: DataFrame, step, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Apply anything with ``transform`` to a stream and append the rows as parquet."""
    writer = step.transform(stream).writeStream.format("parquet").outputMode("append")
    return writer.option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
