"""Per-batch Python work inside Spark tasks, and the shared folder for tables that are read twice."""

from __future__ import annotations

import contextlib
import ctypes
import re
import uuid
from typing import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from ..functions.lineage import ensure_checkpoint_dir

ROWS = 500  # rows handled at once
CHARS = 2_000_000  # and characters, so that very long texts come in smaller groups
ARROW_ROWS = 1000  # rows that travel to a worker at once
SMALL = 500_000  # rows of a few numbers that may be sent to every task


def released() -> None:
    """Give back to the system what tasks of this worker no longer use: workers live on for later stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries lack it
        ctypes.CDLL(None).malloc_trim(0)


def small_batches(spark: SparkSession) -> None:
    """Texts travel in batches of ARROW_ROWS, which take a tenth of the memory beside the Java heap, unless
    the session sets another number than the default itself."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(ARROW_ROWS))


def stored(df: DataFrame) -> DataFrame:
    """Write a table as Parquet to the shared checkpoint folder and read it back.

    It cuts lineage (a lost executor costs a re-read, not a re-run), and later scans read only the
    columns they need.
    """
    spark = df.sparkSession
    place = f"{_folder(spark)}/millrace-{uuid.uuid4().hex}"
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)


def shuffled(df: DataFrame) -> DataFrame:
    """The table as a side of a join that moves rows by key, never whole through the driver.

    Spark takes a table's size from its files, before lists are exploded and columns decoded, and would send
    millions of rows to every task as if they were few.
    """
    return df.hint("merge")


def looked_up(df: DataFrame, rows: int) -> DataFrame:
    """The table as a side of a join: sent to every task if its ``rows``, counted or bounded, are few, else shuffled."""
    return F.broadcast(df) if rows <= SMALL else shuffled(df)


def _folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def packed(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of a row as the struct ``row`` beside the text, so that no result name can clash."""
    return docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), col(text).alias("text"))


def known_labels(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(label_id, label): one row per labelled id that some document with a text has, so that a sample of
    labels is one of documents; of labels that share an id the greatest."""
    one = labels.select(col("doc_id").alias("label_id"), col(label).alias("label")).where("label_id is not null")
    one = one.groupBy("label_id").agg(F.max("label").alias("label"))
    present = docs.where(col(text).isNotNull()).select(col(key).alias("label_id")).distinct()
    return one.join(present, "label_id", "left_semi")


def over_texts(
    df: DataFrame,
    keep: Sequence[str],
    fields: Sequence[T.StructField],
    make: Callable[[], Callable[[list], list[pa.Array]]],
    text: str = "text",
    raw: bool = False,
    rows: int | None = None,
) -> DataFrame:
    """Columns ``keep`` and new columns computed from the text, batch by batch.

    ``make()`` runs once per task and returns a function from a list of texts (None for null), or with
    ``raw`` from their Arrow array, to one Arrow array per field.  It gets at most ``rows`` texts at once, ROWS
    by default.  Rows stay where they are: no shuffle.
    """
    small_batches(df.sparkSession)
    picked = df.select(*[col(c).alias(c) for c in keep], col(text).alias("__text"))
    schema = T.StructType([*picked.schema.fields[:-1], *fields])
    width, names = len(keep), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        compute = make()
        for batch in batches:
            for part in _pieces(batch, width, rows):
                texts = part.column(width)
                new = compute(texts if raw else texts.to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:width], *new], names=names)
        compute = batch = part = texts = new = None  # or the worker would keep them while it waits
        released()

    return picked.mapInArrow(run, schema)


def _pieces(batch: pa.RecordBatch, column: int, most: int | None = None) -> Iterator[pa.RecordBatch]:
    start = 0
    while start < batch.num_rows:
        rows = min(most or ROWS, batch.num_rows - start)
        while rows > 1 and batch.column(column).slice(start, rows).nbytes > CHARS:
            rows = (rows + 1) // 2
        yield batch.slice(start, rows)
        start += rows


class Memo(dict):
    """Results per key for the life of a worker.

    When it is full, what the last ``limit`` new keys have not touched is forgotten; that costs time
    only.  Keys over ``LONG`` characters are kept for the current batch alone.
    """

    LONG = 64
    BLOCK = 10_000  # keys made in one call, which bounds the arrays behind it

    def __init__(self, make: Callable[[list], Sequence], limit: int = 150_000):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def learn(self, keys: set) -> None:
        """Afterwards every one of ``keys`` is present; what is missing is made in blocks."""
        if len(self) > self.limit:
            self.old = {k: v for k, v in self.items() if len(k) <= self.LONG}
            self.clear()
        new = [k for k in keys if k not in self]
        old = self.old
        self.update((k, old[k]) for k in new if k in old)
        if missing := [k for k in new if k not in old]:
            for i in range(0, len(missing), self.BLOCK):
                block = missing[i : i + self.BLOCK]
                self.update(zip(block, self.make(block)))


SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
WIDE_SPACE = re.compile(r"\s\s|^\s|\s$")


def chunk_words(text: str) -> list[str]:
    """Pieces whose byte-level BPE tokens, joined, are those of the text, all but the first without the space
    before them.

    The usual pre-tokenisation patterns match a lone space together with the word behind it and never
    match across it, so a text may be cut before any space that stands between two other characters.
    """
    return (SAFE_SPACE.split(text) if WIDE_SPACE.search(text) else text.split(" ")) if text else []


def blocks(text: str, size: int = CHARS) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut where :func:`chunk_words` may cut."""
    start = 0
    while len(text) - start > size and (cut := SAFE_SPACE.search(text, start + size)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def chunks(text: str) -> list[str]:
    """:func:`chunk_words` with their spaces."""
    words = chunk_words(text)
    return [*words[:1], *[" " + w for w in words[1:]]]
