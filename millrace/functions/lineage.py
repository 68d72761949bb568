"""Cutting lineage on reliable storage, and rows in tasks of bounded size."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TASK_ROWS = 500_000  # rows that a task of a trainer may hold; trees keep 200 to 350 bytes for each


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own, because a path on one
    machine would not be visible to the executors of a cluster.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return
    if sc.getCheckpointDir():
        return
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-checkpoint-"))


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under the checkpoint folder, which every executor can reach."""
    ensure_checkpoint_dir(spark)
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return f"{named.rstrip('/')}/{uuid.uuid4().hex}"


def spread_out(df: DataFrame) -> DataFrame:
    """Use all cores when the input comes in fewer pieces than half of them.

    A small file of one row group is read by one task; heavy per-row work behind it (hashing text,
    tokenising, training) would stay there.  Large inputs have splits enough and pass unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df


def bounded(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Deal the rows anew where a task would hold more than ``rows``, TASK_ROWS by default.

    Trainers that keep every partition in memory then hold, and read again, small parts of the table
    however large it is.  Tables whose tasks are small pass unchanged.
    """
    rows = rows or TASK_ROWS
    sizes = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))
    most, total = sizes.agg(F.max("n"), F.sum("n")).first()
    return df.repartition(math.ceil(total / rows)) if most and most > rows else df


def materialise(df: DataFrame) -> DataFrame:
    """Write the rows to the checkpoint folder and continue from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Like :func:`materialise`, as Parquet: smaller, and later scans read only the columns they need."""
    place = shared_folder(df.sparkSession)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)
