"""Reading tables and laying a target beside its features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import col, is_float, present

FORMATS = ("parquet", "orc", "json", "csv")


def scan_table(spark: SparkSession, path: str, fmt: str | None = None, schema=None, **options) -> DataFrame:
    """Load a table; the format follows the file extension unless given.

    CSV is read with a header.  Give ``schema`` for large CSV or JSON input: inferring one costs an
    extra pass over the data.
    """
    name = str(path).rstrip("/")
    if fmt is None:
        fmt = next((f for f in FORMATS if name.endswith("." + f)), "parquet")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        options = {"header": True, "inferSchema": schema is None, "nanValue": "NaN", **options}
    return reader.format(fmt).options(**options).load(name)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Fold NaN into NULL in every floating point column."""
    return df.select(
        *[present(df, f.name).alias(f.name) if is_float(f.dataType) else col(f.name) for f in df.schema.fields]
    )


def split_target(df: DataFrame, target: str | None = None) -> tuple[list[str], str]:
    """(feature names, target name); the last column is the target unless named."""
    target = target or df.columns[-1]
    return [c for c in df.columns if c != target], target
