"""Categorical encoders and text features."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, columns_of, lit_sql, num, quote
from ..functions.lineage import materialise, spread_out, written
from ..functions.steps import ColumnStep, fitted
from .lookup import lookup_join
from .ordered import SMALL_VALUES, ranked_values

MAX_LEVELS = 1000
TOKEN = r"[\p{L}\p{N}_]{2,}"
TEXTS = 200  # texts whose tokens are counted at once
FREQUENT = 200_000  # tokens, at most, whose idf is sent to every task


def distinct_values(df: DataFrame, columns: Sequence[str], max_levels: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Sorted distinct non-null values as text, refusing columns too varied to become columns."""
    columns = list(columns)
    if not columns:
        return {}
    rough = df.agg(*[F.approx_count_distinct(col(c)).alias(f"c{i}") for i, c in enumerate(columns)]).collect()[0]
    wide = [c for i, c in enumerate(columns) if rough[i] > 2 * max_levels]
    if wide:
        raise ValueError(f"too many distinct values for one column each: {wide}")
    stacked = df.select(*[col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], [col(c) for c in columns], "column", "value"
    )
    rows = stacked.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1))).collect()
    out: dict[str, list[str]] = {c: [] for c in columns}
    for r in rows:
        out[r["column"]].append(r["value"])
    for c, values in out.items():
        if len(values) > max_levels:
            raise ValueError(f"{c} has {len(values)} distinct values, more than {max_levels}")
        values.sort(key=lambda v: v.encode())
    return out


def onehot(df: DataFrame, columns: Sequence[str] | None = None, drop_first: bool = True) -> ColumnStep:
    """One 0/1 column ``{col}_{value}`` per value in sorted order; missing gives all zeros."""
    columns = list(columns) if columns is not None else columns_of(df, "string")
    levels = distinct_values(df, columns)
    exprs = {}
    for c in columns:
        for v in levels[c][1 if drop_first else 0 :]:
            exprs[f"{c}_{v}"] = f"CAST(coalesce(CAST({quote(c)} AS STRING) = {lit_sql(v)}, false) AS INT)"
    return fitted(df, exprs, drop=columns, state={c: {"levels": levels[c]} for c in columns})


def label_encode(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Sorted-order codes with missing as a category of its own, spelled 'nan'."""
    from .convert import category_codes

    columns = list(columns) if columns is not None else columns_of(df, "string")
    filled = df.select(
        *[F.coalesce(col(c).cast("string"), F.lit("nan")).alias(c) if c in columns else col(c) for c in df.columns]
    )
    return category_codes(filled, columns)


def label_step(df: DataFrame, columns: Sequence[str] | None = None) -> ColumnStep:
    """:func:`label_encode` as a saveable step for columns of few values; unseen values share the next code."""
    columns = list(columns) if columns is not None else columns_of(df, "string")
    levels = distinct_values(df, columns)
    exprs = {}
    for c in columns:
        known = sorted({*levels[c], "nan"}) if _has_null(df, c) else levels[c]
        known = ", ".join(lit_sql(v) for v in known)
        place = f"nullif(array_position(array({known}), coalesce(CAST({quote(c)} AS STRING), 'nan')), 0) - 1"
        exprs[c] = f"CAST(coalesce({place}, cardinality(array({known}))) AS DOUBLE)"
    return fitted(df, exprs, state={c: {"levels": levels[c]} for c in columns})


def label_steps(df: DataFrame, columns: Sequence[str]) -> list:
    """Steps that replace text columns by sorted-order codes: one expression for columns of few values, a
    joined table of ranks for each of the others, where missing and unseen values share the next code."""
    from .convert import distinct_counts

    counts = distinct_counts(df, list(columns), 2 * MAX_LEVELS)
    few = [c for c in columns if counts[c] <= MAX_LEVELS]
    steps: list = [label_step(df, few)] if few else []
    for c in columns:
        if c not in few:
            ranked, _ = ranked_values(df, c)
            ranked = materialise(ranked)
            steps.append(_encoder(df, c, None, ranked, F.col("rank").cast("double"), float(ranked.count())))
    return steps


def _has_null(df: DataFrame, column: str) -> bool:
    return not df.where(col(column).isNull()).isEmpty()


@dataclass
class ValueEncoder:
    """A fitted value -> number table; applying it is a skew-safe left join."""

    column: str
    table: DataFrame
    output: str
    default: float | None
    small: bool

    def transform(self, df: DataFrame) -> DataFrame:
        table = self.table.select(
            F.col("value").alias("__value"), F.col("encoded").alias("__encoded"), F.col("n").alias("__n")
        )
        joined = lookup_join(df, col(self.column), table, "__value", "__n", self.small)
        encoded = F.col("__encoded")
        if self.default is not None:
            encoded = F.coalesce(encoded, F.lit(self.default))
        keep = [encoded.alias(self.output) if c == self.output else col(c) for c in df.columns]
        if self.output not in df.columns:
            keep.append(encoded.alias(self.output))
        return joined.select(*keep)


def _encoder(df: DataFrame, column: str, output: str | None, stats: DataFrame, encoded: Column, default) -> ValueEncoder:
    table = stats.select("value", encoded.alias("encoded"), "n")
    small = stats.limit(SMALL_VALUES + 1).count() <= SMALL_VALUES
    return ValueEncoder(column, table, output or column, default, small)


def _value_counts(df: DataFrame, column: str, *more: Column) -> DataFrame:
    value = col(column).alias("value")
    return (
        df.where(col(column).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"), *more)
    )


def frequency_encode(df: DataFrame, column: str, output: str | None = None) -> ValueEncoder:
    """Share of all rows holding the value; missing stays missing."""
    total = df.count()
    return _encoder(df, column, output, _value_counts(df, column), F.col("n") / F.lit(float(total)), None)


def count_encode(df: DataFrame, column: str, output: str | None = None) -> ValueEncoder:
    """Number of rows holding the value; missing and unseen values count zero."""
    return _encoder(df, column, output, _value_counts(df, column), F.col("n").cast("double"), 0.0)


def target_encode(
    df: DataFrame,
    column: str,
    target: str,
    output: str | None = None,
    min_samples_leaf: float = 20.0,
    smoothing: float = 10.0,
) -> ValueEncoder:
    """Mean target of the value, blended with the overall mean by a sigmoid of its row count."""
    prior = df.agg(F.avg(num(df, target))).collect()[0][0]
    stats = _value_counts(df, column, F.avg(num(df, target)).alias("m"))
    weight = 1.0 / (1.0 + F.exp(-(F.col("n") - F.lit(min_samples_leaf)) / F.lit(smoothing)))
    return _encoder(df, column, output, stats, weight * F.col("m") + (1.0 - weight) * F.lit(prior), prior)


def woe_encode(
    df: DataFrame, column: str, target: str, output: str | None = None, regularization: float = 1.0
) -> ValueEncoder:
    """Weight of evidence of a binary target, regularised; missing and unseen values weigh zero."""
    y = num(df, target)
    row = df.agg(F.sum(y).alias("p"), F.count(y).alias("n")).collect()[0]
    pos, neg = float(row["p"]), float(row["n"] - row["p"])
    stats = _value_counts(df, column, F.sum(y).alias("p"))
    r = regularization
    p_share = (F.col("p") + r) / F.lit(pos + 2 * r)
    n_share = (F.col("n") - F.col("p") + r) / F.lit(neg + 2 * r)
    return _encoder(df, column, output, stats, F.log(p_share / n_share), 0.0)


def _counts(docs: DataFrame) -> DataFrame:
    """(key, counts: array of token and tf) of every row of (key, text) by itself: no shuffle."""
    tokens = docs.select("key", F.regexp_extract_all(F.lower(col("text")), F.lit(TOKEN), F.lit(0)).alias("tokens"))
    pair = T.StructType([T.StructField("token", T.StringType(), False), T.StructField("tf", T.LongType(), False)])
    schema = T.StructType([tokens.schema["key"], T.StructField("counts", T.ArrayType(pair, False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                part = batch.slice(start, TEXTS)
                flat = part.column(1).flatten()
                lengths = pc.fill_null(pc.list_value_length(part.column(1)), 0).to_numpy(zero_copy_only=False)
                codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(part.num_rows), lengths)
                _, first, n = np.unique(row * max(1, len(flat)) + codes, return_index=True, return_counts=True)
                ends = np.cumsum([0, *np.bincount(row[first], minlength=part.num_rows)])
                token = flat.take(pa.array(first)).cast(pa.string())
                counted = pa.StructArray.from_arrays([token, pa.array(n, pa.int64())], fields=[pa.field("token", pa.string(), False), pa.field("tf", pa.int64(), False)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), counted)
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["key", "counts"])

    return tokens.mapInArrow(run, schema)


def tfidf(df: DataFrame, key: str, text: str) -> DataFrame:
    """Sparse TF-IDF as (key, token, weight): smooth idf, l2-normalised per document.

    Tokens are runs of two or more word characters of the lower-cased text.
    """
    n_docs = df.count()
    named = df.select(col(key).alias("key"), col(text).alias("text"))
    # written once: the document frequencies and the weights both read it
    tf = written(_counts(spread_out(named))).selectExpr("key", "inline(counts)")
    if named.groupBy("key").count().where("count > 1").limit(1).collect():
        tf = written(tf.groupBy("key", "token").agg(F.sum("tf").alias("tf")))
    doc_freq = written(tf.groupBy(F.col("token").alias("__token")).agg(F.count(F.lit(1)).alias("__n")))
    doc_freq = doc_freq.withColumn("idf", F.log(F.lit(1.0 + n_docs) / (F.lit(1.0) + F.col("__n"))) + 1.0)
    # frequent tokens, most of the rows, are looked up in place
    weighted = lookup_join(tf, F.col("token"), doc_freq, "__token", "__n", share=FREQUENT, least=1).withColumn(
        "w", F.col("tf") * F.col("idf")
    )
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("key")))
    return weighted.select(F.col("key").alias(key), "token", (F.col("w") / norm).alias("tfidf"))


def text_length(df: DataFrame, columns: Sequence[str] | None = None) -> ColumnStep:
    """Add ``{col}_len``, the number of characters."""
    columns = list(columns) if columns is not None else columns_of(df, "string")
    return fitted(df, {f"{c}_len": f"length({quote(c)})" for c in columns})
