"""Column kinds and type conversion."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    col,
    columns_of,
    dtype_of,
    is_float,
    lit_sql,
    local_rows,
    num_sql,
    quote,
    storage_kind,
)
from ..functions.steps import ColumnStep, fitted
from .lookup import lookup_join
from .ordered import ranked_values

# Spellings accepted as booleans.
TRUE_WORDS = ["true", "yes", "1"]
FALSE_WORDS = ["false", "no", "0"]


def distinct_counts(df: DataFrame, columns: Sequence[str], exact_upto: int = 1000) -> dict[str, int]:
    """Distinct non-null values per column, exact up to ``exact_upto`` and estimated beyond.

    The sketch settles which columns are far from any cardinality rule, so that the exact count
    (one expanded row per column) runs only for the few that are close.
    """
    columns = list(columns)
    if not columns:
        return {}
    rough = df.agg(*[F.approx_count_distinct(col(c), 0.03).alias(f"c{i}") for i, c in enumerate(columns)]).collect()[0]
    found = {c: rough[i] for i, c in enumerate(columns)}
    close = [c for c in columns if found[c] <= exact_upto]
    if close:
        exact = df.agg(*[F.count_distinct(col(c)).alias(f"c{i}") for i, c in enumerate(close)]).collect()[0]
        found.update({c: exact[i] for i, c in enumerate(close)})
    return found


def column_kinds(df: DataFrame, categories_below: int = 10) -> dict[str, str]:
    """numeric, boolean, datetime, categorical (fewer than ten distinct values) or text."""
    kinds = {f.name: storage_kind(f.dataType) for f in df.schema.fields}
    strings = [c for c, k in kinds.items() if k in ("string", "other")]
    counts = distinct_counts(df, strings, max(1000, 2 * categories_below))
    for c in strings:
        kinds[c] = "categorical" if counts[c] < categories_below else "text"
    return kinds


def column_kind_table(df: DataFrame, categories_below: int = 10) -> DataFrame:
    return local_rows(df.sparkSession, list(column_kinds(df, categories_below).items()), "column string, kind string")


def group_candidates(df: DataFrame, max_unique_values: int = 20) -> list[str]:
    """Non-numeric columns with few enough values to group by."""
    names = columns_of(df, "string", "boolean", "datetime")
    counts = distinct_counts(df, names, max(1000, 2 * max_unique_values))
    return [c for c in names if counts[c] <= max_unique_values]


def select_kind(df: DataFrame, *kinds: str, keep: Sequence[str] = ()) -> DataFrame:
    wanted = set(columns_of(df, *(kinds or ("numeric",)))) | set(keep)
    return df.select(*[col(c) for c in df.columns if c in wanted])


def _parsed(name: str) -> str:
    # a trailing type suffix such as '1.5d' is a number to the JVM but not to the data
    q = quote(name)
    return f"CASE WHEN {q} RLIKE '[0-9.][dDfF][ ]*$' THEN NULL ELSE try_cast({q} AS DOUBLE) END"


def to_numeric(df: DataFrame, columns: Sequence[str] | None = None, errors: str = "coerce") -> ColumnStep:
    """Strings to numbers.

    ``coerce`` nulls what does not parse, ``ignore`` leaves a column alone if any value fails and
    ``raise`` fails the job on the first bad value.
    """
    columns = list(columns) if columns is not None else columns_of(df, "string")
    if errors == "raise":
        return fitted(df, {c: f"CAST({quote(c)} AS DOUBLE)" for c in columns})
    if errors == "ignore" and columns:
        fails = df.agg(
            *[
                F.expr(f"count_if({quote(c)} IS NOT NULL AND ({_parsed(c)}) IS NULL)").alias(f"c{i}")
                for i, c in enumerate(columns)
            ]
        ).collect()[0]
        columns = [c for i, c in enumerate(columns) if fails[i] == 0]
    elif errors not in ("coerce", "ignore"):
        raise ValueError("errors must be coerce, ignore or raise")
    return fitted(df, {c: _parsed(c) for c in columns})


def parse_boolean(df: DataFrame, columns: Sequence[str] | None = None) -> ColumnStep:
    """Columns made only of boolean words, or only of 0 and 1, become boolean; nulls stay null."""
    columns = list(columns) if columns is not None else columns_of(df, "string", "numeric")
    words = ", ".join(lit_sql(w) for w in TRUE_WORDS + FALSE_WORDS)
    yes = ", ".join(lit_sql(w) for w in TRUE_WORDS)
    tests, forms = [], {}
    for i, c in enumerate(columns):
        if storage_kind(dtype_of(df, c)) == "string":
            clean = f"lower(trim({quote(c)}))"
            tests.append(F.expr(f"bool_and({clean} IN ({words}))").alias(f"c{i}"))
            forms[c] = f"{clean} IN ({yes})"
        else:
            tests.append(F.expr(f"bool_and({num_sql(df, c)} IN (0D, 1D))").alias(f"c{i}"))
            forms[c] = f"{num_sql(df, c)} = 1D"
    if not columns:
        return fitted(df, {})
    row = df.agg(*tests).collect()[0]
    return fitted(df, {c: forms[c] for i, c in enumerate(columns) if row[i]})


def category_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each column by the rank of its value in sorted order, missing as -1."""
    for c in columns:
        values, small = ranked_values(df, c)
        values = values.select(F.col("value").alias("__v"), F.col("rank").alias("__code"), F.col("n").alias("__n"))
        joined = lookup_join(df, col(c), values, "__v", "__n", small)
        df = joined.select(
            *[
                F.coalesce(F.col("__code"), F.lit(-1)).cast("bigint").alias(c) if n == c else col(n)
                for n in df.columns
            ]
        )
    return df


def date_to_epoch(df: DataFrame, columns: Sequence[str] | None = None, unit: str = "s") -> ColumnStep:
    """Date or timestamp to a count of seconds (or ns) since 1970."""
    columns = list(columns) if columns is not None else columns_of(df, "datetime")
    exprs = {}
    for c in columns:
        micros = f"unix_micros(CAST({quote(c)} AS TIMESTAMP))"
        exprs[c] = f"{micros} * 1000L" if unit == "ns" else f"{micros} DIV 1000000L"
    return fitted(df, exprs)


def bool_to_int(df: DataFrame, columns: Sequence[str] | None = None) -> ColumnStep:
    columns = list(columns) if columns is not None else columns_of(df, "boolean")
    return fitted(df, {c: f"CAST({quote(c)} AS INT)" for c in columns})


def numeric_to_double(df: DataFrame, columns: Sequence[str] | None = None) -> ColumnStep:
    columns = list(columns) if columns is not None else columns_of(df, "numeric")
    return fitted(df, {c: num_sql(df, c) for c in columns})


def strip_strings(df: DataFrame, columns: Sequence[str] | None = None) -> ColumnStep:
    columns = list(columns) if columns is not None else columns_of(df, "string")
    return fitted(df, {c: f"regexp_replace({quote(c)}, '^\\\\s+|\\\\s+$', '')" for c in columns})


def lower_strings(df: DataFrame, columns: Sequence[str] | None = None) -> ColumnStep:
    columns = list(columns) if columns is not None else columns_of(df, "string")
    return fitted(df, {c: f"lower(regexp_replace({quote(c)}, '^\\\\s+|\\\\s+$', ''))" for c in columns})


def replace_inf(df: DataFrame, columns: Sequence[str] | None = None) -> ColumnStep:
    """Positive and negative infinity to null."""
    columns = [c for c in (columns or df.columns) if is_float(dtype_of(df, c))]
    return fitted(
        df, {c: f"CASE WHEN abs({quote(c)}) = CAST('Infinity' AS DOUBLE) THEN NULL ELSE {quote(c)} END" for c in columns}
    )


def float_features(train: DataFrame, test: DataFrame, target: str, text_above: int = 20) -> ColumnStep:
    """One projection that makes every feature a double, alike for train and test.

    Categories are the union of both sides' values, text columns go, dates become seconds.
    """
    from .encode import distinct_values

    both = train.unionByName(test)
    exprs: dict[str, str] = {}
    drop: list[str] = []
    strings = [c for c in columns_of(train, "string") if c != target]
    counts = distinct_counts(both, strings)
    levels = distinct_values(both, [c for c in strings if counts[c] <= text_above])
    for f in train.schema.fields:
        c = f.name
        if c == target:
            continue
        kind = storage_kind(f.dataType)
        if kind in ("numeric", "boolean"):
            exprs[c] = num_sql(train, c)
        elif kind == "datetime":
            exprs[c] = f"CAST(unix_micros(CAST({quote(c)} AS TIMESTAMP)) AS DOUBLE) / 1000000D"
        else:
            drop.append(c)
            for v in levels.get(c, []):
                exprs[f"{c}_{v}"] = f"CAST(coalesce({quote(c)} = {lit_sql(v)}, false) AS DOUBLE)"
    return fitted(train, exprs, drop=drop)
