"""Derived inputs of the registered queries, stated once for Spark and once in SQL.

The tables themselves hold no nulls and little correlation, so nulls, dirty strings and predictions
are made by expressions over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ev_nulls(t) -> DataFrame:
    return t.events.selectExpr(
        "event_id",
        "user_id",
        "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value",
        "CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type",
        "CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id % 50 END AS score",
    )


EV_NULLS = """(SELECT event_id, user_id,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id % 50 END AS score FROM events)"""


def ev_sparse(t) -> DataFrame:
    return t.events.selectExpr(
        "event_id",
        "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value",
        "CASE WHEN event_id % 10 < 6 THEN NULL ELSE value END AS sparse",
        "'same' AS fixed",
        "CASE WHEN event_id % 3 = 0 THEN NULL ELSE 1 END AS nearly_fixed",
        "CAST(NULL AS DOUBLE) AS empty",
    )


EV_SPARSE = """(SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
  CASE WHEN event_id % 10 < 6 THEN NULL ELSE value END AS sparse, 'same' AS fixed,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE 1 END AS nearly_fixed,
  CAST(NULL AS DOUBLE) AS empty FROM events)"""


def ev_strings(t) -> DataFrame:
    return t.events.selectExpr(
        "event_id",
        "concat('  ', upper(event_type), ' ') AS padded",
        "CASE event_id % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' ELSE 'TRUE' END AS flag_text",
        "CASE WHEN event_id % 5 = 0 THEN 'x' ELSE CAST(value AS STRING) END AS mixed_text",
        "CAST(value AS STRING) AS value_text",
        "CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(event_id % 2 AS DOUBLE) END AS flag_number",
    )


EV_STRINGS = """(SELECT event_id, concat('  ', upper(event_type), ' ') AS padded,
  CASE event_id % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' ELSE 'TRUE' END AS flag_text,
  CASE WHEN event_id % 5 = 0 THEN 'x' ELSE CAST(value AS VARCHAR) END AS mixed_text,
  CAST(value AS VARCHAR) AS value_text,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(event_id % 2 AS DOUBLE) END AS flag_number FROM events)"""


def li_charge(t) -> DataFrame:
    return t.lineitem.selectExpr(
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge",
    )


LI_CHARGE = """(SELECT l_quantity, l_extendedprice, l_discount, l_tax,
  l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem)"""


def pred_orders(t) -> DataFrame:
    return t.orders.selectExpr(
        "o_orderkey",
        "o_totalprice AS y_true",
        "0.8D * o_totalprice + 50000 + (o_orderkey % 1000) * 20 - 10000 AS y_pred",
        "CAST(o_custkey AS DOUBLE) AS x1",
    )


PRED_ORDERS = """(SELECT o_orderkey, o_totalprice AS y_true,
  0.8::DOUBLE * o_totalprice + 50000 + (o_orderkey % 1000) * 20 - 10000 AS y_pred,
  CAST(o_custkey AS DOUBLE) AS x1 FROM orders)"""


def pred_orders_spreading(t) -> DataFrame:
    return t.orders.selectExpr(
        "o_orderkey",
        "o_totalprice AS y_true",
        "o_totalprice * (0.5D + (o_orderkey % 1000) / 1000.0D) AS y_pred",
    )


PRED_ORDERS_SPREADING = """(SELECT o_orderkey, o_totalprice AS y_true,
  o_totalprice * (0.5::DOUBLE + (o_orderkey % 1000)::DOUBLE / 1000.0::DOUBLE) AS y_pred FROM orders)"""


def score_docs(t) -> DataFrame:
    scored = t.labels.join(t.documents, "doc_id").select(
        "doc_id",
        F.col("quality").alias("label"),
        "lang",
        "source",
        F.round(
            F.length(F.regexp_replace("text", "[^A-Za-z]", "")) / F.greatest(F.length("text"), F.lit(1)), 4
        ).alias("score"),
    )
    return scored.withColumn("pred", (F.col("score") > 0.9).cast("int"))


SCORE_DOCS = """(SELECT *, CASE WHEN score > 0.9 THEN 1 ELSE 0 END AS pred FROM (
  SELECT doc_id, quality AS label, lang, source,
    round(length(regexp_replace(text, '[^A-Za-z]', '', 'g'))::DOUBLE / greatest(length(text), 1), 4) AS score
  FROM labels JOIN documents USING (doc_id)))"""


def two_groups(t) -> DataFrame:
    return t.orders.selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS grp",
        "o_totalprice + CASE WHEN o_orderkey % 2 = 0 THEN 1000 ELSE 0 END AS price",
    )


TWO_GROUPS = """(SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS grp,
  o_totalprice + CASE WHEN o_orderkey % 2 = 0 THEN 1000 ELSE 0 END AS price FROM orders)"""


def price_pairs(t) -> DataFrame:
    """First and last order price of each customer."""
    return t.orders.groupBy("o_custkey").agg(
        F.min_by("o_totalprice", "o_orderkey").alias("first_price"),
        F.max_by("o_totalprice", "o_orderkey").alias("last_price"),
    )


PRICE_PAIRS = """(SELECT o_custkey, arg_min(o_totalprice, o_orderkey) AS first_price,
  arg_max(o_totalprice, o_orderkey) AS last_price FROM orders GROUP BY o_custkey)"""


def vectors(t, width: int = 64) -> DataFrame:
    """Embeddings as numeric columns e0..e{width-1} with label and key."""
    return t.embeddings.select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(width)]
    )
