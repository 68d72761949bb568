"""The training-data pipeline: toxicity, language, near-duplicates, personal data, packing.

Each stage takes the documents that its predecessor kept.  All but the last return the columns of
documents; rows are told apart by their place, never by a column, so repeated ids, nulls and clashing
names are carried through unchanged.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import copies, langid, packing, pii, toxicity
from millrace.llm.batches import looked_up, packed, shuffled, stored


def _documents(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def toxic_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose toxicity score is 0.5 or more; unlabelled or empty texts stay.

    The model learns from all of ``labels`` that belong to documents of this stage; an empty table or
    one without toxic documents drops nothing.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(stored(toxicity.sample(docs, labels)))
    return _documents(toxicity.score(packed(docs), model, ["row"]).where("score < 0.5"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that no language model accepts (null texts and those without letters too)."""
    model = langid.train(stored(langid.sample(docs)))
    return _documents(langid.predict(packed(docs), model, ["row"]).where("accepted"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles of Jaccard similarity 0.8 or more: the
    smallest doc_id, of equal ids any one.

    Pairs come from op2's SimHash links (at most 3 bits apart), all of them, and from common shingles, for near
    copies that the fingerprints miss; an exact check of the similarity follows.

    Texts are written once with their signature and row number; texts are read again only where a pair
    has to be verified.
    """
    marked = copies.marked(packed(docs), ["row"]).withColumn("at", F.monotonically_increasing_id())
    marked = stored(marked)
    roots = copies.roots(marked.select("sig", "size", "prefix", "parity", "fp", "at", F.col("row.text").alias("text")))
    rank = F.struct(F.col("row.doc_id").isNull().alias("n"), F.col("row.doc_id").alias("d"), F.col("at").alias("at"))
    least = marked.groupBy("sig").agg(F.min("at").alias("head"), F.min(rank).alias("rank"))
    least = least.join(looked_up(roots, roots.count()), F.col("head") == F.col("node"), "left").groupBy(F.coalesce("root", "head").alias("root"))
    first = least.agg(F.min("rank").alias("rank")).select(F.col("rank.at").alias("at"))
    dropped = marked.select("at").join(shuffled(first), "at", "left_anti")
    return _documents(copies.by_number(marked, dropped, "left_anti"))


def private_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their personal data generalised; ``n_chars`` follows the text."""
    done = pii.spans(packed(docs), ["row"])
    row = F.col("row").withField("text", F.col("sanitised"))
    if "n_chars" in docs.columns:
        same = F.col("row.text").eqNullSafe(F.col("sanitised"))
        length = F.char_length("sanitised").cast(docs.schema["n_chars"].dataType)
        row = row.withField("n_chars", F.when(same, F.col("row.n_chars")).otherwise(length))
    return _documents(done.select(row.alias("row")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids (32-bit little-endian numbers), sequence_id, offset of every piece."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"])


STAGES = [
    ("toxicity", toxic_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("personal_data", private_stage),
    ("packing", packing_stage),
]

#: Trained models and hashes that SQL lacks: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
