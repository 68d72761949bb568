"""Registered queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, fim, fingerprints, langid, lm, packing, pii, quality, sharding, simhash, toxicity, urlrules, whiten
from .batches import stored

SHARDS = 40


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    pairs = fingerprints.edited_pairs(_documents(spark, folder))
    return pairs.select(
        "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
        fingerprints.text_form(F.col("sketch")).alias("fingerprint"),
        fingerprints.text_form(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    marked = stored(simhash.fingerprints(_documents(spark, folder), ["doc_id"]))
    return simhash.groups(marked, "doc_id").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(_documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"])
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = bpe.encode(_documents(spark, folder), ranks, public_tokenizers.PATTERN, ["doc_id"])
    decoded = bpe.decode(coded, ranks, ["doc_id", "ids"])
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = quality.judge(_documents(spark, folder), labels, ["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


#: The rules that the query fixes: verdict, host, path (fixed values).
SITE_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op6_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = [urlrules.site_rule(*r) for r in SITE_RULES]
    rules += [urlrules.word_rule("block", w) for w in urlrules.BLOCKED_WORDS]
    return urlrules.judge(spark.read.parquet(f"{folder}/pages.parquet"), rules)


def _op6_sql() -> str:
    words = "|".join(urlrules.BLOCKED_WORDS)
    rules = ", ".join(f"('{v}', '{h}', '{p}', '{h}{p}')" for v, h, p in SITE_RULES)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
        WITH parts AS (
            SELECT page_id, row_number() OVER () AS n,
                   translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{upper}', '{lower}') AS host,
                   regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
            FROM pages),
        rules(verdict, h, p, name) AS (VALUES {rules}),
        fits AS (
            SELECT n, max_by(rules.name, length(rules.name)) AS rule, max_by(rules.verdict, length(rules.name)) AS verdict
            FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
            GROUP BY n)
        SELECT page_id, host, path, rule,
               coalesce(verdict, CASE WHEN regexp_matches(host || path, '^([^/]*[^a-z0-9/])?({words})([^a-z0-9]|$)')
                                      THEN 'block' ELSE 'allow' END) AS verdict
        FROM parts LEFT JOIN fits USING (n)"""


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.assign(_documents(spark, folder), [1.0] * SHARDS, [1.0] * (SHARDS + 1))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def _remainder(modulus: int) -> Column:
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % modulus


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    # held out: remainder 2; rows without an id teach nothing
    model = langid.train(stored(langid.sample(docs.where(_remainder(4) != 2))))
    marked = docs.select("doc_id", F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"), "text")
    return langid.predict(marked, model, ["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score")


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.spans(_documents(spark, folder), ["doc_id"], rewrite=False)
    name = F.array(*[F.lit(k) for k in pii.KINDS])
    each = F.arrays_zip("starts", "ends", "kinds")
    form = lambda s: F.concat_ws(":", F.get(name, s["kinds"]), s["starts"].cast("string"), s["ends"].cast("string"))
    base = F.filter(each, lambda s: s["kinds"] < 4)
    count = lambda k: F.size(F.filter("kinds", lambda x: x == k)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{pii.KINDS[k]}") for k in range(4)],
        F.sha2(F.concat_ws(",", F.transform(base, form)).cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform(each, form)).alias("spans"),
    )


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.train(stored(toxicity.sample(docs, labels.where(_remainder(5) != 0))))
    marked = docs.select("doc_id", F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"), "text")
    return toxicity.score(marked, model, ["doc_id", "held_out"]).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans"
    )


def op11_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    # held out: remainder 2; rows without an id teach nothing
    model = lm.train(docs.where(_remainder(7) != 2))
    marked = docs.select("doc_id", F.coalesce(_remainder(7) == 2, F.lit(False)).alias("held_out"), "text")
    return lm.score(marked, model, ["doc_id", "held_out"]).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score", "score", "perplexity",
    )


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    return whiten.apply(vectors, whiten.fit(vectors), ["vec_id"])


def op13_fim(spark: SparkSession, folder: str) -> DataFrame:
    made = fim.transform(_documents(spark, folder), ["doc_id"])
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    made = made.withColumn("output_sha256", sha("output"))
    back = fim.restore(made, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"])
    return back.withColumn("restored_sha256", sha("restored")).drop("restored")


QUERIES = {
    f.__name__: f
    for f in (
        op1_fingerprints, op2_simhash, op3_packing, op4_bpe, op5_quality,
        op6_url_rules, op7_sharding, op8_language, op9_pii, op10_toxicity,
        op11_lm, op12_whitening, op13_fim,
    )
}
ORACLES = {"op6_url_rules": _op6_sql()}
