"""The pipeline's stages, each held against what its operator says of its input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import langid, toxicity
from millrace.llm.batches import stored

from test_copies import brute_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, data):
    """Input of every stage and the result of the last."""
    out = [spark.read.parquet(f"{data}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], data)))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_are_kept(steps):
    assert all(df.columns == COLUMNS for df in steps[:-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "personal_data", "packing"]


def test_rejected_documents_go(spark, data, steps):
    labels = spark.read.parquet(f"{data}/labels.parquet")
    model = toxicity.train(toxicity.sample(steps[0], labels))
    assert ids(steps[1]) == ids(toxicity.score(steps[0], model, ["doc_id"]).where("score < 0.5"))
    spoken = langid.predict(steps[1], langid.train(langid.sample(steps[1])), ["doc_id"])
    assert ids(steps[2]) == ids(spoken.where("accepted"))


def test_one_document_of_each_group_stays(steps):
    """Groups by brute-force Jaccard similarity of five-word shingles."""
    texts = {r.doc_id: r.text or "" for r in steps[2].collect()}
    assert len(texts) == steps[2].count()
    assert ids(steps[3]) == sorted(set(brute_groups(texts).values()))


def test_personal_data_is_gone_and_lengths_follow(steps):
    assert steps[4].count() == steps[3].count()
    assert steps[4].where(F.col("text").rlike("@mail[0-9]") | (F.col("n_chars") != F.char_length("text"))).count() == 0


def test_packing_holds_every_document(spark, data, steps):
    pieces = steps[5].collect()
    assert sorted({r.doc_id for r in pieces}) == ids(steps[4])
    assert all(len(np.frombuffer(bytes(r.ids), "<u4")) == r.length for r in pieces)
    run = corpus_pipeline.run(spark, data)
    assert run.columns == steps[5].columns and run.count() == len(pieces)


def test_odd_rows(spark, tmp_path):
    rows = [
        (1, "plain words of a text that is long enough", "en", "s", 41, 7), (1, "plain words of a text that is long enough", "en", "s", 41, 8),
        (2, None, None, None, None, 1), (3, "", "en", None, 0, 1), (None, "other words a@b.example.com in here", "en", "s", 35, 2),
        (5, "???", "en", "s", 3, 3),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score int")
    spark.createDataFrame([(1, 1, 0), (None, 0, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    names = docs.columns
    for table in (docs, docs.limit(0)):
        df = table
        for name, stage in corpus_pipeline.STAGES:
            df = stored(stage(spark, df, str(tmp_path)))
            assert name == "packing" or df.columns == names
        # null, empty and letterless texts have no language; the repeated row is one document
        assert sorted((r.doc_id or 0) for r in df.collect()) == ([0, 1] if table is docs else [])
