"""What the language models learn from: distinct texts of any length, rare n-grams of small samples."""

import numpy as np

from millrace.llm import langid

SCHEMA = "doc_id bigint, lang string, text string"


def test_copies_take_no_place_of_other_texts(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE", 50)
    rows = [(i, "en", "one text copied over and over") for i in range(5000)] + [(i, "en", f"other text {i}") for i in range(60)]
    assert langid.sample(spark.createDataFrame(rows, SCHEMA)).count() >= 45
    many = [(i, "en", f"text {i}") for i in range(10_000)]
    assert 110 <= langid.sample(spark.createDataFrame(many, SCHEMA)).count() <= 190  # 50 and the root of 10,000


def test_long_texts_teach(spark):
    rows = [(1, "en", "the cat sat on the mat"), (2, "xx", "zoquu vexxi " * 10_000)]
    assert {r.lang for r in langid.sample(spark.createDataFrame(rows, SCHEMA)).collect()} == {"en", "xx"}


def test_samples_of_any_size_keep_single_grams(spark, monkeypatch):
    rows = spark.createDataFrame([("en", "the cat sat on the mat"), ("fr", "le chat dort")], "lang string, text string")
    small = langid.train(rows)
    assert set(langid._hashes_of(["chat", "dort", "\x02cat"]).tolist()) <= set(small.grams.tolist())
    monkeypatch.setattr(langid, "SAMPLE", 1)  # more texts than the bound
    assert langid.train(rows).grams.tolist() == small.grams.tolist()
    assert np.isfinite(small.found).all()
