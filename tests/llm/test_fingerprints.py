"""Sketches and edited pairs against a plain restatement in Python."""

import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import fingerprints as fp
from millrace.llm import queries

DOCS = "doc_id bigint, text string"


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def word_hash(w):
    return xxhash.xxh64_intdigest(w.encode(), 42)


def chained(hashes):
    """What xxhash64 gives for several bigint columns: each one's digest seeds the next."""
    seed = 42
    for h in hashes:
        seed = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), seed)
    return signed(seed)


def all_shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    hashes = [word_hash(w) for w in words]
    if not words:
        return set()
    return {chained(hashes[i : i + 5]) for i in range(max(1, len(hashes) - 4))}


def plain_sketch(text):
    return sorted(all_shingles(text))[: fp.K]


TEXTS = ["", None, "one", "a b c d", " a  b\tc\nd e ", "a b c d e", "a b c d e f g " * 3, " ".join(f"w{i * i % 701}" for i in range(900))]


def test_sketch_is_the_smallest_hashes(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), DOCS)
    got = {r.doc_id: r.s for r in df.select("doc_id", fp.sketch(F.col("text")).alias("s")).collect()}
    assert got == {i: plain_sketch(t) for i, t in enumerate(TEXTS)}


def test_estimates(spark):
    a = " ".join(f"w{i}" for i in range(4000))
    b = " ".join(f"w{i}" for i in range(1000, 5000))
    df = spark.createDataFrame([(a, b, "", None, "x y")], "a string, b string, c string, d string, e string")
    s = {c: fp.sketch(F.col(c)) for c in "abcde"}
    row = df.select(
        fp.resemblance(s["a"], s["b"]).alias("near"), fp.containment(s["a"], s["b"]).alias("held"),
        fp.distinct_shingles(s["a"]).alias("n"), fp.resemblance(s["c"], s["d"]).alias("empty"),
        fp.resemblance(s["c"], s["e"]).alias("other"), fp.resemblance(s["a"], s["a"]).alias("same"),
        fp.distinct_shingles(s["e"]).alias("few"), fp.containment(s["c"], s["a"]).alias("none"),
        (fp.merge(s["a"], s["b"]) == fp.sketch(F.concat_ws(" ", "a", "b"))).alias("joined"),
    ).first()
    assert row.near == pytest.approx(2996 / 4996, abs=0.15) and row.held == pytest.approx(0.75, abs=0.2)
    assert row.n == pytest.approx(3996, rel=0.3)
    assert (row.empty, row.other, row.same, row.few, row.none) == (1.0, 0.0, 1.0, 1.0, 1.0)


def test_merging_all_parts(spark):
    parts = [("g", " ".join(f"w{i}" for i in range(k, k + 60))) for k in range(0, 600, 20)] + [("h", "a b c")]
    df = spark.createDataFrame(parts, "g string, text string").select("g", fp.sketch(F.col("text")).alias("sketch"))
    got = {r.g: r.sketch for r in fp.merge_all(df, ["g"]).collect()}
    want = sorted(set().union(*(all_shingles(t) for g, t in parts if g == "g")))[: fp.K]
    assert got == {"g": want, "h": plain_sketch("a b c")}


def plain_pairs(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (key, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b = all_shingles(text), all_shingles(edited)
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), len(a & b) / len(a | b) if a | b else 1.0))
    return sorted(out, key=str)


@pytest.mark.parametrize("spread", [1, 700, -5000])
def test_edited_pairs_across_blocks(spark, spread):
    texts = [f"word{i} é{i} tail of text number {i} and more" * (i % 4) for i in range(40)] + [None, ""]
    rows = [(i * spread, t) for i, t in enumerate(texts)] + [(3 * spread, "again under one key"), (None, "no key")]
    df = spark.createDataFrame(rows, DOCS)
    near = fp.resemblance(F.col("sketch"), F.col("edited_sketch"))
    got = fp.edited_pairs(df).select("doc_id", F.char_length("text"), F.sha2(F.encode("edited", "utf-8"), 256), near).collect()
    assert sorted(map(tuple, got), key=str) == plain_pairs(rows)


def test_block_numbers_are_ordered_in_groups(spark, monkeypatch):
    monkeypatch.setattr(fp, "ONE_TASK", 3)
    monkeypatch.setattr(fp, "BLOCK", 4)
    keys = [-70, -3, 0, 1, 2, 3, 4, 9, 40, 41, 300]
    got = fp._next_above(spark.createDataFrame([(k,) for k in keys], "key bigint")).collect()
    assert {r.key: r.above for r in got} == dict(zip(keys, [*keys[1:], None]))


def test_odd_tables(spark):
    wide = spark.createDataFrame([(1, "a b", "x", 5)], "doc_id bigint, text string, sketch string, b int")
    assert fp.edited_pairs(wide).count() == 1
    assert fp.edited_pairs(wide.limit(0)).count() == 0


def test_query_on_the_whole_table(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op1_fingerprints(spark, data).collect()
    want = plain_pairs(rows)
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=str) == [w[:3] for w in want]
    errors = [abs(r.near_edited - w[3]) for r, w in zip(sorted(got, key=lambda r: str((r.doc_id, r.n_chars, r.edited_sha256))), want)]
    assert sum(errors) / len(errors) < 0.03 and max(errors) < 0.25
