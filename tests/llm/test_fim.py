"""Fill-in-the-middle against cutting and joining the texts one by one."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import fim
from millrace.llm.queries import QUERIES

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(key, text):
    text, key = text or "", "" if key is None else key
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"42:{key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(tokens) + 1) for x in h[:2])
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(tokens), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(tokens), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(tokens), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    draw = random.Random(3)
    letters = list("ab <PSM>\n\t\x0b\x1cé漢🙂\x00")
    rows = [(i, "".join(draw.choices(letters, k=draw.randint(0, 40))), "x", 1) for i in range(1500)]
    rows += [(None, "no key here", "x", 2), (7, None, None, None), (8, "", "", 3), (8, "  \n ", "x", 4), (8, "  \n ", "x", 4)]
    rows += [(9000 + i, "a" * 300_000 + " 漢字 " * 200_000, "long", i) for i in range(4)]
    # names of the result and of the inside
    return spark.createDataFrame(rows, "doc_id bigint, text string, form string, n int")


def test_outputs_and_restored_texts(odd):
    kept = odd.withColumnsRenamed({"form": "__kind", "n": "h"})
    made = fim.transform(kept, ["doc_id", "text", "__kind", "h"])
    back = fim.restore(made.drop("__kind"), ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"])
    rows = back.collect()
    assert len(rows) == odd.count()
    forms = set()
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == expected(r.doc_id, r.text)
        assert r.restored == (r.text or "")
        forms.add(r.form)
    assert forms == {"plain", "psm", "spm"}


def test_query(spark, data):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op13_fim"](spark, data).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, form, prefix, middle, output = expected(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert (r.output_sha256, r.restored_sha256) == (sha(output), sha(docs[r.doc_id] or ""))


def test_query_with_odd_rows(spark, odd, tmp_path):
    for name, table in (("all", odd), ("none", odd.limit(0))):
        table.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        rows = QUERIES["op13_fim"](spark, f"{tmp_path}/{name}").collect()
        assert len(rows) == table.count()
        assert all(r.restored_sha256 == r.output_sha256 for r in rows if r.form == "plain")


def test_damaged_outputs_are_null(spark):
    rows = [("a<P>b<S>c<M>d", "psm"), ("<S>c<P>b", "spm"), ("<P>b<S>c<M>d", "spm"), ("", "psm"), ("<P><S><M>", "psm"), ("x", None), (None, "plain")]
    got = fim.restore(spark.createDataFrame(rows, "output string, form string"), ["output", "form"])
    assert [r.restored for r in got.collect()] == [None, None, None, None, "", "x", ""]


def test_draws_need_no_row(spark):
    one = spark.range(3).select("id", *[d.alias(f"h{i}") for i, d in enumerate(fim.draws(F.col("id")))]).collect()
    for r in one:
        digest = hashlib.sha256(f"42:{r.id}".encode()).hexdigest()
        assert [r.h0, r.h1, r.h2, r.h3] == [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
