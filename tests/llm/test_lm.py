"""The n-gram model against its definition, counted with dictionaries."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import bytewise, lm
from millrace.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(lowered), "</s>\n"]


class Plain:
    """Modified Kneser-Ney by its definition."""

    def __init__(self, texts, order):
        self.order, top = order, Counter()
        for t in texts:
            words = ["<s>\n"] * (order - 1) + tokens(t)
            top.update(tuple(words[i - order + 1 : i + 1]) for i in range(order - 1, len(words)))
        self.levels = {order: top}
        for k in range(order, 1, -1):
            self.levels[k - 1] = Counter(g[1:] for g in self.levels[k])
        self.discounts, self.contexts = {}, {}
        for k, counts in self.levels.items():
            t = [sum(c == i for c in counts.values()) for i in (1, 2, 3, 4)]
            self.discounts[k] = (0.5, 1.0, 1.5)
            if min(t):
                y = t[0] / (t[0] + 2 * t[1])
                d = tuple(i - (i + 1) * y * t[i] / t[i - 1] for i in (1, 2, 3))
                if all(0 <= x <= i for i, x in enumerate(d, 1)):
                    self.discounts[k] = d
            self.contexts[k] = defaultdict(lambda: [0, 0, 0, 0])
            for g, c in counts.items():
                self.contexts[k][g[:-1]][0] += c
                self.contexts[k][g[:-1]][min(c, 3)] += 1

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / (len(self.levels[1]) + 1)
        lower = self.p(gram[1:])
        if gram[:-1] not in self.contexts[k]:
            return lower
        total, *kinds = self.contexts[k][gram[:-1]]
        d, c = self.discounts[k], self.levels[k].get(gram, 0)
        own = max(c - d[min(c, 3) - 1], 0) if c else 0
        return (own + sum(a * b for a, b in zip(d, kinds)) * lower) / total

    def score(self, text):
        words = ["<s>\n"] * (self.order - 1) + tokens(text)
        return sum(math.log10(self.p(tuple(words[i - self.order + 1 : i + 1]))) for i in range(self.order - 1, len(words)))


def test_query(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in docs}
    taught = [r.text for r in docs if not held[r.doc_id]]
    counts = Counter(w for t in taught for w in tokens(t))
    n, v, plain = sum(counts.values()), len(counts), Plain(taught, lm.ORDER)
    rows = {r.doc_id: r for r in QUERIES["op11_lm"](spark, data).collect()}
    assert len(rows) == len(docs) and {r.train_tokens for r in rows.values()} == {n}
    for d in docs:
        r, words = rows[d.doc_id], tokens(d.text)
        assert (r.held_out, r.n_tokens, r.n_known) == (held[d.doc_id], len(words), sum(w in counts for w in words))
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), rel=1e-12)
        assert r.score == pytest.approx(plain.score(d.text), rel=1e-10)
        assert r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens))
    # it predicts texts that it has not seen better than single words do
    unseen = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_orders_add_up_to_one(spark, monkeypatch, order):
    monkeypatch.setattr(lm, "PENDING", 50)
    texts = ["a b a b c", "A b c d", "a a a a b b b", "", None, "c d e a b", "a b a b c", "x  y\tz", "é b 漢 a b c d"]
    table = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    model, plain = lm.train(table, order=order), Plain(texts, order)
    asked = [*texts, "a b unknown b c", "unknown unknown", "d c b a"]
    rows = lm.score(spark.createDataFrame([(t,) for t in asked], "text string"), model, ["text"]).collect()
    assert [r.score for r in rows] == pytest.approx([plain.score(r.text) for r in rows], rel=1e-12)
    words = [g[0] for g in plain.levels[1]] + ["unknown"]
    for context in (("a", "b", "a"), ("unknown", "b", "c"), ("<s>\n", "<s>\n", "<s>\n"))[:]:
        after = context[len(context) - order + 1 :] if order > 1 else ()
        assert sum(plain.p((*after, w)) for w in words) == pytest.approx(1)


def test_odd_rows(spark, tmp_path):
    rows = [(1, "Some words words", "x", 1.5), (1, "Some words words", "x", 1.5), (2, None, None, None), (None, "some other", "x", 0.0), (3, "", "", 0.0)]
    rows += [(4, "w " * 700_000 + "x" * 100_000, "long", 0.0), (5, "\x1c \x00 words", "odd", 1.0)]
    names = "doc_id bigint, text string, n_tokens string, score double"
    for name, given in (("all", rows), ("none", [])):
        spark.createDataFrame(given, names).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = QUERIES["op11_lm"](spark, f"{tmp_path}/{name}").collect()
        assert len(got) == len(given)
        assert all(math.isfinite(r.score) and r.score <= 0 and r.base_score <= 0 for r in got)
        if given:
            by = {r.doc_id: r for r in got}
            assert by[2].n_tokens == by[3].n_tokens == 1 and by[4].n_tokens == 700_002
            assert not by[None].held_out and by[None].n_known < 3  # an unknown id teaches nothing


def test_nothing_to_learn(spark):
    none = spark.createDataFrame([], "text string")
    got = lm.score(spark.createDataFrame([("a b",)], "text string"), lm.train(none), []).collect()[0]
    assert (got.n_tokens, got.n_known, got.base_score, got.score, got.perplexity) == (3, 0, 0.0, 0.0, 1.0)


def test_words_and_hashes(monkeypatch):
    texts = ["The the THE cat", None, "", " é\x0bÉ \x1c", "abc", "cab bca", "x" * 5000 + " y"]
    body, ends = bytewise.laid_bytes(pa.array(["skipped", *texts]).slice(1))
    hashes, places = bytewise.word_hashes(body, ends)
    words = [tokens(t)[:-1] for t in texts]
    assert np.diff(places).tolist() == list(map(len, words))
    flat = sum(words, [])
    assert len(set(flat)) == len(set(hashes.tolist())) == len(set(zip(flat, hashes.tolist())))
    monkeypatch.setattr(bytewise, "SECTION", 3)
    again = bytewise.word_hashes(body, ends)
    assert np.array_equal(again[0], hashes) and np.array_equal(again[1], places)
