"""Quality, language and toxicity models against plain restatements and held-out accuracy."""

import itertools
import re
from collections import Counter
from math import exp, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid, quality, queries, toxicity
from millrace.llm.tokens import gram_hashes, laid_out

TEXTS = [
    None, "", " \n\t ", "one", "a b c a b c", "x\nx\n\nx\n y\ny", "é ü # * |", "word " * 60, "a b c\x1cd", "#" * 3000,
    "\n".join(["same line here"] * 30), " ".join(f"w{i % 37}" for i in range(200)), "long " + "z" * 50_000,
]


def table(spark, texts=TEXTS):
    rows = [(i, t, "x", True) for i, t in enumerate(texts)] + [(0, "again one id", "x", True), (None, "no id", "x", False)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, score string, kept boolean")


# ---- quality ----------------------------------------------------------------------------------------


def plain_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    repeat = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dups = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(words) < 50 or 100 * len(repeat) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dups, len(repeat), failed


def plain_buckets(text):
    out = []
    for w in (text or "").encode().split():
        padded = b" " + w + b" "
        for n in quality.ORDERS:
            for i in range(len(padded) - n + 1):
                codes, _ = laid_out([padded[i : i + n]], np.uint8)
                out.append(int(gram_hashes(codes, n)[n - 1][-1] % np.uint64(quality.BUCKETS)))
    return out


@pytest.mark.parametrize("many", [quality.MANY, 1])
def test_base_figures(spark, monkeypatch, many):
    monkeypatch.setattr(quality, "MANY", many)
    got = quality.scored(table(spark), np.zeros(quality.BUCKETS, np.float32), ["doc_id", "text"]).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        assert tuple(r)[2:8] == plain_base(r.text)


def test_counts_and_scores(spark):
    docs = [(1, "good words here"), (2, "bad*** words|||"), (3, None), (4, "good good more"), (1, "twice one id")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, 1), (9, 1), (None, 1)], "doc_id bigint, quality int")
    sample = quality.labelled_sample(df, labels)
    got = {r.bucket: (r.raw, r.target) for r in quality.counted(df, sample).collect()}
    raw, target = Counter(), Counter()
    for key, text in docs:
        raw.update(plain_buckets(text))
        target.update(plain_buckets(text) if key in (1, 4) else [])
    assert got == {b: (n, target[b]) for b, n in raw.items()}
    ratio = quality.ratios(quality.counted(df, sample))
    share = lambda c, b: (c[b] + 0.5) / (sum(c.values()) + 0.5 * quality.BUCKETS)
    for r in quality.scored(df, ratio, ["text"]).collect():
        b = plain_buckets(r.text)
        want = sum(log(share(target, x)) - log(share(raw, x)) for x in b) / max(len(b), 1)
        assert r.score == pytest.approx(want, abs=1e-5)


def test_sample_leaves_out_labels_of_absent_documents(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "good"), (2, "bad"), (3, None), (1, "again")], "doc_id bigint, text string")
    absent = spark.range(10, 1000).selectExpr("id AS doc_id", "1 AS quality", "1 AS toxic")
    known = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (3, 1, 1)], "doc_id bigint, quality int, toxic int")
    labels = known.union(absent)
    assert {tuple(r) for r in quality.labelled_sample(docs, labels, limit=4).collect()} == {(1, 1), (2, 0)}
    monkeypatch.setattr(toxicity, "SAMPLE", 2)
    assert {tuple(r) for r in toxicity.sample(docs, labels).collect()} == {(1, "good"), (0, "bad")}


@pytest.mark.parametrize("module, result", [(quality, "kept"), (toxicity, "score")])
def test_columns_named_like_labels_change_nothing(spark, data, module, result):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    more = docs.selectExpr("*", "1 AS label", "2 AS label_id", "3 AS toxic", "4 AS quality", "5 AS key", "6 AS score", "7 AS kept")

    def made(df):
        if module is quality:
            return {(r.doc_id, r.kept) for r in quality.judge(df, labels, ["doc_id"]).collect()}
        return {(r.doc_id, r.score) for r in toxicity.score(df, toxicity.train(toxicity.sample(df, labels)), ["doc_id"]).collect()}

    assert made(docs) == made(more)


def test_many_distinct_words_repeat_nothing():
    n = quality.MANY + 70_000
    numbers = np.concatenate([np.arange(n), [5, 6, 7, 8]])
    assert quality._repeated(np.arange(n), n) == 0
    assert quality._repeated(numbers, n) == 8


def test_threshold_separates(spark):
    make = lambda rows: quality.threshold(spark.createDataFrame(rows, "label int, score double"))
    assert -3 < make([(1, 0.1), (1, 0.2), (0, -3.0), (0, -4.0)]) < 0.1
    assert make([(1, 0.1)]) == float("-inf")
    assert make([(0, 1.0), (0, 2.0), *[(1, 0.0)] * 9]) <= 0.0


def test_every_labelled_document_teaches(spark):
    rows, word = 24_000, "concat('w', id % 7)"
    docs = spark.range(rows).selectExpr("id AS doc_id", f"concat({word}, ' tail') AS text")
    labels = spark.range(rows).selectExpr("id AS doc_id", "if(id % 3 = 0, 0, 1) AS quality")
    sample = quality.labelled_sample(docs, labels)
    assert sample.count() == rows and sample.where("label = 1").count() == rows * 2 // 3
    counts = quality.counted(docs, sample).collect()
    assert sum(r.target for r in counts) * 3 == sum(r.raw for r in counts) * 2


def test_threshold_of_any_number_of_scores(spark, monkeypatch):
    from millrace.operators import ordered

    draw = np.random.default_rng(5)
    rows = [(int(y), round(float(draw.normal(2 * y)), 2)) for y in draw.integers(0, 2, 3000)]
    label, score = np.array(rows).T
    points = np.unique(score)
    kept = np.array([(score[label == 1] >= x).mean() for x in points])
    value = np.where(kept >= quality.KEEP_GOOD, kept + [(score[label == 0] < x).mean() for x in points], -1)
    best = int(value.argmax())
    judged = spark.createDataFrame(rows, "label int, score double")
    for few in (100_000, 10):
        monkeypatch.setattr(ordered, "SMALL_VALUES", few)
        assert quality.threshold(judged) == pytest.approx((points[best - 1] + points[best]) / 2)


def test_quality_odd_tables(spark):
    labels = spark.createDataFrame([(11, 1), (0, 0)], "doc_id bigint, quality int")
    more = [*TEXTS, " ".join(f"good{i}" for i in range(60)), " ".join(f"@@{i}|" for i in range(60))]
    both = spark.createDataFrame([(len(TEXTS), 1), (len(TEXTS) + 1, 0)], "doc_id bigint, quality int")
    judged = {(r.doc_id, r.n_words): r.kept for r in quality.judge(table(spark, more), both, ["doc_id"]).collect()}
    assert judged.pop((len(TEXTS), 60)) and not any(judged.values())  # the others are too short, repetitive or like the bad one
    assert quality.judge(table(spark).limit(0), labels, ["doc_id"]).count() == 0
    assert quality.judge(table(spark), labels.limit(0), ["doc_id"]).where("kept = base_failed").count() == 0


def test_quality_query(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = queries.op5_quality(spark, data).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:7] == plain_base(texts[r.doc_id])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    judged = [(labels[r.doc_id], r.kept) for r in got if r.doc_id in labels and not r.base_failed]
    assert sum(q == k for q, k in judged) >= 0.95 * len(judged)


# ---- language ---------------------------------------------------------------------------------------


def plain_probability(top, char, context):
    """Interpolated Kneser-Ney from the definition: counts of the longest context, distinct characters
    before for shorter ones."""
    d, order = langid.DISCOUNT, langid.ORDER

    def counts(n):
        if n == order:
            return {g: c for g, c in top.items() if len(g) == n}
        longer = counts(n + 1)
        return {**{g: c for g, c in top.items() if len(g) == n}, **Counter(g[1:] for g in longer if len(g) == n + 1)}

    seen = counts(1)
    p = 1 / (len(seen) + 1)
    for n in range(1, order + 1):
        if n - 1 > len(context):
            break
        ctx = context[len(context) - n + 1 :] if n > 1 else ""
        after = {g: c for g, c in counts(n).items() if g[:-1] == ctx}
        if after:
            total = sum(after.values())
            p = max(after.get(ctx + char, 0) - d, 0) / total + d * len(after) / total * p
    return p


def test_kneser_ney_by_definition(spark):
    rows = spark.createDataFrame([("aa", "banana band bandana"), ("bb", "titi tata toti")], "lang string, text string")
    model = langid.train(rows)
    words = ["banana", "tit", "xyz", "bo", "n"]
    got = langid.word_entropies(words, model)
    for j, lang in enumerate(model.languages):
        top = Counter()
        for w in {"aa": "banana band bandana", "bb": "titi tata toti"}[lang].split():
            marked = langid.START + w + langid.STOP
            for end in range(2, len(marked) + 1):
                top[marked[max(0, end - langid.ORDER) : end]] += 1
        for i, w in enumerate(words):
            marked = langid.START + w + langid.STOP
            want = -sum(log(plain_probability(top, marked[k], marked[max(0, k - langid.ORDER + 1) : k])) for k in range(1, len(marked)))
            assert got[i, j] == pytest.approx(want, rel=1e-4)
            assert got[i, -1] == len(w) + 1


def test_probabilities_add_up(spark):
    top = Counter({langid.START + "a": 2, langid.START + "ab": 1, "\x02ab\x03": 1})
    seen = ["a", "b", "\x03"]
    total = sum(plain_probability(top, c, "\x02a") for c in seen)
    assert total < 1 <= total + 3 * plain_probability(top, "?", "\x02a")


def test_language_odd_tables(spark):
    rows = [("en", "the cat and the dog " * 5)] * 3 + [("fr", "le chat et le chien " * 5)] * 3 + [(None, "x"), ("de", None)]
    model = langid.train(spark.createDataFrame(rows, "lang string, text string"))
    got = langid.predict(table(spark, [*TEXTS, "THE CAT!", "le Chien, et"]), model, ["text"]).collect()
    by_text = {r.text: r for r in got}
    assert by_text["THE CAT!"].lang_pred == "en" and by_text["le Chien, et"].lang_pred == "fr"
    for t in (None, "", " \n\t ", "#" * 3000):
        assert (by_text[t].lang_pred, by_text[t].score, by_text[t].accepted) == ("und", 0.0, False)
    assert all(0 <= r.score <= 1 for r in got)
    nothing = langid.train(spark.createDataFrame([], "lang string, text string"))
    assert {r.lang_pred for r in langid.predict(table(spark), nothing, ["doc_id"]).collect()} == {"und"}
    assert langid.predict(table(spark).limit(0), model, ["doc_id"]).count() == 0


def test_numbers_that_are_no_digits_are_no_letters(spark):
    assert langid.letter_words("² ½ 12 ① Ⅷ a²b Ñandú_x 漢字") == ["a", "b", "ñandú", "x", "漢字"]
    model = langid.train(spark.createDataFrame([("en", "the cat and the dog")], "lang string, text string"))
    got = langid.predict(table(spark, ["² ½ 12", "①"]), model, ["text", "doc_id"]).where("doc_id < 2 and text not like 'again%'").collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}


def test_single_grams_count_at_every_size(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE", 1)
    rows = spark.createDataFrame([("aa", "banana"), ("aa", "cabana")], "lang string, text string")
    model = langid.train(rows)
    top = Counter()
    for w in ("banana", "cabana"):
        marked = langid.START + w + langid.STOP
        for end in range(2, len(marked) + 1):
            top[marked[max(0, end - langid.ORDER) : end]] += 1
    marked = langid.START + "caba" + langid.STOP
    want = -sum(log(plain_probability(top, marked[k], marked[max(0, k - langid.ORDER + 1) : k])) for k in range(1, len(marked)))
    assert langid.word_entropies(["caba"], model)[0, 0] == pytest.approx(want, rel=1e-4)


def test_strange_text_is_rejected(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = langid.train(langid.sample(docs))
    odd = spark.createDataFrame([("xqzj vkwq jxzz qqxv " * 30,), ("зачем мы здесь сегодня " * 30,)], "text string")
    assert langid.predict(odd, model, ["text"]).where("accepted").count() == 0
    assert langid.predict(docs, model, ["doc_id"]).where("not accepted").count() == 0


def test_language_query(spark, data):
    got = queries.op8_language(spark, data).join(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


# ---- toxicity ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("strides", [toxicity.STRIDES, 3])
def test_marginals_by_enumeration(monkeypatch, strides):
    monkeypatch.setattr(toxicity, "STRIDES", strides)
    rng = np.random.default_rng(1)
    lengths = [3, 0, 1, 6, 2, 0]
    ends = np.cumsum([0, *lengths])
    scores, step = rng.normal(0, 2, ends[-1]), rng.normal(0, 1, (2, 2))
    p, pairs = toxicity.marginals(scores, ends, step)
    for a, b in zip(ends, ends[1:]):
        total, single, double = 0.0, np.zeros(b - a), np.zeros((b - a, 4))
        for states in itertools.product((0, 1), repeat=b - a):
            w = exp(sum(scores[a + i] for i, s in enumerate(states) if s) + sum(step[x, y] for x, y in zip(states, states[1:])))
            total += w
            for i, s in enumerate(states):
                single[i] += w * s
                if i:
                    double[i, 2 * states[i - 1] + s] += w
        if b > a:
            assert np.allclose(p[a:b], single / total) and np.allclose(pairs[a:b], double / total)


def test_extreme_scores_stay_finite():
    scores = np.array([900.0, -900.0, 0.0] * 500)
    p, pairs = toxicity.marginals(scores, np.array([0, 1500]), np.array([[0.0, -3.0], [-3.0, 2.0]]))
    assert np.isfinite(p).all() and np.isfinite(pairs).all() and p[0] > 0.9 and p[1] < 0.1


def test_toxicity_trains_on_bounded_parts_of_the_sample(spark, monkeypatch):
    rows = [(i % 3 == 0, " ".join(f"w{i * j % 97}" for j in range(1, 40)) + (" foul" * 3 if i % 3 == 0 else "")) for i in range(90)]
    rows += [(True, ""), (False, "")]
    table = spark.createDataFrame([(int(t), x) for t, x in rows], "toxic int, text string").coalesce(1)
    whole, seen = toxicity.train(table), []
    inner = toxicity.marginals
    monkeypatch.setattr(toxicity, "TOKENS", 100)
    monkeypatch.setattr(toxicity, "marginals", lambda s, *rest: seen.append(len(s)) or inner(s, *rest))
    parts = toxicity.train(table)
    assert max(seen) <= 100 and sum(seen) == (toxicity.ROUNDS + 1) * sum(len(x.split()) for _, x in rows)
    assert np.allclose(whole.weights, parts.weights) and np.allclose(whole.step, parts.step)
    assert np.allclose([whole.bias, whole.slope, whole.shift], [parts.bias, parts.slope, parts.shift])


def test_toxicity_learns_spans_and_handles_odd_tables(spark):
    import random

    rnd = random.Random(4)
    plain = lambda n: [rnd.choice(["stone", "river", "cloud", "garden", "window", "paper"]) + str(rnd.randrange(30)) for _ in range(n)]
    rows, labels = [], []
    for i in range(200):
        words = plain(40)
        if i % 4 == 0:
            for _ in range(3):
                words.insert(rnd.randrange(40), rnd.choice(["vilemot", "vilesor", "Vilezan,"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    lab = spark.createDataFrame([*labels, (None, 1), (9999, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(toxicity.sample(df, lab))
    text = "stone1 river2 vilenew cloud3 garden4 vilemot"  # a new word of the family
    odd = toxicity.score(table(spark, [*TEXTS, text, "stone1 river2 " * 3000]), model, ["text"]).collect()
    by_text = {r.text: r for r in odd}
    assert by_text[text].score > 0.5 and by_text[text].spans == ["14:21", "37:44"]
    assert all(0 <= r.score < 0.5 and r.spans == [] for r in odd if r.text != text)
    assert toxicity.score(df.limit(0), model, ["doc_id"]).count() == 0
    assert toxicity.train(toxicity.sample(df, lab.where("toxic = 0"))) is None
    assert {r.score for r in toxicity.score(df, None, ["doc_id"]).collect()} == {0.0}


def test_long_labelled_texts_teach(spark):
    import random

    rnd = random.Random(5)
    plain = lambda n: " ".join(rnd.choice(["stone", "river", "cloud", "garden", "window"]) + str(rnd.randrange(900)) for _ in range(n))
    rows = [(i, f"{plain(2000)} {rnd.choice(['vilemot', 'vilesor'])} {plain(2000)}" if i % 2 else plain(4000)) for i in range(60)]
    assert min(len(t) for _, t in rows) > toxicity.SAMPLE_CHARS
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int")
    sample = toxicity.sample(df, labels)
    model = toxicity.train(sample)
    got = toxicity.score(df, model, ["doc_id"]).collect()
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in got)
    marks = toxicity.markers(sample)
    assert "vile|" in marks
    for r in toxicity.material(sample, marks).collect():
        assert len(r.text) < toxicity.SAMPLE_CHARS + 1000 and ("vile" in r.text) == bool(r.toxic)
    assert toxicity.shortened("a b", marks) == "a b"


def test_toxicity_query(spark, data):
    import zlib

    rows = queries.op10_toxicity(spark, data).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    assert len(rows) == spark.read.parquet(f"{data}/documents.parquet").count()
    judged = [(labels[r.doc_id], r.predicted) for r in rows if r.doc_id in labels]
    assert sum(a == b for a, b in judged) >= 0.85 * len(judged)


def test_toxicity_held_out_accuracy(spark):
    import os

    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("table not present")
    rows = queries.op10_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out")
    counts = {(r.toxic, r.predicted): r["count"] for r in rows.groupBy("toxic", "predicted").count().collect()}
    right = counts.get((0, 0), 0) + counts.get((1, 1), 0)
    assert right >= 0.95 * sum(counts.values())
