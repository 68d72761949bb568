"""Near copies against brute-force Jaccard similarity of five-word shingles."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import copies, simhash
from millrace.llm.batches import stored


def brute_groups(texts):
    """{id: smallest id reachable over pairs of Jaccard similarity >= 0.8}."""
    sets = {}
    for i, t in texts.items():
        w = t.lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    order = sorted(texts)
    for x in order:
        for y in order:
            both = len(sets[x] & sets[y])
            if x < y and (sets[x] == sets[y] or 5 * both >= 4 * (len(sets[x]) + len(sets[y]) - both)):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {i: find(i) for i in texts}


def edited():
    """Texts, and copies with a few words changed; a passage and a closing line that many share."""
    draw, texts = random.Random(4), {}
    line, passage = "the same closing line stands under many of these texts", " ".join(f"p{i}" for i in range(40))
    for i in range(60):
        words = [f"w{draw.randrange(400)}" for _ in range(draw.choice([3, 12, 60, 200]))]
        body = [passage.split() + words, words, words + line.split()][i % 3]
        texts[10 * i] = " ".join(body)
        for k in range(1, 6):
            copy = list(body)
            for _ in range(draw.randrange(1, 2 + len(copy) // 40)):
                copy[draw.randrange(len(copy))] = f"new{draw.randrange(10**6)}"
            texts[10 * i + k] = " ".join(copy)
    chain = [f"c{i}" for i in range(60)]  # neighbours are similar, ends are not
    for k in range(20):
        texts[1000 + k] = " ".join(chain[k:] + [f"d{i}" for i in range(k)])
    return texts


def test_parity_never_rules_out_more_than_the_sets_differ(spark):
    draw, rows = random.Random(9), []
    for i in range(300):
        a = {draw.getrandbits(63) for _ in range(draw.choice([0, 1, 5, 100, 127, 129, 1000]))}
        b = set(draw.sample(sorted(a), round(len(a) * draw.choice([0.5, 0.9, 1.0])))) | {draw.getrandbits(63) for _ in range(draw.randrange(1 + len(a) // 4))}
        a, b = np.array(sorted(a), np.int64), np.array(sorted(b), np.int64)
        rows.append((i, len(np.setxor1d(a, b)), copies.parity(a).tolist(), copies.parity(b).tolist()))
    df = spark.createDataFrame(rows, "i int, apart int, pa array<bigint>, pb array<bigint>")
    got = df.where("abs(log2(size(pa)) - log2(size(pb))) <= 1").selectExpr("apart", f"{copies._apart('pa', 'pb')} AS bits").collect()
    assert len(got) > 250 and all(r.bits <= r.apart for r in got)
    assert sum(r.bits >= r.apart // 2 for r in got) > 200


def test_stage_keeps_one_of_each_similar_group(spark, tmp_path):
    texts = edited()
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id bigint, text string")
    left = corpus_pipeline.near_duplicate_stage(spark, docs, str(tmp_path))
    want = brute_groups(texts)
    assert len(set(want.values())) < len(texts) - 100
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(want.values()))


def test_order_never_changes_a_result(spark, tmp_path, monkeypatch):
    texts = edited()
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id bigint, text string")
    monkeypatch.setattr(copies, "SAMPLE", 0)
    left = corpus_pipeline.near_duplicate_stage(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(brute_groups(texts).values()))


def test_joins_are_shuffled_whatever_size_spark_expects(spark, tmp_path, monkeypatch):
    """Only tables counted as small are sent to every task; here none is."""
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df)

    for module in (copies, simhash):
        monkeypatch.setattr(module, "stored", noted)
    monkeypatch.setattr("millrace.llm.batches.SMALL", -1)
    texts = {i: t for i, t in edited().items() if i < 120}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    left = corpus_pipeline.near_duplicate_stage(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(brute_groups(texts).values()))
    assert len(plans) > 10 and not any("Broadcast" in p for p in plans)


def test_real_near_copies(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").where("text is not null").dropDuplicates(["doc_id"])
    left = corpus_pipeline.near_duplicate_stage(spark, docs, data)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r.doc_id for r in left.select(F.col("doc_id")).collect()) == sorted(set(brute_groups(texts).values()))


def test_all_documents_of_linked_fingerprints_are_compared(spark, monkeypatch):
    """Also where the first documents of the fingerprints are like none of the others."""
    monkeypatch.setattr(copies, "_prefix", lambda hashes, *_: hashes[:0])
    text = lambda c, last: " ".join(f"{c}{i}" for i in range(30)) + " " + last
    texts = {1: text("a", ""), 2: text("b", "x"), 3: text("b", "y"), 4: text("c", "x"), 5: text("d", ""), 6: text("c", "y"), 7: text("e", "x"), 8: text("e", "y")}
    prints = {1: 0, 2: 0, 3: 0, 4: 0, 5: 7, 6: 7, 7: 7, 8: 15}  # 0 and 7 are linked, 7 and 15 too, 0 and 15 aren't
    known = {texts[i]: fp for i, fp in prints.items()}
    monkeypatch.setattr(copies, "text_fingerprint", lambda t: known[t])
    groups = brute_groups(texts)
    assert groups == {1: 1, 2: 2, 3: 2, 4: 4, 5: 5, 6: 4, 7: 7, 8: 7}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").coalesce(1)
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()) == [1, 2, 4, 5, 7]


def test_fingerprints_link_documents_of_the_pipeline(spark, monkeypatch):
    """Without prefixes to find pairs the SimHash links are left; an exact check follows them."""
    monkeypatch.setattr(copies, "_prefix", lambda hashes, *_: hashes[:0])
    body, few = (" ".join(f"{c}{i}" for i in range(n)) + " " for c, n in (("r", 31), ("s", 7)))
    texts = {5: body * 10 + "x0", 3: body * 10 + "y0", 8: "quite another text of some words"}
    texts |= {12: few * 40 + " ".join(f"x{i}" for i in range(12)), 11: few * 40 + " ".join(f"y{i}" for i in range(12))}
    prints = {i: copies.text_fingerprint(t) for i, t in texts.items()}
    assert prints[5] == prints[3] and prints[12] == prints[11]
    groups = brute_groups(texts)
    assert groups[5] == 3 and groups[12] == 12  # 11 and 12 have one fingerprint, but unlike sets
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()) == [3, 8, 11, 12]
