"""Fingerprints, links and components against all pairs of small tables."""

import re

import pytest
import xxhash

from millrace.llm import queries, simhash
from millrace.llm.batches import stored


def plain_fingerprint(text):
    words = [w for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits


def plain_components(rows):
    """(key, fingerprint, component) with union-find over all pairs."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if bin(a ^ rows[j][1]).count("1") <= 3:
                parent[find(i)] = find(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        r = find(i)
        if key is not None:
            low[r] = min(key, low.get(r, key))
    return sorted(((k, f, low.get(find(i))) for i, (k, f) in enumerate(rows)), key=str)


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


@pytest.mark.parametrize("text", [None, "", " \n", "A", "a B", "a B c", "Été ÀB c d", "x " * 500, "one two three four\tfive"])
def test_fingerprint(text):
    assert simhash.text_fingerprint(text) == signed(plain_fingerprint(text))


def family(seed, n):
    import random

    rnd = random.Random(seed)
    out, centre = [], rnd.getrandbits(64)
    for _ in range(n):
        f = rnd.choice(out) if out and rnd.random() < 0.7 else centre
        for _ in range(rnd.randrange(5)):
            f ^= 1 << rnd.randrange(64)
        out.append(f)
    return out + [rnd.getrandbits(64) for _ in range(n // 2)] + [0, 0, 1 << 63, (1 << 64) - 1]


@pytest.mark.parametrize("hot", [simhash.HOT, 2])
def test_groups_equal_all_pairs(spark, hot):
    prints = [f for s in range(3) for f in family(s, 60)]
    rows = [(i, f) for i, f in enumerate(prints)] + [(5, prints[9]), (None, prints[0]), (None, 77)]
    df = spark.createDataFrame([(k, signed(f)) for k, f in rows], "doc_id bigint, fp bigint")
    got = simhash.groups(df, "doc_id", hot).select("doc_id", "fp", "component_id").collect()
    assert sorted(((r[0], r[1] % (1 << 64), r[2]) for r in got), key=str) == plain_components(rows)


def test_long_chain_is_one_component(spark):
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(5, 5), (900, 901)], "a bigint, b bigint")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, n + 1)}, 901: 900}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookups_are_shuffled_whatever_size_spark_expects(spark, monkeypatch):
    """Seventeen lookups a segment are exploded from a small file: sent whole they fill the driver."""
    fps = stored(spark.createDataFrame([(signed(f),) for f in set(family(3, 60))], "fp bigint"))
    assert "Broadcast" not in plan_of(simhash.links(fps))
    monkeypatch.setattr("millrace.llm.batches.SMALL", 10)  # more rows than may be sent
    rows = stored(fps.selectExpr("fp", "fp % 1000 as doc_id"))
    assert "Broadcast" not in plan_of(simhash.groups(rows, "doc_id"))


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, None, 3), (2, "", 4), (2, " ", 5)], "doc_id bigint, text string, fp int")
    marked = simhash.fingerprints(df, ["doc_id"])
    assert {r.component_id for r in simhash.groups(marked, "doc_id").collect()} == {1}
    empty = simhash.fingerprints(df.limit(0), ["doc_id"])
    assert simhash.groups(empty, "doc_id").count() == 0


def test_query_equals_all_pairs(spark, data):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    got = queries.op2_simhash(spark, data).collect()
    assert sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got), key=str) == plain_components(rows)
