"""URL rules and sharding against plain restatements."""

import re
import zlib
from collections import defaultdict
from math import log

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import queries, sharding, urlrules

RULES = [urlrules.site_rule(*r) for r in queries.SITE_RULES] + [urlrules.word_rule("block", w) for w in urlrules.BLOCKED_WORDS]
URLS = [
    None, "", "no scheme", "http://", "http://COM/", "https://Example.COM/en/1", "http://www.example.com/en/?x=/fr/", "http://example.com/EN/1",
    "http://notexample.com/en/1", "http://a.net/es/", "http://a.net/es", "http://net/fr/x#y", "http://a.org/en/", "ftp://cheap-pills.org/x",
    "http://pillshop.org/", "http://x.org/pills/", "http://free-bets.net/es/1", "http://a.com", "http://a.com?q=/en/", "x://y://z.com/",
    "http://a.example.com/en/\nmore", "http://ads.com/", "http://ads.io?x", "://bets.io#f",
]


def plain(url):
    host = path = ""
    if url and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
        host, path = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]
    best = max(
        ((len(h + p), h + p, v) for v, h, p in queries.SITE_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)),
        default=None,
    )
    words = set(re.split("[^a-z0-9]+", host))
    verdict = best[2] if best else "block" if words & set(urlrules.BLOCKED_WORDS) else "allow"
    return host, path, best and best[1], verdict


def test_judging(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(5, URLS[5], "y"), (None, URLS[6], "z")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    got = urlrules.judge(df, RULES).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *plain(u)) for i, u, _ in rows), key=str)
    assert urlrules.judge(df.limit(0), RULES).count() == 0


def test_rules_are_filed_under_their_rarest_token(spark):
    tokens = spark.createDataFrame([("com",), ("com",), ("example",), ("en",), ("en",), ("en",)], "token string")
    got = {r.name: r.token for r in urlrules.index(RULES[:3], tokens).collect()}
    assert got == {"com/": "com", "example.com/en/": "example", "www.example.com/en/": "www"}
    assert urlrules.site_rule("block", "a.com", "/en").tokens == ("a", "com")
    with pytest.raises(ValueError):
        urlrules.index([urlrules.Rule("block", ".", ())], tokens)


def test_many_rules_are_joined(spark, monkeypatch):
    monkeypatch.setattr(urlrules, "SMALL_RULES", 0)
    df = spark.createDataFrame([(1, "http://a.net/es/")], "page_id int, url string")
    assert urlrules.judge(df, RULES).first().rule == "net/es/"


def test_url_query_equals_sql(spark, data):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{data}/pages.parquet'")
    want = con.sql(queries.ORACLES["op6_url_rules"])
    got = queries.op6_url_rules(spark, data)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)


def plain_shard(key, weights, seed=sharding.SEED):
    def score(s, w):
        h = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)
        h = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), h)
        h = xxhash.xxh64_intdigest(s.to_bytes(4, "little"), h)
        return -log(((h >> 11) + 0.5) / 2**53) / w

    return min((score(s, w), s) for s, w in enumerate(weights) if w > 0)[1]


def test_rendezvous_choice(spark):
    weights = [1.0, 2.0, 0.0, 0.5]
    df = spark.range(400).select(F.col("id"), sharding.shard_of(F.col("id"), weights).alias("s"))
    got = {r.id: r.s for r in df.collect()}
    assert got == {k: plain_shard(k, weights) for k in range(400)}
    taken = [list(got.values()).count(s) for s in range(4)]
    assert taken[2] == 0 and taken[1] > taken[0] > taken[3]
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("id"), [0.0])


def check_shards(rows, texts):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, queries.SHARDS)
        body = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(body) + 16, zlib.crc32(body))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_query(spark, data):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = queries.op7_sharding(spark, data).collect()
    assert {r.doc_id: r.shard for r in rows} == {k: plain_shard(k, [1.0] * queries.SHARDS) for k in texts}
    assert len(rows) == len(texts) and {r.law for r in rows} == {"key"}
    check_shards(rows, texts)


def test_blocks_repeats_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 2)
    rows = [(i % 200, "t") for i in range(400)] + [(None, None)] * 3 + [(7, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, shard string")
    got = sharding.assign(df, [1.0] * 3, [1.0] * 4).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert len(got) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(r.doc_id, r.shard) for r in got}) == 201
    assert sharding.assign(df.limit(0), [1.0]).count() == 0
