"""Packing and byte-level BPE: library results, round trips, bin-by-bin packing."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import bpe, packing, queries
from millrace.llm.batches import Memo, blocks, chunks

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
ENCODER = bpe.Encoder(RANKS)
PATTERN = regex.compile(public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, " ", "\n\n", "a", " lead", "trail ", "two  spaces", "tab\tand\x1c sep", "<|endoftext|> x", "日本語" * 300, "a" * 3000, "🎉é" * 50]


def tokenizer():
    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return t


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab  \n\té√’sl1!?\u3000\x1c\u00a0T"), max_size=40))
def test_chunks_encode_like_the_text(text):
    assert "".join(chunks(text)) == text
    assert [i for c in chunks(text) for i in ENCODER.encode(c, PATTERN)] == LIBRARY.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=30))
def test_pieces_merge_like_the_library(piece):
    assert ENCODER.encode_bytes(piece) == (LIBRARY._encode_single_piece(piece) if piece else [])


def test_small_vocabulary_needs_stepping_back():
    ranks = {b: i for i, b in enumerate([b"a", b"b", b"c", b"ab", b"bc", b"abc", b"ca", b"aa", b"aab"])}
    encoder = bpe.Encoder(ranks)
    library = tiktoken.Encoding("small", pat_str=".+", mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(3)
    for _ in range(3000):
        piece = bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(1, 12)))
        assert encoder.encode_bytes(piece) == library._encode_single_piece(piece)


def test_encode_and_decode_tables(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ODD)] + [(0, "again", 1)], "doc_id bigint, text string, ids int")
    coded = bpe.encode(df, RANKS, public_tokenizers.PATTERN, ["doc_id", "text"])
    back = bpe.decode(coded, RANKS, ["doc_id", "text", "ids"]).collect()
    assert len(back) == len(ODD) + 1
    for r in back:
        assert r.ids == LIBRARY.encode_ordinary(r.text or "") and bytes(r.bytes) == (r.text or "").encode()
    assert bpe.encode(df.limit(0), RANKS, public_tokenizers.PATTERN, ["doc_id"]).count() == 0


def test_bpe_query(spark, data):
    import hashlib

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for r in queries.op4_bpe(spark, data).collect():
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == sha(texts[r.doc_id].encode())


def plain_plan(sizes, capacity):
    """Best-two-fit bin by bin."""
    left = sorted(sizes)
    bins = []
    while left:
        bin_, gap = [], capacity
        for s in sorted(left, reverse=True):
            if s <= gap:
                bin_.append(s)
                left.remove(s)
                gap -= s
        if gap:
            small, room = min(bin_), gap + min(bin_)
            pairs = [(a + b, a) for i, a in enumerate(left) for b in left[i + 1 :] if a + b <= room]
            pairs += [(a + b, b) for i, a in enumerate(left) for b in left[i + 1 :] if a + b <= room]
            if pairs and max(pairs)[0] > small:
                total = max(pairs)[0]
                # equal sums: the pair with the least smaller document
                first = min(min(a, total - a) for t, a in pairs if t == total)
                bin_.remove(small)
                left.append(small)
                for s in (first, total - first):
                    left.remove(s)
                    bin_.append(s)
        bins.append(sorted(bin_, reverse=True))
    return sorted(bins)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_plan_equals_packing_bin_by_bin(sizes):
    counts = np.bincount(np.array(sizes, int), minlength=31)[:31]
    got = [sorted((s for s, n in content for _ in range(n)), reverse=True) for times, content in packing.plan(counts) for _ in range(times)]
    assert sorted(got) == plain_plan(sizes, 30)


def check_pieces(rows, texts, capacity):
    coder, bins, docs = tokenizer(), defaultdict(list), defaultdict(dict)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id][r.piece] = r
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert set(docs) == set(texts)
    for key, text in texts.items():
        ids = coder.encode(text or "", add_special_tokens=False).ids + [0]
        pieces = [docs[key][i] for i in range(len(docs[key]))]
        yield ids, pieces
        assert [p.length for p in pieces[1:]] == [capacity] * (len(pieces) - 1)
        start = 0
        for p in pieces:
            assert p.start == start
            start += p.length
        assert start == len(ids)
    return


def test_packing_round_trip(spark):
    texts = {i: t for i, t in enumerate(ODD)} | {100: "word " * 5000}
    df = spark.createDataFrame([(k, t, 9) for k, t in texts.items()], "doc_id bigint, text string, length int")
    rows = packing.pack(df, VOCABULARY, ["doc_id"], capacity=64).collect()
    for ids, pieces in check_pieces(rows, texts, 64):
        assert np.frombuffer(b"".join(bytes(p.ids) for p in pieces), "<u4").tolist() == ids
    assert packing.pack(df.limit(0), VOCABULARY, ["doc_id"]).count() == 0
    twice = packing.pack(df.union(df), VOCABULARY, ["doc_id"], capacity=64).count()
    assert twice == 2 * len(rows)


def test_offsets_by_join_give_the_same_law(spark, monkeypatch):
    monkeypatch.setattr(packing, "SMALL_OFFSETS", 0)
    df = spark.range(300).selectExpr("id as doc_id", "repeat('word ', cast(id % 70 as int)) as text").repartition(5)
    rows = packing.pack(df, VOCABULARY, ["doc_id"], capacity=64).collect()
    for _ in check_pieces(rows, {i: "word " * (i % 70) for i in range(300)}, 64):
        pass


def test_packing_query(spark, data):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = queries.op3_packing(spark, data).collect()
    tokens = 0
    for ids, pieces in check_pieces(rows, texts, packing.CAPACITY):
        tokens += len(ids)
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
    assert len({r.sequence_id for r in rows}) <= 1.02 * tokens / packing.CAPACITY + 1


def test_memo_forgets_and_recovers():
    made = []
    memo = Memo(lambda keys: made.extend(keys) or [k * 2 for k in keys], limit=5)
    for i in range(0, 40, 4):
        keys = {f"k{j}" for j in range(i, i + 4)} | {"k0"}
        memo.learn(keys)
        assert all(memo[k] == k * 2 for k in keys)
    assert made.count("k0") == 1


def test_fast_coder_equals_the_library():
    import json

    with open(VOCABULARY, encoding="utf-8") as f:
        text = f.read()
    assert packing._merge_ranks(json.loads(text))
    library, rnd = tokenizer(), random.Random(5)
    keys = ["".join(rnd.choice("aeionrst thé'l1!\n ") for _ in range(rnd.randrange(1, 25))) for _ in range(3000)] + ["<|endoftext|>"]
    want = [np.array(library.encode(k, add_special_tokens=False).ids, "<u4").tobytes() for k in keys]
    assert packing._coder(text)(keys) == want
    changed = json.loads(text)
    changed["model"]["merges"] = changed["model"]["merges"][::-1]
    assert packing._merge_ranks(changed) is None
    spaced = json.loads(text)
    spaced["pre_tokenizer"]["add_prefix_space"] = True
    other = Tokenizer.from_str(json.dumps(spaced))
    got = packing._coder(json.dumps(spaced))(["word", "two"])
    assert got == [np.array(other.encode(k, add_special_tokens=False).ids, "<u4").tobytes() for k in ("word", "two")]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab  \n\té√’sl1!?\u3000\x1c\u00a0T"), max_size=60), st.integers(1, 20))
def test_blocks_encode_like_the_text(text, size):
    pieces = list(blocks(text, size))
    assert "".join(pieces) == text
    assert [i for b in pieces for i in LIBRARY.encode_ordinary(b)] == LIBRARY.encode_ordinary(text)


def test_texts_of_words_met_once_are_not_cut(monkeypatch):
    with open(VOCABULARY, encoding="utf-8") as f:
        text = f.read()
    texts = [t or "" for t in ODD] + [" ".join(f"w{i}x{i * 7}" for i in range(3000))]
    want = [np.array(tokenizer().encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    monkeypatch.setattr(packing, "chunk_words", lambda t: pytest.fail("cut into words"))
    assert packing._text_coder(text)(texts) == want


def test_general_tokenizers_are_asked_once_per_word(monkeypatch):
    with open(VOCABULARY, encoding="utf-8") as f:
        text = f.read()
    texts = [t or "" for t in ODD] + ["a b a b", "b a"]
    want = packing._text_coder(text)(texts)
    monkeypatch.setattr(packing, "_ranked", lambda t: None)
    assert packing._text_coder(text)(texts) == want
