"""Personal data against plain patterns, and terms that disclose a value."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import pii, queries

#: The patterns as the query states them (fixed values).
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GOOD = "mail me.at+x@a-b.co.uk, 10.0.0.255 or 4111 1111 1111 1111, +1 (743) 555-3824 né@x.y"
TEXTS = [
    None, "", " ", GOOD, "a@b@c.d.e", "x@y", "@a.b", "1.2.3.4.5.6.7.8.9", "256.1.1.1 001.002.003.0004", "4111111111111112",
    "+1234567890123456", "+12 34", "1.2.3.4@5.6", "a@b.c@d.e", "9" * 30_000, "a" * 30_000 + "@", "+1 " + "5 " * 9 + ")", "0000.0.0.0",
]


def plain_spans(text):
    text, out = text or "", []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            ok = True
            if kind == "ip":
                ok = all(int(p) <= 255 for p in m[0].split("."))
            elif kind == "card":
                doubled = [d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(reversed(digits))]
                ok = 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
            elif kind == "phone":
                ok = 10 <= len(digits) <= 15
            if ok:
                out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda x: (x[0], x[2]))


@pytest.mark.parametrize("i", range(len(TEXTS)))
def test_base_spans(i):
    if len(TEXTS[i] or "") > 10_000:
        assert pii.base_spans(TEXTS[i]) == []  # in linear time
    else:
        assert pii.base_spans(TEXTS[i]) == plain_spans(TEXTS[i])


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet=st.sampled_from("a1@.-+ 05()é%"), max_size=40))
def test_base_spans_of_any_text(text):
    assert pii.base_spans(text) == plain_spans(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("0123456789 -"), min_size=14, max_size=24))
def test_cards(text):
    assert pii.base_spans(text) == plain_spans(text)


def disclosing(spark):
    """Every mention of one address has a rare codename near it; other words are common."""
    filler = [f"common{i % 9} " * 4 for i in range(60)]
    rows = [(i, f"alpha{i} reported Zephyrine wrote from boss@corp.example.com on day{i} " + t) for i, t in enumerate(filler[:6])]
    rows += [(100 + i, t + f" common{i % 9} someone{i}@mail.example.com common3") for i, t in enumerate(filler)]
    rows += [(300, "the zephyrine alone"), (301, None), (302, ""), (300, "one id again zephyrine")]
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, sanitised string")


def test_disclosing_terms_are_sanitised_everywhere(spark):
    df = disclosing(spark)
    assert {r.term for r in pii.disclosing_terms(df).collect()} == {"reported", "wrote", "from", "zephyrine"} - {"from"} | {"from"}
    got = {r.text: r.sanitised for r in pii.spans(df, ["text"]).collect()}
    assert got["the zephyrine alone"] == "the [TERM] alone" and got[None] is None and got[""] == ""
    first = next(v for k, v in got.items() if k and k.startswith("alpha0"))
    assert "[EMAIL]" in first and "Zephyrine" not in first and "common0" in first
    removed = {r.text: r.sanitised for r in pii.spans(df, ["text"], remove=True).collect()}
    assert removed["the zephyrine alone"] == "the  alone"


def test_many_terms_are_joined(spark, monkeypatch):
    df = disclosing(spark)
    want = sorted(map(str, pii.spans(df, ["doc_id", "text"]).collect()))
    monkeypatch.setattr(pii, "SMALL_TERMS", 0)
    assert sorted(map(str, pii.spans(df, ["doc_id", "text"]).collect())) == want


def test_copies_disclose_nothing(spark):
    df = spark.createDataFrame([(i, "hello Marigold write to a@b.example.com today") for i in range(50)], "doc_id bigint, text string")
    assert pii.disclosing_terms(df).count() == 0
    assert pii.spans(df.limit(0), ["doc_id"]).count() == 0


def test_query(spark, data):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = queries.op9_pii(spark, data).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_spans(texts[r.doc_id])
        named = [f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in base) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert set(named) <= set(r.spans.split(","))


@pytest.mark.parametrize(
    "text, want",
    [
        ("Zephyrine boss@corp.example.com", {"zephyrine"}),
        ("boss@corp.example.com Zephyrine", {"zephyrine"}),
        ("zero1 one1 two2 three four five seven eight nine9 boss@corp.example.com", {"one1", "two2", "three", "four", "five", "seven", "eight", "nine9"}),
        ("boss@corp.example.com zero1 one1 two2 three four five seven eight nine9", {"zero1", "one1", "two2", "three", "four", "five", "seven", "eight"}),
        (" ".join(c * 300 for c in "abcdefgh") + " boss@corp.example.com", {c * 300 for c in "abcdefgh"}),
    ],
)
def test_whole_words_around_a_value(text, want):
    near = list(pii._near(text, pii.base_spans(text)))
    assert {term for value, term, _ in near if value != pii.ANY} == want
    assert {term for value, term, _ in near if value == pii.ANY} == want
