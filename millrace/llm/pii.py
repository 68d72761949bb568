"""Personal data: patterns, and terms that give protected values away.

Protected are values of four patterns: e-mail addresses, IP addresses, card and telephone numbers.  A
term (a word of TERM_LENGTH characters or more, lower-cased) near a value in many different surroundings
discloses it to the degree PMI(term; value) / IC(value), which is 1 where the term occurs nowhere else:

    log(n(term, value) * N / (n(term) * n(value))) / log(N / n(value))

n(term, value) counts the term's occurrences within WINDOW words of the value, n(term) all in the corpus,
N all words.  Terms with at least MIN_PLACES different surroundings and a disclosure of DISCLOSURE or more
are sanitised wherever they occur: generalised to ``[TERM]``, as values are to their kind, or removed.

* null and empty texts have no spans
* values that fail their check (Luhn, range, number of digits) are no values and are not tried again
* repeated rows and copies count as often as they occur, but copies are one surrounding
* spans of different kinds may overlap; in sanitised text the outermost run is replaced once
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from typing import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from .batches import _pieces, over_texts, stored

KINDS = ("email", "ip", "card", "phone", "term")
WINDOW = 8
TERM_LENGTH = 4
MIN_PLACES = 3
DISCLOSURE = 0.9
ANY = ""  # stands for all values together
SMALL_TERMS = 200_000  # terms that may be sent to every task

# The patterns (fixed values), written so that no start is tried twice in a run of their characters.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile("[0-9]")
TERM = re.compile(r"[^\W_]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            floor = domain.end()
        at = text.find("@", max(at + 1, floor))


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of all values, by start, then kind."""
    if not text:
        return []
    out = [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            out.append((m.start(), m.end(), 1))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(DIGITS.findall(m[0])) <= 15:
                out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda x: (x[0], x[2], x[1]))


def _near(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, str, int]]:
    """(value, term, surroundings) for the words around every value, and once (ANY, term, 0) for every
    word that is near some value."""
    if not spans:
        return
    words = [(m.start(), m.end()) for m in TERM.finditer(text)]
    starts, ends = [a for a, _ in words], [b for _, b in words]
    met: set[int] = set()
    for start, end, kind in spans:
        value = f"{kind}:{text[start:end].lower()}"
        # words that reach into the value are none
        before, after = bisect_right(ends, start), bisect_left(starts, end)
        near = [*range(max(0, before - WINDOW), before), *range(after, min(len(words), after + WINDOW))]
        around = [text[a:b] for a, b in map(words.__getitem__, near)]
        left = min(before, WINDOW)
        place = crc32("\n".join([" ".join(around[:left]), " ".join(around[left:])]).encode("utf-8", "replace"))
        for i, word in zip(near, around):
            term = word.lower()
            if len(term) >= TERM_LENGTH and not term.isdigit():
                yield value, term, place
                if i not in met:
                    met.add(i)
                    yield ANY, term, 0


def neighbours(docs: DataFrame, text: str = "text") -> DataFrame:
    """(value, term, place, n): terms near values, with a number for their surroundings.

    At most 2 * WINDOW words per value are looked at: no pairs of all words of a document are made.
    The value ANY counts words that are near some value, each once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch, 0):
                rows = [x for t in part.column(0).to_pylist() if t for x in _near(t, base_spans(t))]
                value, term, place = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value, pa.string()), pa.array(term, pa.string()), pa.array(place, pa.int64())],
                    names=["value", "term", "place"],
                )

    found = docs.select(col(text).alias("text")).mapInArrow(run, "value string, term string, place bigint")
    return found.groupBy("value", "term", "place").agg(F.count("*").alias("n"))


def _term_counts(docs: DataFrame, terms: DataFrame, few: bool, text: str) -> DataFrame:
    """(term, n_term): occurrences of the terms in all documents.

    Few terms are sent to every task, which adds up its own documents; many are joined with the words.
    """
    if not few:
        words = F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"[\p{L}\p{Nd}]+"), F.lit(0)))
        return docs.select(words.alias("term")).join(terms, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n_term"))
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(r.term for r in terms.collect()))  # at most SMALL_TERMS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, counts = shared.value, Counter()
        for batch in batches:
            for part in _pieces(batch, 0):
                for body in part.column(0).to_pylist():
                    if body:
                        counts.update(filter(wanted.__contains__, TERM.findall(body.lower())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n_term"]
        )

    partial = docs.select(col(text).alias("text")).mapInArrow(run, "term string, n_term bigint")
    return partial.groupBy("term").agg(F.sum("n_term").alias("n_term"))


def _disclosure(n_pair: Column, n_term: Column, n_value: Column, size: float) -> Column:
    pmi = F.log(n_pair * F.lit(size) / (F.greatest(n_term, n_pair) * n_value))
    return pmi / F.log(F.lit(size) / n_value)


def disclosing_terms(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term): terms that disclose some protected value; counted over all documents.

    A term occurs at least as often as it occurs near values.  That bound settles nearly all terms, so
    only the others are counted in the whole corpus.
    """
    near = stored(neighbours(docs, text))
    size = float(docs.agg(F.sum(F.size(F.split(F.trim(F.col(text)), " ")))).first()[0] or 0) + 1.0
    values = near.where(F.col("value") != ANY)
    pairs = values.groupBy("value", "term").agg(F.sum("n").alias("n_pair"), F.count("*").alias("places"))
    n_values = values.groupBy("value").agg(F.greatest(F.sum("n") / (2 * WINDOW), F.lit(1.0)).alias("n_value"))
    n_near = near.where(F.col("value") == ANY).groupBy("term").agg(F.sum("n").alias("n_near"))
    candidates = pairs.where(F.col("places") >= MIN_PLACES).join(n_values, "value").join(n_near, "term")
    bound = _disclosure(F.col("n_pair"), F.col("n_near"), F.col("n_value"), size)
    candidates = stored(candidates.where(bound >= DISCLOSURE))
    terms = candidates.select("term").distinct()
    n_terms = terms.count()
    if not n_terms:
        return terms
    counts = _term_counts(docs, terms, n_terms <= SMALL_TERMS, text)
    exact = _disclosure(F.col("n_pair"), F.col("n_term"), F.col("n_value"), size)
    return stored(candidates.join(counts, "term").where(exact >= DISCLOSURE).select("term").distinct())


FIELDS = [
    T.StructField("starts", T.ArrayType(T.IntegerType())),
    T.StructField("ends", T.ArrayType(T.IntegerType())),
    T.StructField("kinds", T.ArrayType(T.IntegerType())),
    T.StructField("sanitised", T.StringType()),
]


def _sanitised(text: str | None, spans: list[tuple[int, int, int]], remove: bool) -> str | None:
    if not text or not spans:
        return text
    runs: list[list[int]] = []
    for start, end, kind in spans:
        if runs and start < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end, kind])
    out, done = [], 0
    for start, end, kind in runs:
        out += [text[done:start], "" if remove else f"[{KINDS[kind].upper()}]"]
        done = end
    return "".join([*out, text[done:]])


def spans(docs: DataFrame, keep: list[str], text: str = "text", remove: bool = False, rewrite: bool = True) -> DataFrame:
    """Columns ``keep`` with starts, ends, kinds (numbers in KINDS) of all spans and the sanitised text.

    Few disclosing terms are sent to every task.  Many are joined with the words of the texts instead,
    and every text gets its own list.
    """
    terms = disclosing_terms(docs, text)
    picked = docs.select(*[col(c).alias(c) for c in keep], col(text).alias("__body"))
    few = terms.count() <= SMALL_TERMS
    if few:
        named = frozenset(r.term for r in terms.collect())  # at most SMALL_TERMS
        picked = picked.withColumn("__terms", F.lit(None).cast("array<string>"))
    else:
        named = frozenset()
        digest = F.sha2(F.col("__body"), 256)
        words = F.explode(F.regexp_extract_all(F.lower("__body"), F.lit(r"[\p{L}\p{Nd}]+"), F.lit(0)))
        own = picked.select(digest.alias("__digest"), words.alias("term")).join(terms, "term", "left_semi")
        own = own.distinct().groupBy("__digest").agg(F.collect_set("term").alias("__found"))
        picked = picked.withColumn("__digest", digest).join(own, "__digest", "left").withColumn("__terms", F.col("__found"))
    shared = docs.sparkSession.sparkContext.broadcast(named)
    packed = picked.select(*[F.col(c) for c in keep], F.struct(F.col("__body").alias("body"), F.col("__terms").alias("terms")).alias("__text"))

    def make():
        everywhere = shared.value

        def one(body: str | None, own: list | None) -> list[tuple[int, int, int]]:
            found = base_spans(body)
            wanted = everywhere or (frozenset(own) if own else None)
            if wanted and body:
                base = [(a, b) for a, b, _ in found]
                for m in TERM.finditer(body):
                    if m[0].lower() in wanted and not any(a < m.end() and m.start() < b for a, b in base):
                        found.append((m.start(), m.end(), 4))
                found.sort(key=lambda x: (x[0], x[2], x[1]))
            return found

        def compute(rows: list) -> list[pa.Array]:
            each = [one(r["body"], r["terms"]) for r in rows]
            new = [_sanitised(r["body"], s, remove) if rewrite else None for r, s in zip(rows, each)]
            lists = [pa.array([[x[i] for x in s] for s in each], pa.list_(pa.int32())) for i in range(3)]
            return [*lists, pa.array(new, pa.string())]

        return compute

    return over_texts(packed, keep, FIELDS, make, "__text")
