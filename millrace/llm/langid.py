"""Language identification by interpolated Kneser-Ney character models.

One model per language, over the letters of lower-cased words with a start and an end mark, up to ORDER
characters.  Counts are taken in Spark from a bounded sample of whole documents per language (all of a
language that has fewer).  Every n-gram is a hash in one sorted array; beside it stand, per language, its
discounted probability and the weight that its continuations leave to shorter contexts.  A text gets the
language of the lowest mean cross-entropy per character.

Score: the share of that language in the softmax of the negative total cross-entropies over at most
EVIDENCE characters; it is halved for every nat per character by which the text exceeds the language's
calibrated limit (mean of its sample plus CALIBRATION standard errors at that length, plus SLACK).  Texts
under 0.5 are rejected.

* null texts and those without a letter: ``und``, score 0
* long texts: every character counts; repeated rows get equal results
* nothing to learn from: every text is ``und``
* rows with null language train nothing; columns other than text are never used in a prediction
"""

from __future__ import annotations

import re
import sys
from collections import Counter, defaultdict
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import _pieces, over_texts
from .tokens import FEW_WORDS, Table, gram_hashes, laid_out, per_text

ORDER = 4
LANGUAGES = 1000
SAMPLE = 1500  # distinct texts per language, about, besides the root of their number
DISCOUNT = 0.75
EVIDENCE = 40
CALIBRATION = 6.0
SLACK = 0.3
TEXTS = 250  # worked on at once: their arrays count against the memory beside the Java heap
UNKNOWN = "und"
START, STOP = "\x02", "\x03"
# word characters but digits; superscripts, fractions and other numerals among them are no letters
WORDS = re.compile(r"[^\W\d_]+")
NUMERALS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
LETTERS = re.compile(rf"[^\W\d_{NUMERALS}]+")


def letter_words(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    lower = (text or "").lower()
    words = WORDS.findall(lower)
    return words if "".join(words).isalpha() else LETTERS.findall(lower)  # the wide class is slow


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # sorted hashes
    found: np.ndarray  # per gram and language: discounted probability after its context
    spread: np.ndarray  # per gram and language: weight of the shorter context after it
    base: np.ndarray  # per language: probability of a character never seen
    rest: np.ndarray  # per language: weight of ``base``
    mean: np.ndarray  # per language: cross-entropy per character of its own sample
    error: np.ndarray  # per language: standard deviation of that, times the root of the length


def sample(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, text) of about SAMPLE distinct texts per language and the root of their number, chosen by a
    hash of the text; all of a language that has no more."""
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    usable = usable.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    distinct = usable.select("lang", F.xxhash64("text").alias("h")).distinct()
    rows = distinct.groupBy("lang").agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect()
    if len(rows) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages to learn")
    counts = {r.lang: r.n for r in rows}
    if not counts:
        return usable
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, (SAMPLE + n**0.5) / n))])
    draw = F.pmod(F.xxhash64(F.lit(8), "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # copies of a text are drawn together; they teach once
    return usable.where(draw < F.element_at(share, F.col("lang"))).distinct()


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, n): n-grams of the sample, of the longest order or opening a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for part in _pieces(batch, 1):
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words[lang].update(letter_words(text))
        for lang, counts in words.items():
            grams: Counter = Counter()
            for word, n in counts.items():
                marked = START + word + STOP
                for end in range(2, len(marked) + 1):
                    grams[marked[max(0, end - ORDER) : end]] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams)), pa.array(list(grams)), pa.array(list(grams.values()), pa.int64())],
                names=["lang", "gram", "n"],
            )

    partial = rows.where("lang is not null").select("lang", "text").mapInArrow(run, "lang string, gram string, n bigint")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _kneser_ney(top: dict[str, int]) -> tuple[dict[str, float], dict[str, float], float, float]:
    """From the top counts: discounted probability per gram, backing-off weight per context, the weight
    left to unseen characters and their probability."""
    counts: dict[str, int] = dict(top)
    heads: dict[int, dict[str, int]] = {ORDER: top}
    for n in range(ORDER, 1, -1):
        lower: Counter = Counter()
        for gram in heads[n]:
            if len(gram) == n:
                lower[gram[1:]] += 1  # a distinct character before it
        heads[n - 1] = {**{g: c for g, c in top.items() if len(g) == n - 1}, **lower}
        for g, c in lower.items():
            counts.setdefault(g, c)
    total: Counter = Counter()
    kinds: Counter = Counter()
    for g, c in counts.items():
        total[g[:-1]] += c
        kinds[g[:-1]] += 1
    found = {g: (c - DISCOUNT) / total[g[:-1]] for g, c in counts.items()}
    spread = {ctx: DISCOUNT * kinds[ctx] / total[ctx] for ctx in total}
    rest = spread.pop("", 1.0)
    return found, spread, rest, 1.0 / (kinds[""] + 1)


def _hashes_of(grams: list[str]) -> np.ndarray:
    out = np.zeros(len(grams), np.uint64)
    flat, lengths = laid_out(grams, str)
    ends = np.cumsum(lengths) - 1
    by_order = gram_hashes(flat, ORDER)
    for n in range(1, ORDER + 1):
        these = lengths == n
        out[these] = by_order[n - 1][ends[these]]
    return out


def train(rows: DataFrame) -> Model:
    """Models of every language in ``rows`` (lang, text).  What reaches the driver are all n-grams of the
    sample, so that continuations are counted whole at every size: bounded by the sample."""
    by_lang: dict[str, dict[str, int]] = defaultdict(dict)
    for r in gram_counts(rows).collect():
        by_lang[r.lang][r.gram] = r.n
    languages = sorted(by_lang)
    parts = [_kneser_ney(by_lang[lang]) for lang in languages]
    grams = sorted({g for found, spread, _, _ in parts for g in (*found, *spread)})
    hashes = _hashes_of(grams)
    order = np.argsort(hashes)
    found, spread = np.zeros((len(grams), len(languages)), np.float32), np.ones((len(grams), len(languages)), np.float32)
    for j, (probability, weight, _, _) in enumerate(parts):
        found[:, j] = [probability.get(g, 0.0) for g in grams]
        spread[:, j] = [weight.get(g, 1.0) for g in grams]
    n = len(languages)
    model = Model(
        languages, hashes[order], found[order], spread[order],
        np.array([p[3] for p in parts], np.float32), np.array([p[2] for p in parts], np.float32), np.zeros(n), np.ones(n),
    )
    return _calibrated(model, rows)


def word_entropies(words: list[str], model: Model) -> np.ndarray:
    """Per word: negative log probability in every language, and its characters with the end mark."""
    width = len(model.languages)
    flat, lengths = laid_out([START + w + STOP for w in words], str)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(flat)) - np.repeat(starts, lengths)
    hashes = gram_hashes(flat, ORDER)
    p = np.repeat((model.base * model.rest)[None, :], len(flat), axis=0)
    spread_before: np.ndarray | None = None
    for n in range(1, ORDER + 1):
        at = np.minimum(np.searchsorted(model.grams, hashes[n - 1]), len(model.grams) - 1)
        known = (model.grams[at] == hashes[n - 1]) & (place >= n - 1)
        found = np.where(known[:, None], model.found[at], 0.0)
        if n > 1:
            p *= spread_before  # of the n - 1 characters before; 1 if they are unknown
        p += found
        own = np.where(known[:, None], model.spread[at], 1.0)
        spread_before = np.concatenate([np.ones((1, width), own.dtype), own[:-1]])
        spread_before[place < n] = 1.0
    cost = -np.log(np.maximum(p, 1e-12))
    cost[starts] = 0.0  # the start mark is given
    owner = np.repeat(np.arange(len(words)), lengths)
    sums = [np.bincount(owner, weights=cost[:, j], minlength=len(words)) for j in range(width)]
    return np.stack([*sums, lengths - 1.0], axis=1)


def _table(model: Model) -> Table:
    """Values of raw words: those of their runs of letters, added up."""

    def values(raw: list[str]) -> np.ndarray:
        runs = [letter_words(w) for w in raw]
        flat = [r for rs in runs for r in rs]
        out = np.zeros((len(raw), len(model.languages) + 1))
        if flat:
            np.add.at(out, np.repeat(np.arange(len(raw)), list(map(len, runs))), word_entropies(flat, model))
        return out

    return Table(values, len(model.languages) + 1, words=FEW_WORDS)


def _sums(texts: list, table: Table) -> np.ndarray:
    values, places, ends = table.rows([(t or "").split() for t in texts])
    return per_text(values[places], ends)


def _calibrated(model: Model, rows: DataFrame) -> Model:
    """Mean and spread of every language's cross-entropy over its own sample, added up in Spark."""
    if not model.languages:
        return model
    number = {lang: j for j, lang in enumerate(model.languages)}
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def make():
        table = _table(shared.value)

        def compute(texts: list) -> list[pa.Array]:
            sums = _sums(texts, table)
            return [pa.array(list(sums), pa.list_(pa.float64()))]

        return compute

    sums = over_texts(rows.where("lang is not null"), ["lang"], [T.StructField("sums", T.ArrayType(T.DoubleType()))], make, rows=TEXTS)
    n = F.element_at("sums", -1)
    own = F.element_at("sums", F.element_at(F.create_map(*[F.lit(x) for k, j in number.items() for x in (k, j + 1)]), F.col("lang")))
    each = sums.where(n > 0).select("lang", (own / n).alias("h"), n.alias("n"))
    totals = each.groupBy("lang").agg(
        (F.sum(F.col("h") * F.col("n")) / F.sum("n")).alias("mean"), F.count("*").alias("docs"),
        F.sum(F.col("n") * F.col("h") * F.col("h")).alias("a"), F.sum(F.col("n") * F.col("h")).alias("b"), F.sum("n").alias("c"),
    )
    for r in totals.collect():  # one row per language
        j = number[r.lang]
        model.mean[j] = r.mean
        model.error[j] = max(1.0, (max(0.0, r.a - 2 * r.mean * r.b + r.mean**2 * r.c) / r.docs) ** 0.5)
    return model


FIELDS = [
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("accepted", T.BooleanType()),
]


def predict(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` with lang_pred, score and accepted for every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # size bounded by the sample

    def make():
        model = shared.value
        table = _table(model) if model.languages else None

        def compute(texts: list) -> list[pa.Array]:
            if table is None:
                return [pa.array([UNKNOWN] * len(texts)), pa.array([0.0] * len(texts)), pa.array([False] * len(texts))]
            sums = _sums(texts, table)
            n = np.maximum(sums[:, -1:], 1)
            h = sums[:, :-1] / n
            best = h.argmin(axis=1)
            low = h[np.arange(len(h)), best]
            share = 1 / np.exp(-(h - low[:, None]) * np.minimum(n, EVIDENCE)).sum(axis=1)
            limit = model.mean[best] + CALIBRATION * model.error[best] / np.sqrt(n[:, 0]) + SLACK
            score = np.where(sums[:, -1] > 0, share * 0.5 ** np.maximum(0, low - limit), 0.0)
            names = [model.languages[j] if m else UNKNOWN for j, m in zip(best, sums[:, -1])]
            return [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(score >= 0.5, pa.bool_())]

        return compute

    return over_texts(docs, keep, FIELDS, make, text, rows=TEXTS)
