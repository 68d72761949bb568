"""Toxic spans by a linear-chain conditional random field.

Labels are per document, so token labels are derived first: in a bounded sample of labelled documents,
words and word beginnings that stand in many different surroundings of toxic documents and in next to
none of the others mark their tokens.  The field has two states; a token's features are its word, its
beginnings and its ending, hashed.  It is trained by gradient ascent on the exact likelihood.  Scoring
runs forward and backward over every whole document; spans are runs of tokens whose marginal is 0.5 or
more, and the document score is a calibrated function of the chance that any token is toxic.

* null, empty and wordless texts have no tokens and the score of a document without toxic ones
* no toxic document to learn from: every score is 0
* long texts: every token is scored; repeated rows get equal scores; other columns, also such as are named
  like results or labels, are never used; an empty table gives no rows
* ties: a score of just 0.5 counts as toxic
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass
from typing import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from .batches import _pieces, known_labels, over_texts, released
from .tokens import FEW_WORDS, Table

SAMPLE = 1000  # labelled documents of each class, in hash order
SAMPLE_CHARS = 20_000  # characters that one of them teaches the field with, about
PIECE = 50  # words that longer texts are cut into for that
HEADS = (3, 4, 5)  # lengths of word beginnings
FEATURES = 1 << 18
ODDS = 25.0  # times more frequent among the words of toxic documents, for a marker,
EVIDENCE = 17.0  # and log-likelihood ratio against equal frequency: chance gives 1 in 10^7 words so much
ROUNDS = 60
RATE = 0.5
DECAY = 1e-4
FLOOR = 0.2  # marginals below it (words the field knows nothing about) do not add up
TOKENS = 100_000  # of the sample that the driver works on at once
TEXTS = 250  # worked on at once: their arrays count against the memory beside the Java heap
STRIDES = 1024  # pieces of a batch's token chain that are worked on side by side
WORD = re.compile(r"\S+")
EDGE = re.compile(r"^\W+|\W+$")


def normal(token: str) -> str:
    return EDGE.sub("", token.lower())


def markers_of(word: str) -> list[str]:
    """What may mark a token: its word, and its beginnings (with a bar behind)."""
    return [word, *[word[:n] + "|" for n in HEADS if len(word) > n]] if word else []


def _number(feature: str) -> int:
    return crc32(feature.encode("utf-8", "replace")) % FEATURES


def features_of(word: str) -> list[int]:
    return [_number(f) for f in (*markers_of(word), "|" + word[-3:])] if word else []


@dataclass
class Model:
    weights: np.ndarray  # per feature: log odds of the toxic state
    bias: float
    step: np.ndarray  # 2 x 2 log potentials of neighbouring states
    slope: float  # document score = logistic(slope * logit(any token) + shift)
    shift: float


def sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(toxic, text) of at most SAMPLE labelled documents of each class; of rows that share an id, the one
    of the greatest text."""
    one = known_labels(docs, labels, "toxic", key, text)
    order = F.xxhash64(F.lit(10), "label_id"), F.col("label_id")
    ids = one.where("label = 1").orderBy(*order).limit(SAMPLE).union(one.where("label = 0").orderBy(*order).limit(SAMPLE))
    usable = docs.select(col(key).alias("key"), col(text).alias("text")).where("text is not null")
    # the ids are at most 2 * SAMPLE
    chosen = usable.join(F.broadcast(ids), F.col("key") == F.col("label_id"))
    return chosen.groupBy("label_id").agg(F.max("label").alias("toxic"), F.max("text").alias("text")).drop("label_id")


def markers(rows: DataFrame) -> set[str]:
    """Words and beginnings that tell toxic from other documents of the sample.

    Frequency is counted in different surroundings (the words before and behind), so that copies of a
    passage count once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch, 1):
                marks, places, toxic = [], [], []
                for label, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = ["", *map(normal, text.split()), ""]
                    for before, word, after in zip(words, words[1:], words[2:]):
                        for mark in markers_of(word):
                            marks.append(mark)
                            places.append(_number(before + " " + after))
                            toxic.append(label)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(marks, pa.string()), pa.array(places, pa.int32()), pa.array(toxic, pa.int32())],
                    names=["mark", "place", "toxic"],
                )

    seen = rows.select("toxic", "text").mapInArrow(run, "mark string, place int, toxic int").distinct()
    by_mark = seen.groupBy("mark").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    bad, good = by_mark.agg(F.sum("bad"), F.sum("good")).first()
    if not bad:
        return set()
    share = bad / (bad + good)
    n, k = F.col("bad") + F.col("good"), F.col("bad")
    evidence = k * F.log(k / (n * share)) + F.when(k < n, (n - k) * F.log((n - k) / (n * (1 - share)))).otherwise(0.0)
    odds = (k / bad) / ((F.col("good") + 0.1) / max(good, 1))
    # the sample is bounded, and with it what passes
    return {r.mark for r in by_mark.where((k > 0) & (odds >= ODDS) & (evidence >= EVIDENCE)).select("mark").collect()}


def shortened(text: str, marks: set[str]) -> str:
    """The text, or of one over SAMPLE_CHARS its pieces with marked words, then others in the order of
    their hashes, until there are so many characters; pieces keep their order."""
    if len(text) <= SAMPLE_CHARS:
        return text
    words = text.split()
    pieces = [words[i : i + PIECE] for i in range(0, len(words), PIECE)]
    plain = [not any(m in marks for w in p for m in markers_of(normal(w))) for p in pieces]
    joined = [" ".join(p) for p in pieces]
    taken, size = [], 0
    for _, _, i in sorted((q, crc32(p.encode("utf-8", "replace")), i) for i, (p, q) in enumerate(zip(joined, plain))):
        if size >= SAMPLE_CHARS:
            break
        taken.append(i)
        size += len(joined[i])
    return " ".join(joined[i] for i in sorted(taken))


def material(rows: DataFrame, marks: set[str]) -> DataFrame:
    """The sample with long texts shortened, in the tasks that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch, 1):
                texts = [shortened(t, marks) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int32()), pa.array(texts, pa.string())], names=["toxic", "text"])

    return rows.select("toxic", "text").mapInArrow(run, "toxic int, text string")


def _chain(gain: np.ndarray, first: np.ndarray, step: np.ndarray, start: float) -> np.ndarray:
    """Ratios of the two states' messages along a chain that begins anew wherever ``first`` is set.

    ratio[t] = gain[t] * (step[0,1] + step[1,1] * ratio[t-1]) / (step[0,0] + step[1,0] * ratio[t-1]).
    Every step is a 2 x 2 matrix; equal pieces of the chain multiply theirs side by side, a short loop
    passes the ratios from piece to piece, and a second run fills them in.
    """
    n = len(gain)
    rows = min(STRIDES, n)
    length = -(-n // rows)
    pad = rows * length - n
    gain = np.concatenate([gain, np.ones(pad)]).reshape(rows, length)
    first = np.concatenate([first, np.zeros(pad, bool)]).reshape(rows, length)
    a = np.where(first, 0.0, gain * step[1, 1])
    b = np.where(first, gain * start, gain * step[0, 1])
    c = np.where(first, 0.0, step[1, 0])
    d = np.where(first, 1.0, step[0, 0])
    p, q, r, s = np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)
    for t in range(length):
        p, q, r, s = a[:, t] * p + b[:, t] * r, a[:, t] * q + b[:, t] * s, c[:, t] * p + d[:, t] * r, c[:, t] * q + d[:, t] * s
        scale = 1 / np.maximum(np.maximum(p, q), np.maximum(r, s))
        p, q, r, s = p * scale, q * scale, r * scale, s * scale
    entry, ratio = np.empty(rows), 1.0
    for i in range(rows):
        entry[i] = ratio
        ratio = (p[i] * ratio + q[i]) / (r[i] * ratio + s[i])
    out = np.empty((rows, length))
    for t in range(length):
        entry = (a[:, t] * entry + b[:, t]) / (c[:, t] * entry + d[:, t])
        out[:, t] = entry
    return out.reshape(-1)[:n]


def marginals(scores: np.ndarray, ends: np.ndarray, step: np.ndarray, pairs: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """Chance of the toxic state at every token, and of every ordered pair of states up to it (n x 4)."""
    n = len(scores)
    if not n:
        return np.zeros(0), np.zeros((0, 4))
    gain, potential = np.exp(np.clip(scores, -30, 30)), np.exp(step)
    full = np.flatnonzero(np.diff(ends))
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[ends[:-1][full]] = True
    last[ends[1:][full] - 1] = True
    forward = _chain(gain, first, potential, 1.0)
    backward = _chain(gain[::-1], last[::-1], potential.T, 1.0)[::-1]  # with the token's own gain
    odds = forward * backward / gain
    if not pairs:
        return odds / (1 + odds), None
    before = np.concatenate([[0.0], forward[:-1]])
    joint = np.stack([np.full(n, potential[0, 0]), potential[0, 1] * backward, potential[1, 0] * before, potential[1, 1] * before * backward], 1)
    joint /= joint.sum(axis=1, keepdims=True)
    joint[first] = 0.0
    return odds / (1 + odds), joint


def any_toxic(p: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Log odds that some token of a document is toxic."""
    clean = np.log1p(-np.minimum(np.where(p < FLOOR, 0.0, p), 1 - 1e-9))
    total = np.concatenate([[0.0], np.cumsum(clean)])
    none = np.minimum(total[ends[1:]] - total[ends[:-1]], 0.0)
    some = -np.expm1(none)
    return np.log(np.maximum(some, 1e-6)) - np.maximum(none, np.log(1e-6))


def _numbered(texts: Iterable[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Sorted distinct words, the number of every token's word, and the ends of the texts: a token is never
    kept as a string of its own."""
    number: dict[str, int] = {}
    places, ends = array("i"), [0]
    for text in texts:
        places.extend(number.setdefault(normal(w), len(number)) for w in text.split())
        ends.append(len(places))
    words = sorted(number)
    rank = np.empty(len(words), np.int32)
    rank[[number[w] for w in words]] = np.arange(len(words))
    return words, rank[np.frombuffer(places, np.int32)], np.array(ends, np.int64)


def _parts(ends: np.ndarray) -> list[tuple[int, int]]:
    """Runs of texts, of at most TOKENS tokens unless a single text has more."""
    out, start = [], 0
    for i in range(1, len(ends)):
        if i - 1 > start and ends[i] - ends[start] > TOKENS:
            out.append((start, i - 1))
            start = i - 1
    return [*out, (start, len(ends) - 1)]


def train(rows: DataFrame) -> Model | None:
    """The field and its calibration from the sample (toxic, text); None without a toxic document.

    Markers are counted in whole texts; what reaches the driver are at most 2 * SAMPLE texts of about
    SAMPLE_CHARS each (a piece of PIECE words is never cut).  The chain is gone through in parts of TOKENS
    tokens, so that its arrays do not add to the driver's memory with the sample.
    """
    marks = markers(rows)
    if not marks:
        return None
    taken = material(rows, marks).collect()
    label = np.array([r.toxic for r in taken], float)
    words, place, ends = _numbered(r.text for r in taken)
    feats = [features_of(w) for w in words]
    owner = np.repeat(np.arange(len(words), dtype=np.int32), list(map(len, feats)))
    flat = np.fromiter((f for fs in feats for f in fs), np.int64, len(owner))
    marked = np.array([any(m in marks for m in markers_of(w)) for w in words])
    del taken, feats
    parts = _parts(ends)
    gold_word, gold_pairs = np.zeros(len(words)), np.zeros(4)
    for a, b in parts:
        at = place[ends[a] : ends[b]]
        gold = marked[at] & (np.repeat(label[a:b], np.diff(ends[a : b + 1])) == 1)
        inner = np.ones(len(at), bool)
        inner[ends[a:b][np.diff(ends[a : b + 1]) > 0] - ends[a]] = False
        before = np.concatenate([[False], gold[:-1]])
        gold_pairs += [(inner & (before == i) & (gold == j)).sum() for i in (0, 1) for j in (0, 1)]
        gold_word += np.bincount(at, weights=gold, minlength=len(words))

    weights, bias, step = np.zeros(FEATURES), -4.0, np.zeros((2, 2))
    past_w, past_b, past_s = np.full(FEATURES, 1e-3), 1e-3, np.full(4, 1e-3)
    for _ in range(ROUNDS):
        word_score = np.bincount(owner, weights=weights[flat], minlength=len(words)) + bias
        off, g_s = gold_word.copy(), gold_pairs - DECAY * step.reshape(-1)
        for a, b in parts:
            at = place[ends[a] : ends[b]]
            p, pairs = marginals(word_score[at], ends[a : b + 1] - ends[a], step)
            off -= np.bincount(at, weights=p, minlength=len(words))
            g_s -= pairs.sum(axis=0)
        g = np.bincount(flat, weights=off[owner], minlength=FEATURES) - DECAY * weights
        g_b = off.sum()
        past_w, past_b, past_s = past_w + g * g, past_b + g_b * g_b, past_s + g_s * g_s
        weights += RATE * g / np.sqrt(past_w)
        bias += RATE * g_b / past_b**0.5
        step += (RATE * g_s / np.sqrt(past_s)).reshape(2, 2)
    word_score = np.bincount(owner, weights=weights[flat], minlength=len(words)) + bias
    odds = np.zeros(len(label))
    for a, b in parts:
        within = ends[a : b + 1] - ends[a]
        odds[a:b] = any_toxic(marginals(word_score[place[ends[a] : ends[b]]], within, step, False)[0], within)
    released()
    slope, shift = _logistic(odds, label)
    return Model(weights.astype(np.float32), float(bias), step, slope, shift)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a penalised one-variable logistic regression."""
    beta, table = np.zeros(2), np.stack([x, np.ones(len(x))], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(table @ beta, -30, 30)))
        hessian = (table * (p * (1 - p))[:, None]).T @ table + np.eye(2) * 0.1
        beta += np.linalg.solve(hessian, table.T @ (y - p) - 0.1 * beta)
    return float(beta[0]), float(beta[1])


FIELDS = [T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(T.StringType()))]


def _spans(text: str, toxic: np.ndarray) -> list[str]:
    """``start:end`` of runs of toxic tokens."""
    out: list[list[int]] = []
    previous = -2
    for i, m in enumerate(WORD.finditer(text)):
        if toxic[i]:
            if previous == i - 1:
                out[-1][1] = m.end()
            else:
                out.append([m.start(), m.end()])
            previous = i
    return [f"{a}:{b}" for a, b in out]


def score(docs: DataFrame, model: Model | None, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` with the score and the toxic spans (code points, end exclusive) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES numbers

    def make():
        model = shared.value

        def values(tokens: list[str]) -> np.ndarray:
            feats = [features_of(normal(w)) for w in tokens]
            owner = np.repeat(np.arange(len(tokens)), list(map(len, feats)))
            flat = np.array([f for fs in feats for f in fs], np.int64)
            return (np.bincount(owner, weights=model.weights[flat], minlength=len(tokens)) + model.bias)[:, None]

        table = Table(values, 1, words=FEW_WORDS)

        def compute(texts: list) -> list[pa.Array]:
            if model is None:
                return [pa.array([0.0] * len(texts)), pa.array([[]] * len(texts), pa.list_(pa.string()))]
            bodies = [t or "" for t in texts]
            values_of, places, ends = table.rows([t.split() for t in bodies])
            p, _ = marginals(values_of[places, 0].astype(np.float64), ends, model.step, False)
            odds = model.slope * any_toxic(p, ends) + model.shift
            toxic = p >= 0.5
            some = np.diff(np.concatenate([[0], np.cumsum(toxic)])[ends]) > 0
            spans = [_spans(t, toxic[a:b]) if s else [] for t, s, a, b in zip(bodies, some, ends, ends[1:])]
            return [pa.array(1 / (1 + np.exp(-np.clip(odds, -30, 30)))), pa.array(spans, pa.list_(pa.string()))]

        return compute

    return over_texts(docs, keep, FIELDS, make, text, rows=TEXTS)
