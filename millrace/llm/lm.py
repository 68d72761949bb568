"""Scoring texts by an interpolated modified Kneser-Ney n-gram model that is counted in Spark.

Words become numbers: the rank of their 64-bit hash among all words of the training texts.  Every task adds up
its n-grams and sends them, sorted and compressed, to buckets by a hash of the n-gram, so that a frequent
word never fills one bucket.  A bucket adds them up, writes its part of the model and sends on what the other
parts need: distinct continuations per context, and the n-grams without their first word, each counted once
per word in front.  So the levels are made one after the other in one job, from the longest to single words.

The model is files of sorted hash arrays with their numbers, one pair per level and bucket, in the shared
folder.  Scoring tasks map them into memory and look up the distinct n-grams of a batch in sorted order;
nothing of the model is sent to a task or kept on the driver but the sizes of the files.

With c the count of an n-gram (at lower levels: the number of distinct words in front), D the discount for
counts of 1, 2 and from 3, by counts of counts:
``p(w | h) = max(c - D, 0) / c(h) + (D1 N1 + D2 N2 + D3 N3) / c(h) * p(w | shorter h)``,
and below single words the uniform distribution over all words and one unknown.

* tokens: words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, and one end behind every text
* null and empty texts are one end; texts of any length count whole; repeated rows count each time
* nothing to learn from: every probability is that of the only outcome, the unknown: 1
* counts of counts that leave a discount undefined: 0.5, 1 and 1.5
* kept columns may have any name but those of the result

The shared folder must be a mounted file system (``spark.checkpoint.dir`` a path or file: address), or the files
could not be mapped.  Tasks that run again write the same files again, each by a rename.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from dataclasses import dataclass
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from ..functions.lineage import shared_folder
from .batches import _pieces
from .bytewise import laid_bytes, word_hashes
from .tokens import stir

ORDER = 2
PENDING = 2_000_000  # n-grams of a task before they are added up
HELD = 6_000_000  # distinct n-grams of a task before they are sent
BLOCK = 500_000  # tokens whose n-grams are looked up at once
FALLBACK = (0.5, 1.0, 1.5)
END = np.uint64(0x5851F42D4C957F2D)  # hash of the token behind every text
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_ROW = "kind string, bucket int, n bigint, body array<binary>"


@dataclass
class Model:
    folder: str
    order: int
    sizes: dict[str, np.ndarray]  # kind of file -> entries per bucket
    words: int
    tokens: int
    discounts: dict[int, tuple[float, ...]]  # by level
    base: tuple[int, int, int, int]  # single words: sum of counts, words of count 1, 2, from 3


def keys_of(ids: np.ndarray) -> np.ndarray:
    """64-bit hash of every row of word numbers."""
    keys = np.zeros(len(ids), np.uint64)
    for column in ids.T:
        keys = stir(keys * _FACTOR + column.astype(np.uint64) + np.uint64(1))
    return keys


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of equal width: sorted keys are in sorted buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places of the distinct keys, sorted by key, and the sums of their counts, row by row)."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(keys) else np.zeros(0, np.int64)
    sums = np.add.reduceat(counts[order], first, axis=0) if len(keys) else counts
    return ranked[first], order[first], sums


class _Tally:
    """Counts of a task's rows of numbers, added up whenever PENDING have come."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pending = self.held = 0

    def add(self, keys: np.ndarray, ids: np.ndarray) -> None:
        self.parts.append((keys, ids, np.ones(len(keys), np.int64)))
        self.pending += len(keys)
        if self.pending > PENDING:
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        if not self.parts:
            return None
        keys, ids, counts = (np.concatenate(c) for c in zip(*self.parts))
        keys, at, counts = _added(keys, counts)
        self.parts, self.pending, self.held = [(keys, ids[at], counts)], 0, len(keys)
        return self.parts[0]


def _squeezed(column: np.ndarray) -> bytes:
    """Differences of neighbours, byte by byte of the numbers, compressed."""
    steps = np.diff(column.astype(np.uint64), prepend=np.uint64(0))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return pa.Codec("zstd", 1).compress(planes, asbytes=True)


def _spread(body: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd").decompress(body, 8 * n), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel().cumsum(dtype=np.uint64)


def _rows(kind: str, keys: np.ndarray, columns: list[np.ndarray], buckets: int) -> Iterator[pa.RecordBatch]:
    """A row per bucket with its part of the columns, in the order of the first columns, which keeps them small."""
    bucket = _bucket(keys, buckets)
    order = np.lexsort((*reversed(columns), bucket))
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(ends)):
        these = order[ends[b] : ends[b + 1]]
        yield _row(kind, int(b), len(these), [_squeezed(c[these]) for c in columns])


def _row(kind: str, bucket: int, n: int, body: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([kind]), pa.array([bucket], pa.int32()), pa.array([n], pa.int64()), pa.array([body], pa.list_(pa.binary()))],
        names=["kind", "bucket", "n", "body"],
    )


def _gathered(table: pa.Table) -> list[np.ndarray]:
    """Columns of all rows of one kind and bucket."""
    each = [[_spread(c, n) for c in body] for n, body in zip(table["n"].to_pylist(), table["body"].to_pylist())]
    return [np.concatenate(c) for c in zip(*each)]


def _written(folder: str, kind: str, bucket: int, keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    """Write a part of the model; the row that says so holds its size and its counts of counts."""
    for name, array in (("keys", keys), ("values", values.astype(np.min_scalar_type(int(values.max()))))):
        place = f"{folder}/{kind}-{bucket}-{name}.npy"
        with open(f"{place}.{uuid.uuid4().hex}", "wb") as f:
            np.save(f, array)
        os.replace(f.name, place)
    counts = values[:, 0]
    said = {"name": kind, "sum": int(counts.sum()), "of": [int((counts == i).sum()) for i in range(1, 5)]}
    return _row("written", bucket, len(keys), [json.dumps(said).encode()])


_MAPPED: dict[str, np.ndarray] = {}  # files that this worker has mapped, of one model


def _mapped(place: str) -> np.ndarray:
    if place not in _MAPPED:
        if _MAPPED and os.path.dirname(next(iter(_MAPPED))) != os.path.dirname(place):
            _MAPPED.clear()
        _MAPPED[place] = np.load(place, mmap_mode="r")
    return _MAPPED[place]


def _found(folder: str, kind: str, sizes: np.ndarray, keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(place among all keys of the kind or -1, numbers or zeros) of sorted keys."""
    place, values = np.full(len(keys), -1, np.int64), np.zeros((len(keys), width), np.int64)
    before = np.concatenate([[0], np.cumsum(sizes)])
    ends = np.searchsorted(_bucket(keys, len(sizes)), np.arange(len(sizes) + 1))
    for b in np.flatnonzero((np.diff(ends) > 0) & (sizes > 0)):
        some = slice(ends[b], ends[b + 1])
        own = _mapped(f"{folder}/{kind}-{b}-keys.npy")
        at = np.minimum(np.searchsorted(own, keys[some]), len(own) - 1)
        hit = own[at] == keys[some]
        place[some][hit] = before[b] + at[hit]
        values[some][hit] = _mapped(f"{folder}/{kind}-{b}-values.npy")[at[hit]]
    return place, values


def _looked_up(model: Model, kind: str, keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    distinct, back = np.unique(keys, return_inverse=True)
    place, values = _found(model.folder, kind, model.sizes[kind], distinct, width)
    return place[back], values[back]


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens with the end of every text, a 0 and the ends of the texts)."""
    words, ends = word_hashes(*laid_bytes(texts))
    return np.insert(words, ends[1:], END), ends + np.arange(len(ends))


def _padded(ids: np.ndarray, ends: np.ndarray, order: int, start: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers with order - 1 starts in front of every text, places of the texts' own tokens)."""
    out = np.insert(ids, np.repeat(ends[:-1], order - 1), start) if order > 1 else ids
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    return out, np.arange(len(ids)) + (order - 1) * (text + 1)


def _local(folder: str) -> str:
    place = re.sub(r"^file:/+", "/", folder)
    if "://" in place:
        raise ValueError(f"the model's files are memory-mapped: spark.checkpoint.dir must be a mounted folder, not {folder}")
    return place


def _said(rows: pa.Table, buckets: int) -> dict[str, tuple[np.ndarray, int, list[int]]]:
    """Per kind of file: entries per bucket, sum of the counts, counts of counts."""
    out: dict[str, tuple[np.ndarray, int, list[int]]] = {}
    for r in rows.to_pylist():
        said = json.loads(r["body"][0])
        sizes, total, of = out.get(said["name"], (np.zeros(buckets, np.int64), 0, [0] * 4))
        sizes[r["bucket"]] = r["n"]
        out[said["name"]] = sizes, total + said["sum"], [a + b for a, b in zip(of, said["of"])]
    return out


def _discounts(of: list[int]) -> tuple[float, ...]:
    """The modified discounts for counts of 1, 2 and from 3."""
    if min(of) == 0:
        return FALLBACK
    y = of[0] / (of[0] + 2 * of[1])
    found = tuple(i - (i + 1) * y * of[i] / of[i - 1] for i in (1, 2, 3))
    return found if all(0 <= d <= i for i, d in enumerate(found, 1)) else FALLBACK


def _words(docs: DataFrame, buckets: int, folder: str) -> dict:
    """Write all distinct words with their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()
        for batch in batches:
            for part in _pieces(batch, 0):
                hashes, _ = _tokens(part.column(0))
                tally.add(hashes, np.zeros((len(hashes), 0), np.int64))
                if tally.held > HELD:
                    yield from send(tally)
                    tally = _Tally()
        yield from send(tally)
        pa.default_memory_pool().release_unused()

    def send(tally: _Tally) -> Iterator[pa.RecordBatch]:
        if total := tally.total():
            yield from _rows("words", total[0], [total[0], total[2]], buckets)

    def merge(table: pa.Table) -> pa.Table:
        keys, counts = _gathered(table)
        keys, _, counts = _added(keys, counts.astype(np.int64))
        return pa.Table.from_batches([_written(folder, "words", table["bucket"][0].as_py(), keys, counts[:, None])])

    return _said(docs.mapInArrow(count, _ROW).groupBy("kind", "bucket").applyInArrow(merge, _ROW).toArrow(), buckets)


def _ngrams(docs: DataFrame, model: Model, buckets: int) -> dict:
    """Write all levels: n-grams with their counts, and contexts with what follows them."""
    folder, order = model.folder, model.order

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()
        for batch in batches:
            for part in _pieces(batch, 0):
                hashes, ends = _tokens(part.column(0))
                ids, own = _padded(_looked_up(model, "words", hashes, 1)[0], ends, order, model.words)
                for i in range(0, len(own), BLOCK):
                    grams = np.stack([ids[own[i : i + BLOCK] - k] for k in range(order - 1, -1, -1)], axis=1)
                    tally.add(keys_of(grams), grams)
                if tally.held > HELD:
                    yield from send(tally)
                    tally = _Tally()
        yield from send(tally)
        pa.default_memory_pool().release_unused()

    def send(tally: _Tally) -> Iterator[pa.RecordBatch]:
        if total := tally.total():
            yield from _rows(f"grams{order}", total[0], [*total[1].T, total[2]], buckets)

    def level(k: int) -> Callable[[pa.Table], pa.Table]:
        def merge(table: pa.Table) -> pa.Table:
            kind, bucket = table["kind"][0].as_py(), table["bucket"][0].as_py()
            if kind == f"grams{k}":
                return pa.Table.from_batches(list(grams(bucket, _gathered(table))))
            if kind.startswith("contexts"):
                *ids, a, b, c, d = _gathered(table)
                keys, _, sums = _added(keys_of(np.stack(ids, axis=1)), np.stack([a, b, c, d], axis=1).astype(np.int64))
                return pa.Table.from_batches([_written(folder, kind, bucket, keys, sums)])
            return table

        def grams(bucket: int, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            ids = np.stack(columns[:-1], axis=1)
            keys, at, counts = _added(keys_of(ids), columns[-1].astype(np.int64))
            ids = ids[at]
            yield _written(folder, f"grams{k}", bucket, keys, counts[:, None])
            if k > 1:
                kinds = np.stack([counts, counts == 1, counts == 2, counts > 2], axis=1).astype(np.int64)
                keys, at, sums = _added(keys_of(ids[:, :-1]), kinds)
                yield from _rows(f"contexts{k}", keys, [*ids[at, :-1].T, *sums.T], buckets)
                keys, at, n = _added(keys_of(ids[:, 1:]), np.ones(len(ids), np.int64))
                yield from _rows(f"grams{k - 1}", keys, [*ids[at, 1:].T, n], buckets)

        return merge

    rows = docs.mapInArrow(count, _ROW)
    for k in range(order, 0, -1):
        rows = rows.groupBy("kind", "bucket").applyInArrow(level(k), _ROW)
    return _said(rows.where("kind = 'written'").toArrow(), buckets)


def train(docs: DataFrame, text: str = "text", order: int = ORDER) -> Model:
    """Count and write the model of all texts."""
    docs = docs.select(col(text).alias("text"))
    folder = _local(shared_folder(docs.sparkSession))
    os.makedirs(folder)
    size = docs.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    buckets = max(8, min(256, size >> 18), size >> 24)
    words = _words(docs, buckets, folder).get("words", (np.zeros(buckets, np.int64), 0, []))
    model = Model(folder, order, {"words": words[0]}, int(words[0].sum()), words[1], {}, (0, 0, 0, 0))
    if model.words:
        for kind, (sizes, total, of) in _ngrams(docs, model, buckets).items():
            model.sizes[kind] = sizes
            if kind.startswith("grams"):
                model.discounts[int(kind[5:])] = _discounts(of)
            if kind == "grams1":
                model.base = total, of[0], of[1], int(sizes.sum()) - of[0] - of[1]
    return model


def log_probabilities(model: Model, ids: np.ndarray, own: np.ndarray) -> np.ndarray:
    """log10 probability of the tokens at ``own`` after those before them."""
    p = np.full(len(own), 1.0 / (model.words + 1))
    if not model.words:
        return np.log10(p)
    for k in range(1, model.order + 1):
        grams = np.stack([ids[own - i] for i in range(k - 1, -1, -1)], axis=1)
        counts = _looked_up(model, f"grams{k}", keys_of(grams), 1)[1][:, 0]
        if k == 1:
            totals = np.tile(np.array(model.base), (len(own), 1))
        else:
            totals = _looked_up(model, f"contexts{k}", keys_of(grams[:, :-1]), 4)[1]
        known = totals[:, 0] > 0
        discounts = np.array([0.0, *model.discounts[k]])
        left = totals[:, 1:] @ discounts[1:]
        own_part = np.maximum(counts - discounts[np.minimum(counts, 3)], 0)
        p = np.where(known, (own_part + left * p) / np.maximum(totals[:, 0], 1), p)
    return np.log10(p)


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, n_tokens, n_known, base_score (add-one single words), score (log10 probability), perplexity."""
    picked = docs.select(*[col(c).alias(c) for c in keep], col(text).alias("__text"))
    fields = "n_tokens bigint, n_known bigint, base_score double, score double, perplexity double"
    schema = T.StructType([*picked.schema.fields[:-1], *T._parse_datatype_string(fields).fields])
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch, width):
                hashes, ends = _tokens(part.column(width))
                if not part.num_rows:
                    continue
                place, counts = _looked_up(model, "words", hashes, 1)
                base = np.log10((counts[:, 0] + 1) / (model.tokens + model.words + 1))
                ids, own = _padded(np.where(place < 0, model.words + 1, place), ends, model.order, model.words)
                each = [log_probabilities(model, ids, own[i : i + BLOCK]) for i in range(0, len(own), BLOCK)]
                total = np.add.reduceat(np.concatenate(each), ends[:-1])
                n = np.diff(ends)
                new = [n, np.add.reduceat((place >= 0).astype(np.int64), ends[:-1]), np.add.reduceat(base, ends[:-1]), total, 10 ** (-total / n)]
                yield pa.RecordBatch.from_arrays([*part.columns[:width], *map(pa.array, new)], names=schema.names)
        pa.default_memory_pool().release_unused()

    return picked.mapInArrow(run, schema)
