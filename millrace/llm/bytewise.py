"""All bytes of a batch of texts in one array."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .tokens import stir

SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256))

SECTION = 4_000_000  # bytes whose words are hashed at once
_VALUE = stir(LOWER.astype(np.uint64) + np.uint64(1))  # per byte, A-Z as a-z
_BASE = np.uint64(0xD1342543DE82EF95)


def laid_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts behind each other, a 0 and the ends of the texts); null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    places = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    body = texts.buffers()[2]
    if body is None or not body.size:
        return np.zeros(0, np.uint8), places - places[0]
    return np.frombuffer(body, np.uint8)[places[0] : places[-1]], places - places[0]


def texts_of(body: np.ndarray, ends: np.ndarray, null: np.ndarray | None = None) -> pa.Array:
    """The inverse of :func:`laid_bytes`."""
    made = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(body)).cast(pa.string())
    return made if null is None or not null.any() else pc.if_else(pa.array(null), pa.scalar(None, pa.string()), made)


def word_hashes(body: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, a 0 and the number of words up to the end of every text).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case: a polynomial in random values of the bytes,
    stirred with the length.
    """
    first = np.zeros(len(body), bool)
    first[ends[:-1][np.diff(ends) > 0]] = True
    out, starts_at = [], []
    for lo, hi in _sections(body):
        some = np.flatnonzero(~SPACE[body[lo:hi]])
        if not some.size:
            continue
        begins = np.ones(some.size, bool)
        begins[1:] = (np.diff(some) > 1) | first[lo:hi][some[1:]]
        starts = np.flatnonzero(begins)
        lengths = np.diff(np.append(starts, some.size))
        place = np.arange(some.size) - np.repeat(starts, lengths)
        powers = np.concatenate([np.ones(1, np.uint64), np.full(int(lengths.max()) - 1, _BASE)]).cumprod(dtype=np.uint64)
        sums = np.add.reduceat(_VALUE[body[lo:hi][some]] * powers[place], starts, dtype=np.uint64)
        out.append(stir(sums + stir(lengths.astype(np.uint64))))
        starts_at.append(some[starts] + lo)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    return np.concatenate(out), np.searchsorted(np.concatenate(starts_at), ends, "left")


def _sections(body: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of a long array behind white space, about SECTION apart."""
    lo = 0
    while lo < len(body):
        hi = min(lo + SECTION, len(body))
        while hi < len(body) and not SPACE[body[hi - 1]]:
            gap = np.flatnonzero(SPACE[body[hi : hi + SECTION]])
            hi = hi + int(gap[0]) + 1 if gap.size else min(hi + SECTION, len(body))
        yield lo, hi
        lo = hi
