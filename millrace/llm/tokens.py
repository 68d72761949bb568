"""Vectorised values of the words of many texts."""

from __future__ import annotations

from itertools import chain
from typing import Sequence

import numpy as np

from .batches import Memo

FEW_WORDS = 75_000  # that a table may remember where workers must stay small
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_STIR = np.uint64(0xD6E8FEB86659FD93)


def stir(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over the whole range, one to one."""
    h = (h ^ (h >> np.uint64(32))) * _STIR
    h = (h ^ (h >> np.uint64(29))) * _FACTOR
    return h ^ (h >> np.uint64(32))


def gram_hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 .. order, hashes of the n codes that end at every place (wrong where fewer precede)."""
    codes = codes.astype(np.uint64)
    out = [codes + np.uint64(1)]
    for n in range(2, order + 1):
        before = np.concatenate([np.zeros(1, np.uint64), out[-1][:-1]])
        out.append(before * _FACTOR + codes + np.uint64(n))
    return [stir(h) for h in out]


def laid_out(words: Sequence[bytes | str], dtype) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words behind each other, and every word's length."""
    if dtype is np.uint8:
        flat = np.frombuffer(b"".join(words), np.uint8)
    else:
        flat = np.frombuffer("".join(words).encode("utf-32-le", "replace"), np.uint32)
    return flat, np.fromiter(map(len, words), np.int64, len(words))


class Table:
    """Rows of numbers per word, made once per word and worker."""

    def __init__(self, make, width: int, dtype=np.float32, words: int = 150_000):
        self.width, self.dtype = width, dtype
        self.memo = Memo(lambda words: [r.tobytes() for r in np.ascontiguousarray(make(words), dtype)], words)

    def rows(self, texts: Sequence[Sequence]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(values of the distinct words, number of the distinct word at every place, ends of the texts)."""
        distinct = set(chain.from_iterable(texts))
        self.memo.learn(distinct)
        order = list(distinct)
        values = np.frombuffer(b"".join(map(self.memo.__getitem__, order)), self.dtype).reshape(-1, self.width)
        number = dict(zip(order, range(len(order))))
        ends = np.cumsum([0, *map(len, texts)])
        places = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int32, int(ends[-1]))
        return values, places, ends


def per_text(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` between the ends; zeros for texts without a row."""
    out = np.zeros((len(ends) - 1, values.shape[1]))
    full = np.flatnonzero(np.diff(ends))
    if full.size:
        out[full] = np.add.reduceat(values, ends[:-1][full], axis=0, dtype=np.float64)
    return out
