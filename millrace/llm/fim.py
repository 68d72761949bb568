"""Fill-in-the-middle: texts cut into prefix, middle and suffix and put together in another order.

A batch of texts is one array of bytes.  One scan finds the ends of all tokens and with them the cuts; the
cuts split every text into segments that move as a whole.  A difference array holds, where a segment
begins, by how much its shift differs from that of the segment before; its cumulative sum is the output
shift of every byte, and one scatter builds all outputs.  Restoring finds the three marks in the output,
gets the same shifts from the lengths between them and gathers.

* tokens are ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``: words with the blanks before
  them, and blanks at the end
* cuts and form depend on the key alone: the first four 8-digit groups of sha256 of ``seed:key``; a null
  key counts as an empty one; repeated rows give equal outputs
* null and empty texts, texts that hold a mark, and the rest of RATE are plain: the output is the text
  (empty for null)
* an output that is not plain and lacks its marks in their order is restored as null
* an empty table gives an empty one; kept columns may have any name but those of the result
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from .batches import _pieces
from .bytewise import SPACE, laid_bytes, texts_of

SEED = 42
RATE = 50  # percent of the texts that are transformed
SUFFIX_FIRST = 80  # percent of those in which the suffix comes first
MARKS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ["plain", "psm", "spm"]
MARK = 3  # bytes of a mark


def draws(key: Column, seed: int = SEED) -> list[Column]:
    """The first four 8-digit groups of sha256 of ``seed:key`` as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def token_ends(body: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places behind all tokens of the batch: behind words and at the ends of texts."""
    space = SPACE[body]
    last = np.zeros(len(body), bool)
    last[ends[1:][np.diff(ends) > 0] - 1] = True
    before_space = np.append(space[1:], True)
    return np.flatnonzero(~space & before_space | last) + 1


def mark_places(body: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, text, letter) of every mark inside a text."""
    if len(body) < MARK:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
    opens = np.flatnonzero(body[:-2] == ord("<"))
    opens = opens[(body[opens + 2] == ord(">")) & np.isin(body[opens + 1], list(map(ord, MARKS)))]
    owner = np.searchsorted(ends, opens, "right") - 1
    inside = opens + MARK <= ends[owner + 1]
    return opens[inside], owner[inside], body[opens[inside] + 1]


def _moves(kinds: np.ndarray, a: np.ndarray, m: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Shift of prefix, middle and suffix of every text inside its own text, by their lengths."""
    zero = np.zeros_like(a)
    psm = np.stack([zero + MARK, s + 3 * MARK, 2 * MARK - m], axis=1)
    spm = np.stack([s + 2 * MARK, s + 3 * MARK, MARK - a - m], axis=1)
    return np.where((kinds == PSM)[:, None], psm, np.where((kinds == SPM)[:, None], spm, 0))


def _shifts(starts: np.ndarray, out_starts: np.ndarray, kinds: np.ndarray, a: np.ndarray, m: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Output place less text place of every byte of the batch, from a difference array."""
    moves = (_moves(kinds, a, m, s) + (out_starts - starts)[:, None]).ravel()
    begins = np.stack([starts, starts + a, starts + a + m], axis=1).ravel()
    steps = np.zeros(int(starts[-1] + a[-1] + m[-1] + s[-1]) + 1 if len(a) else 1, np.int64)
    np.add.at(steps, begins, np.diff(moves, prepend=0))
    return np.cumsum(steps[:-1])


def _mark_starts(out_starts: np.ndarray, kinds: np.ndarray, a: np.ndarray, m: np.ndarray, s: np.ndarray) -> dict[str, np.ndarray]:
    """Places of the marks of the transformed texts in the output."""
    psm = {"P": np.zeros_like(a), "S": MARK + a, "M": 2 * MARK + a + s}
    spm = {"S": np.zeros_like(a), "P": MARK + s, "M": 2 * MARK + a + s}
    some = kinds != PLAIN
    return {x: (out_starts + np.where(kinds == PSM, psm[x], spm[x]))[some] for x in MARKS}


def scatter(body: np.ndarray, ends: np.ndarray, cuts: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, ends) of the outputs; ``cuts`` are the two cut places of every text."""
    starts = ends[:-1]
    a, m, s = cuts[:, 0] - starts, cuts[:, 1] - cuts[:, 0], ends[1:] - cuts[:, 1]
    out_ends = np.concatenate([[0], np.cumsum(np.diff(ends) + np.where(kinds == PLAIN, 0, 3 * MARK))])
    out = np.empty(int(out_ends[-1]), np.uint8)
    out[np.arange(len(body)) + _shifts(starts, out_ends[:-1], kinds, a, m, s)] = body
    for x, places in _mark_starts(out_ends[:-1], kinds, a, m, s).items():
        for i, byte in enumerate(MARKS[x]):
            out[places + i] = byte
    return out, out_ends


def gather(out: np.ndarray, out_ends: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, ends, damaged) of the texts behind the outputs."""
    n = len(kinds)
    place, owner, letter = mark_places(out, out_ends)
    at = {x: np.full(n, -1) for x in MARKS}
    marks = np.bincount(owner, minlength=n)
    for x in MARKS:
        at[x][owner[letter == ord(x)]] = place[letter == ord(x)]
    begin, end = out_ends[:-1], out_ends[1:]
    first, second = np.where(kinds == PSM, at["P"], at["S"]), np.where(kinds == PSM, at["S"], at["P"])
    whole = (marks == 3) & (first == begin) & (second > first) & (at["M"] > second)
    damaged = (kinds != PLAIN) & ~whole
    parts = np.stack([second - first, at["M"] - second, end - at["M"]], axis=1) - MARK
    a, s, m = np.where(kinds == PSM, parts[:, 0], parts[:, 1]), np.where(kinds == PSM, parts[:, 1], parts[:, 0]), parts[:, 2]
    plain = kinds == PLAIN
    size = np.where(damaged, 0, np.where(plain, end - begin, a + m + s))
    a, m, s = (np.where(plain | damaged, x, y) for x, y in ((size, a), (0, m), (0, s)))
    ends = np.concatenate([[0], np.cumsum(size)])
    shifts = _shifts(ends[:-1], begin, np.where(damaged, PLAIN, kinds), a, m, s)
    return out[np.arange(int(ends[-1])) + shifts], ends, damaged


def transformed(texts: pa.Array, numbers: np.ndarray, rate: int = RATE, suffix_first: int = SUFFIX_FIRST):
    """(output bytes, output ends, kinds, n, prefix characters, middle characters) of a batch."""
    body, ends = laid_bytes(texts)
    behind = token_ends(body, ends)
    before = np.searchsorted(behind, ends, "right")
    n = np.diff(before)
    units = np.sort(numbers[:, :2] % (n + 1)[:, None], axis=1)
    last = np.concatenate([[0], behind])  # the place behind token 0, 1, ... of the batch
    cuts = np.where(units == 0, ends[:-1, None], last[before[:-1, None] + units])
    kinds = np.where(numbers[:, 3] % 100 < suffix_first, SPM, PSM)
    held = np.zeros(len(n), bool)
    held[mark_places(body, ends)[1]] = True
    kinds[(np.diff(ends) == 0) | held | (numbers[:, 2] % 100 >= rate)] = PLAIN
    letters = np.concatenate([[0], np.cumsum((body & 0xC0) != 0x80)])
    sizes = letters[cuts[:, 0]] - letters[ends[:-1]], letters[cuts[:, 1]] - letters[cuts[:, 0]]
    return *scatter(body, ends, cuts, kinds), kinds, n, *sizes


def transform(docs: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """``keep``, n (tokens), form, prefix_chars, middle_chars (null if plain), output."""
    picked = docs.select(*[col(c).alias(c) for c in keep], *draws(col(key), seed), col(text).alias("__text"))
    fields = T._parse_datatype_string("n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    width = len(keep)
    schema = T.StructType([*picked.schema.fields[:width], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch, width + 4):
                numbers = np.stack([c.to_numpy() for c in part.columns[width:-1]], axis=1)
                out, ends, kinds, n, prefix, middle = transformed(part.column(width + 4), numbers)
                plain = kinds == PLAIN
                new = [
                    pa.array(n), pa.DictionaryArray.from_arrays(kinds, FORMS).cast(pa.string()),
                    pa.array(prefix, mask=plain), pa.array(middle, mask=plain), texts_of(out, ends),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[:width], *new], names=schema.names)
        pa.default_memory_pool().release_unused()

    return picked.mapInArrow(run, schema)


def restore(outputs: DataFrame, keep: list[str], output: str = "output", form: str = "form") -> DataFrame:
    """``keep`` and the restored text; an unknown or null form counts as plain."""
    kind = F.when(col(form) == "psm", PSM).when(col(form) == "spm", SPM).otherwise(PLAIN)
    picked = outputs.select(*[col(c).alias(c) for c in keep], kind.alias("__kind"), col(output).alias("__text"))
    width = len(keep)
    schema = T.StructType([*picked.schema.fields[:width], T.StructField("restored", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch, width + 1):
                body, ends, damaged = gather(*laid_bytes(part.column(width + 1)), part.column(width).to_numpy())
                yield pa.RecordBatch.from_arrays([*part.columns[:width], texts_of(body, ends, damaged)], names=schema.names)
        pa.default_memory_pool().release_unused()

    return picked.mapInArrow(run, schema)
