"""Best-two-fit packing of token sequences.

Only lengths matter for the packing, so the plan is made from their histogram, which has at most
``capacity`` entries whatever the input.  A bin is filled greedily with the longest document that fits;
then its smallest document gives way to two unpacked ones if a pair fits the widened gap more tightly.
Since every choice depends on which lengths are left, a filled bin is repeated as often as its lengths
allow: the plan lists distinct bins and how many there are of each, and equals packing bin by bin.

Ranks within a length come from counters of the tokenising tasks plus the totals of earlier tasks, so
no group is ever gathered.  Tokens are written once to the shared folder and read once.

* null and empty texts: one piece that holds the end token only
* documents over the capacity: pieces of full capacity behind a first piece that may be shorter
* repeated rows are packed as separate documents; an empty table gives no pieces
"""

from __future__ import annotations

import json
import os
from array import array
from itertools import chain, islice
from typing import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from ..functions.columns import col
from .batches import Memo, _pieces, blocks, chunk_words, released, shuffled, small_batches, stored

CAPACITY = 2048
END = 0  # token behind every document
SMALL_OFFSETS = 500_000  # (task, length) totals that may be broadcast, 16 bytes each

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def _merge_ranks(definition: dict) -> dict[bytes, int] | None:
    """Token bytes and ids, if the tokenizer is byte-level BPE whose ids follow the order of its merges.

    Such a tokenizer is fully described by them and the usual pattern; any other gives None.
    """
    model, before = definition["model"], definition.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or definition.get("normalizer") or before.get("type") != "ByteLevel":
        return None
    if before.get("add_prefix_space") or not before.get("use_regex", True):
        return None
    if any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")):
        return None
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in byte_of.values())}
    named = {t["content"] for t in definition.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in named}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"].get(a + b, -1) for a, b in pairs]
    single = max((i for token, i in ranks.items() if len(token) == 1), default=-1)
    ordered = made == sorted(made) and min(made, default=0) > single
    return ranks if ordered and len(ranks) == len(made) + 256 else None


def _in_one_call(encode: Callable[[str], list[int]], keys: list[str]) -> list[bytes]:
    """Ids of every key.  Keys without white space inside are laid out as lines of one text: a line end
    in front of a word or its space is matched alone, so its token shows where the next key begins."""
    lines = [i for i, k in enumerate(keys) if len(k.split()) == 1 and not k[-1].isspace() and not k[1:2].isspace()]
    out: list = [None] * len(keys)
    mark = encode("\n")
    if len(mark) == 1 and lines:
        ids = np.array(encode("\n".join([keys[i] for i in lines])), np.uint32)
        ends = np.append(np.flatnonzero(ids == mark[0]), len(ids)).tolist()
        if len(ends) == len(lines):  # always, unless the pattern matches line ends with what precedes them
            body, start = ids.astype("<u4").tobytes(), 0
            for i, end in zip(lines, ends):
                out[i] = body[4 * start : 4 * end]
                start = end + 1
    return [array("I", encode(k)).tobytes() if o is None else o for k, o in zip(keys, out)]


def _ranked(text: str) -> Callable[[str], list[int]] | None:
    """Where merge ranks say the same as the tokenizer file, the encoder of the library made for those: the general
    library keeps offsets and strings of every token, most of its time."""
    if ranks := _merge_ranks(json.loads(text)):
        pattern = public_tokenizers.PATTERN
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return None


def _coder(text: str) -> Callable[[list[str]], list[bytes]]:
    """Ids of chunks as bytes."""
    if encode := _ranked(text):
        return lambda keys: _in_one_call(encode, keys)
    tokenizer = Tokenizer.from_str(text)
    tokenizer.encode_special_tokens = True
    return lambda keys: [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(keys, add_special_tokens=False)]


def _text_coder(text: str) -> Callable[[list[str]], list[bytes]]:
    """Ids of whole texts as bytes.

    The encoder of merge ranks takes texts as they are, long ones in blocks: a word takes it less time than
    cutting the text there and looking the word up, and words met once take half.  The general library is
    asked once per word.
    """
    if encode := _ranked(text):
        return lambda texts: [b"".join([array("I", encode(b)).tobytes() for b in blocks(t)]) for t in texts]
    coder = _coder(text)
    first, memo = Memo(coder), Memo(lambda words: coder([" " + w for w in words]))

    def ids(texts: list[str]) -> list[bytes]:
        cut = [chunk_words(t) for t in texts]
        heads = ["".join(words[:1]) for words in cut]
        first.learn(set(heads))
        memo.learn(set(chain.from_iterable(islice(words, 1, None) for words in cut)))
        return [first[head] + b"".join(map(memo.__getitem__, islice(words, 1, None))) for head, words in zip(heads, cut)]

    return ids


def tokenised(docs: DataFrame, vocabulary: str, keep: list[str], text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``keep``, piece, start, length, ids (little-endian unsigned 32-bit numbers)
    and ``task``, ``nth``: the piece is the nth of its length that the task made.

    ``vocabulary`` is the path of a tokenizer file; it is read on the driver and sent along.
    """
    with open(vocabulary, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    small_batches(docs.sparkSession)
    picked = docs.select(*[col(c).alias(c) for c in keep], col(text).alias("__text"))
    fields = "piece int, start bigint, length bigint, ids binary, task int, nth bigint"
    schema = T.StructType([*picked.schema.fields[:-1], *T._parse_datatype_string(fields).fields])
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, task = np.array([END], "<u4").tobytes(), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)

        released()
        coder = _text_coder(shared.value)
        for batch in batches:
            for part in _pieces(batch, width):
                rows, made = [], []
                for row, ids in enumerate(coder([t or "" for t in part.column(width).to_pylist()])):
                    ids += end
                    n, start = len(ids) // 4, 0
                    size = n % capacity or capacity
                    for piece in range(-(-n // capacity)):
                        rows.append(row)
                        made.append((piece, start, size, ids[4 * start : 4 * (start + size)], task, seen[size]))
                        seen[size] += 1
                        start, size = start + size, capacity
                kept = part.take(pa.array(rows, pa.int32())).columns[:width] if rows else part.slice(0, 0).columns[:width]
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
                new = [pa.array(v, k) for v, k in zip(zip(*made), kinds)] if made else [pa.array([], k) for k in kinds]
                yield pa.RecordBatch.from_arrays([*kept, *new], names=schema.names)
        coder = batch = part = rows = made = kept = new = None  # or the worker would keep them while it waits
        released()

    return picked.mapInArrow(run, schema)


def plan(counts: np.ndarray) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins for ``counts[length]`` documents of each length: (how many bins, [(length, documents in each)])."""
    left = np.array(counts, np.int64)
    capacity = len(left) - 1
    left[0] = 0
    bins: list[tuple[int, list[tuple[int, int]]]] = []
    while (present := np.flatnonzero(left)).size:
        used: dict[int, int] = {}
        gap, below = capacity, present
        while fit := int(np.searchsorted(below, gap, "right")):
            size = int(below[fit - 1])
            used[size] = n = min(int(left[size]), gap // size)
            gap -= n * size
            below = below[: fit - 1]  # this length is used up or fits no longer
        if gap:
            _two_for_one(left, used, gap)
        times = min(int(left[s]) // n for s, n in used.items())
        for s, n in used.items():
            left[s] -= times * n
        bins.append((times, sorted(used.items(), reverse=True)))
    return bins


def _two_for_one(left: np.ndarray, used: dict[int, int], gap: int) -> None:
    """Swap the bin's smallest document for the two unpacked ones that fill most of its widened gap."""
    smallest = min(used)
    room = gap + smallest
    free = left[: room + 1].copy()
    for s, n in used.items():
        if s <= room:
            free[s] -= n
    sizes = np.flatnonzero(free > 0)
    if not sizes.size:
        return
    partner = np.searchsorted(sizes, room - sizes, "right") - 1
    alone = (partner >= 0) & (sizes[partner] == sizes) & (free[sizes] < 2)
    partner = np.where(alone, partner - 1, partner)
    sums = np.where(partner >= 0, sizes + sizes[partner], 0)
    best = int(sums.argmax())
    if sums[best] <= smallest:
        return
    used[smallest] -= 1
    if not used[smallest]:
        del used[smallest]
    for s in (int(sizes[best]), int(sizes[partner[best]])):
        used[s] = used.get(s, 0) + 1


def _runs(bins: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, documents per bin, first bin, offset) for every length of every kind of bin."""
    taken: dict[int, int] = {}
    out, first = [], 0
    for times, content in bins:
        offset = 0
        for size, n in content:
            rank = taken.get(size, 0)
            out.append((size, rank, times * n, n, first, offset))
            taken[size] = rank + times * n
            offset += size * n
        first += times
    return out


def pack(docs: DataFrame, vocabulary: str, keep: list[str], text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``keep``, piece, start, length, ids, sequence_id, offset for every piece of every document."""
    pieces = stored(tokenised(docs, vocabulary, keep, text, capacity))
    totals = stored(pieces.groupBy("task", "length").agg(F.count("*").alias("n")))
    counts = np.zeros(capacity + 1, np.int64)
    for r in totals.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[r.length] = r.n
    names = "r_length bigint, r_rank bigint, r_count bigint, r_each bigint, r_bin bigint, r_offset bigint"
    # a bounded table: every kind of bin uses up a length, and the lengths of a bin differ
    runs = F.broadcast(docs.sparkSession.createDataFrame(_runs(plan(counts)), names))
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("task", "length", F.coalesce(earlier, F.lit(0)).alias("before"))
    offsets = F.broadcast(offsets) if totals.count() <= SMALL_OFFSETS else shuffled(offsets)
    rank = F.col("before") + F.col("nth")
    place = F.col("r_rank") <= rank, rank < F.col("r_rank") + F.col("r_count")
    nth = rank - F.col("r_rank")
    return (
        pieces.join(offsets, ["task", "length"])
        .join(runs, (F.col("length") == F.col("r_length")) & place[0] & place[1])
        .select(
            *[col(c) for c in keep],
            "piece",
            "start",
            "length",
            "ids",
            (F.col("r_bin") + F.floor(nth / F.col("r_each"))).alias("sequence_id"),
            (F.col("r_offset") + nth % F.col("r_each") * F.col("length")).alias("offset"),
        )
    )
