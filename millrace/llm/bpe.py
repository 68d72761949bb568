"""Byte-level BPE by backtracking over longest matches.

A text is cut by the tokenizer's pattern; every piece is encoded by itself.  Its bytes, mapped to Latin-1,
run through an Aho-Corasick automaton of the vocabulary, which gives the longest token at every place.
The encoder takes the longest token, falls back to shorter ones while the token isn't compatible with
its left neighbour, and steps back where none is left.  Two tokens are compatible if merging their joint
bytes gives just them; that is decided from how each token was merged, and remembered per pair.  A place
given up is never tried again, so the work is linear in the text and the result is that of the merges.

* null and empty texts: no tokens
* long texts: whole; a piece of any length is encoded in linear time
* texts of special tokens are ordinary text
"""

from __future__ import annotations

import base64
from array import array
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .batches import Memo, chunks, over_texts

PAIRS = 500_000  # remembered token pairs
BLANK = -1
BETWEEN = "\u0100"  # stands for no byte


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file with a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Encoder:
    """Tables of one vocabulary: halves of every token, longest token prefixes, the automaton."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.beyond = max(self.bytes_of, default=0) + 1
        self.automaton = ahocorasick.Automaton()
        self.halves = {i: self._last_merge(b, i) for b, i in ranks.items()}
        # a token that its own bytes don't merge to is used for a piece that equals it, never inside one
        self.merged = {b: i for b, i in ranks.items() if len(b) == 1 or self.halves[i][0] != i}
        for token, i in self.merged.items():
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.shorter = {i: self._prefix(b) for b, i in self.merged.items()}
        self.size = [len(self.bytes_of.get(i, b"")) for i in range(self.beyond)]
        self.widest = max(map(len, self.merged), default=1)
        self.compatible: dict[int, bool] = {}
        self.pieces = Memo(lambda keys: self.encode_many([k.encode("utf-8", "replace") for k in keys]), 150_000)

    def _prefix(self, token: bytes) -> int:
        for end in range(len(token) - 1, 0, -1):
            if token[:end] in self.merged:
                return self.merged[token[:end]]
        return BLANK

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int]:
        """The two tokens whose merge makes this one; the token itself twice for single bytes."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            joined = [self.ranks.get(a + b, rank) for a, b in zip(parts, parts[1:])]
            best = min(joined)
            if best >= rank:
                return rank, rank  # no chain of merges leads here
            at = joined.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) < 2 or any(p not in self.ranks for p in parts):
            return rank, rank
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def fits(self, left: int, right: int) -> bool:
        return self._fits_pair(left * self.beyond + right)

    def _fits_pair(self, pair: int) -> bool:
        known = self.compatible.get(pair)
        if known is None:
            if len(self.compatible) > PAIRS:
                self.compatible.clear()
            known = self.compatible[pair] = self._fits(*divmod(pair, self.beyond))
        return known

    def _fits(self, left: int, right: int) -> bool:
        """Undo both tokens' merges at their common edge, latest first; no merge across it may come earlier."""
        ranks, bytes_of, halves = self.ranks, self.bytes_of, self.halves
        undone = self.beyond  # rank of the merge that was undone last
        ties = False  # of equal merges the left one comes first
        while True:
            across = ranks.get(bytes_of[left] + bytes_of[right])
            if across is not None and (across < undone or (ties and across == undone)):
                return False
            # a single byte has no merge to undo
            left_rank = left if len(bytes_of[left]) > 1 else BLANK
            right_rank = right if len(bytes_of[right]) > 1 else BLANK
            if left_rank == right_rank == BLANK:
                return True
            if left_rank > right_rank:
                undone, ties, left = left, False, halves[left][1]
            else:
                undone, ties, right = right, True, halves[right][0]

    def encode_bytes(self, piece: bytes) -> list[int]:
        return np.frombuffer(self.encode_many([piece])[0], np.int32).tolist()

    def encode_many(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of every piece, as the bytes of 32-bit numbers.

        The longest tokens of all pieces come from one run of the automaton over the pieces behind each
        other, with a character between them that no token has.  Where all neighbours are compatible
        they are the result; the other pieces are worked on from their first misfit.
        """
        out = [np.int32(i).tobytes() if i is not None else b"" for i in map(self.ranks.get, pieces)]
        rest = [n for n, done in enumerate(out) if not done and pieces[n]]
        if not rest:
            return out
        text = BETWEEN.join([pieces[n].decode("latin-1") for n in rest])
        ends, tokens = map(np.array, zip(*self.automaton.iter_long(text)))
        limits = np.cumsum([len(pieces[n]) + 1 for n in rest])
        stops = np.searchsorted(ends, limits)
        left, right = tokens[:-1], tokens[1:]
        keys, number = np.unique(left * self.beyond + right, return_inverse=True)
        fits = np.fromiter(map(self._fits_pair, keys.tolist()), bool, len(keys))
        misfits = np.flatnonzero(~fits[number]) + 1
        inner = misfits[~np.isin(misfits, stops)]  # neighbours of one piece
        owners, firsts = np.unique(np.searchsorted(stops, inner, "right"), return_index=True)
        wrong = dict(zip(owners.tolist(), inner[firsts].tolist()))
        flat = tokens.astype(np.int32).tobytes()
        start = 0
        for n, (place, stop) in enumerate(zip(rest, stops.tolist())):
            if n in wrong:
                kept = tokens[start : wrong[n]].tolist()
                ids = self._stepped_back(pieces[place].decode("latin-1"), kept, int(tokens[wrong[n]]))
                out[place] = array("i", ids).tobytes()
            else:
                out[place] = flat[4 * start : 4 * stop]
            start = stop
        return out

    def _stepped_back(self, text: str, out: list[int], token: int) -> list[int]:
        """Finish a piece from its first tokens and the next longest one, which doesn't fit behind them."""
        size, shorter, longest, widest = self.size, self.shorter, self.automaton.iter_long, self.widest
        known, fits, beyond = self.compatible.get, self._fits_pair, self.beyond
        closed: set[int] = set()  # places from which the rest can't be encoded
        at, stop = sum([size[i] for i in out]), len(text)
        while True:
            end = at + size[token]
            if end not in closed:
                pair = out[-1] * beyond + token if out else BLANK
                compatible = pair == BLANK or known(pair)
                if compatible is None:
                    compatible = fits(pair)
                if compatible:
                    if end == stop:
                        return [*out, token]
                    out.append(token)
                    at = end
                    token = next(longest(text[at : at + widest]))[1]
                    continue
            token = shorter[token]
            if token == BLANK:
                closed.add(at)
                token = out.pop()
                at -= size[token]

    def encode(self, text: str, pattern: regex.Pattern) -> list[int]:
        """Ids of a text."""
        return np.frombuffer(self.encode_chunks([text], pattern)[0], np.int32).tolist()

    def encode_chunks(self, texts: list[str], pattern: regex.Pattern) -> list[bytes]:
        """Ids of every text, as the bytes of 32-bit numbers."""
        cut = list(map(pattern.findall, texts))
        single = [len(ps) == 1 for ps in cut]
        alone = self.encode_many([t.encode("utf-8", "replace") for t, one in zip(texts, single) if one])
        self.pieces.learn({p for ps, one in zip(cut, single) if not one for p in ps})
        known, own = self.pieces.__getitem__, iter(alone)
        return [next(own) if one else b"".join(map(known, ps)) for ps, one in zip(cut, single)]


_WORKER: dict[bytes, Encoder] = {}


def _worker_encoder(ranks: dict[bytes, int], name: bytes) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if name not in _WORKER:
        _WORKER.clear()
        _WORKER[name] = Encoder(ranks)
    return _WORKER[name]


def _list_array(parts: list[bytes]) -> pa.Array:
    """Arrow lists of 32-bit numbers from their bytes."""
    ends = np.cumsum([0, *[len(p) // 4 for p in parts]])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` and ``ids``, the token ids of the whole text.  The vocabulary is broadcast: its
    size is that of a vocabulary file, whatever the input."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    name = repr((len(ranks), hash(frozenset(ranks.items())), pattern)).encode()

    def make():
        encoder, compiled = _worker_encoder(shared.value, name), regex.compile(pattern)
        memo = Memo(lambda keys: encoder.encode_chunks(keys, compiled), 250_000)

        def compute(texts: list) -> list[pa.Array]:
            cut = [chunks(t or "") for t in texts]
            memo.learn(set(chain.from_iterable(cut)))
            return [_list_array([b"".join(map(memo.__getitem__, cs)) for cs in cut])]

        return compute

    return over_texts(docs, keep, [T.StructField("ids", T.ArrayType(T.IntegerType()))], make, text)


def decode(coded: DataFrame, ranks: dict[bytes, int], keep: list[str], ids: str = "ids") -> DataFrame:
    """Columns ``keep`` and ``bytes``: what the ids stand for; null ids give no bytes.

    The tokens' bytes lie behind each other in one array; all ids of a batch are looked up at once.
    """
    by_id = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, i in ranks.items():
        by_id[i] = token
    lengths = np.array([*map(len, by_id)], np.int64)
    shared = coded.sparkSession.sparkContext.broadcast((np.frombuffer(b"".join(by_id), np.uint8), lengths))

    def make():
        flat, length = shared.value
        begin = np.cumsum(length) - length

        def compute(lists: pa.ListArray) -> list[pa.Array]:
            numbers = lists.flatten().to_numpy()
            each = length[numbers]
            after = np.cumsum(each)
            total = int(after[-1]) if len(after) else 0
            data = flat[np.repeat(begin[numbers] - (after - each), each) + np.arange(total)]
            stops = np.cumsum([0, *pc.list_value_length(lists).fill_null(0).to_numpy()])
            offsets = np.concatenate([[0], after])[stops].astype(np.int32)
            return [pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(offsets), pa.py_buffer(data)])]

        return compute

    return over_texts(coded, keep, [T.StructField("bytes", T.BinaryType())], make, ids, raw=True)
