"""Encoding of the whole corpus with a public byte-level BPE tokenizer (problem 8).

Texts are split into pieces by the tokenizer's pattern. The distinct pieces of a batch are laid out in padded numpy matrices, one per
length bucket; each round every row merges its leftmost pair of minimum rank, pairs are looked up in an open-addressing hash table,
and finished rows leave the matrix (compaction). Pieces that were met before come from a bounded cache of the worker. A piece of more than LONG
bytes, for which a row would be moved as often as it is long, merges in the same order over a linked list with a heap.

Null and empty texts give an empty list. Strings that look like special tokens are ordinary text. Texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import SLICE_ROWS

#: Where the vocabulary files lie on every machine; a parameter of encode().
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The split pattern of the vocabulary (fixed value, published with it).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces a worker remembers at most; then the cache starts anew.
CACHE = 400_000
NONE = np.int32(1 << 30)


class Merges:
    """Rank of each pair of ids, in a hash table of two numpy arrays (key, rank); the merged id equals its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            if len(token) < 2:
                continue
            # every split into two tokens is a pair that forms this token
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        keys = np.array(left, np.int64) << 20 | np.array(right, np.int64)
        vals = np.array(merged, np.int32)
        self.bits = int(np.ceil(np.log2(len(keys) * 3)))
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.vals = np.full(size, NONE, np.int32)
        slot = self._slot(keys)
        todo = np.arange(len(keys))
        self.probes = 0
        while len(todo):  # one more probe for all that collide
            free = todo[self.keys[slot[todo]] == -1]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]] = keys[put]
            self.vals[slot[put]] = vals[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & (size - 1)
            self.probes += 1

    @cached_property
    def pairs(self) -> dict[int, int]:
        """The hash table as a mapping, for one pair at a time."""
        full = self.keys >= 0
        return dict(zip(self.keys[full].tolist(), self.vals[full].tolist()))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where there is none."""
        key = a.astype(np.int64) << 20 | b
        key = np.where((a < 0) | (b < 0), -2, key)
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.vals[slot], NONE)
        flat_key, flat_slot = key.ravel(), slot.ravel()
        out = out.ravel()
        open_ = np.flatnonzero(((found != key) & (found != -1) & (key != -2)).ravel())
        mask = len(self.keys) - 1
        while len(open_):
            flat_slot[open_] = (flat_slot[open_] + 1) & mask
            f = self.keys[flat_slot[open_]]
            hit = f == flat_key[open_]
            out[open_[hit]] = self.vals[flat_slot[open_[hit]]]
            open_ = open_[~hit & (f != -1)]
        return out.reshape(key.shape)


#: Longest piece, in bytes, that has a row in a matrix.
LONG = 512


def bpe_long(piece: bytes, merges: Merges) -> list[int]:
    """Ids of one long piece: always the leftmost pair of least rank, from a heap, over a linked list."""
    rank = merges.pairs.get
    ids = merges.byte_id[np.frombuffer(piece, np.uint8)].tolist()
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank(ids[i] << 20 | ids[i + 1])) is not None]
    heapify(heap)
    while heap:
        r, i, a, b = heappop(heap)
        j = after[i]
        if ids[i] != a or j >= n or ids[j] != b:
            continue  # one of the two has been merged since
        ids[i], ids[j] = r, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (s := rank(r << 20 | ids[k])) is not None:
                heappush(heap, (s, i, r, ids[k]))
        h = before[i]
        if h >= 0 and (s := rank(ids[h] << 20 | r)) is not None:
            heappush(heap, (s, h, ids[h], r))
    return [x for x in ids if x >= 0]


def bpe(pieces: list[bytes], merges: Merges) -> list[list[int]]:
    """Ids of each piece."""
    out: list[list[int] | None] = [None] * len(pieces)
    length = np.array([len(p) for p in pieces])
    for i in np.flatnonzero(length > LONG):
        out[i] = bpe_long(pieces[i], merges)
    order = np.argsort(length, kind="stable")
    order = order[length[order] <= LONG]
    at = 0
    while at < len(order):
        n = length[order[at]]
        top = max(4, int(n * 1.25))
        end = at + int(np.searchsorted(length[order[at:]], top, side="right"))
        end = min(end, at + max(1, 400_000 // max(1, top)))
        rows = order[at:end]
        at = end
        width = int(length[rows].max()) if len(rows) else 0
        if width == 0:
            for r in rows:
                out[r] = []
            continue
        buf = np.zeros((len(rows), width), np.uint8)
        live = np.arange(width)[None, :] < length[rows][:, None]
        buf[live] = np.frombuffer(b"".join(pieces[r] for r in rows), np.uint8)
        ids = np.where(live, merges.byte_id[buf], np.int32(-1))
        rank = merges.rank(ids[:, :-1], ids[:, 1:]) if width > 1 else np.zeros((len(rows), 0), np.int32)
        which = rows
        while True:
            if rank.shape[1]:
                col = rank.argmin(1)  # leftmost of the least
                least = rank[np.arange(len(rank)), col]
                done = least == NONE
            else:
                done = np.ones(len(ids), bool)
            if done.any():  # compaction of rows
                size = (ids[done] >= 0).sum(1)
                for r, line, k in zip(which[done], ids[done].tolist(), size.tolist()):
                    out[r] = line[:k]
                keep = ~done
                ids, which = ids[keep], which[keep]
                if not len(ids):
                    break
                rank, col, least = rank[keep], col[keep], least[keep]
            i = np.arange(len(ids))
            # merge: the pair becomes its rank, everything to the right moves one place left
            shift = np.arange(ids.shape[1] - 1)[None, :] > col[:, None]
            new = np.where(shift, ids[:, 1:], ids[:, :-1])
            new[i, col] = least
            rshift = np.arange(rank.shape[1] - 1)[None, :] > col[:, None]
            rank = np.where(rshift, rank[:, 1:], rank[:, :-1])
            ids = new
            if rank.shape[1]:
                has = col < rank.shape[1]
                rank[i[has], col[has]] = merges.rank(ids[i[has], col[has]], ids[i[has], np.minimum(col[has] + 1, ids.shape[1] - 1)])
                left = col > 0
                rank[i[left], col[left] - 1] = merges.rank(ids[i[left], col[left] - 1], ids[i[left], col[left]])
            if ids.shape[1] > 8 and (longest := int((ids >= 0).sum(1).max())) < ids.shape[1] * 3 // 4:  # compaction of columns
                ids, rank = ids[:, :longest], rank[:, : max(0, longest - 1)]
    return out  # type: ignore[return-value]


@lru_cache(2)
def load(path: str) -> Merges:
    with open(path, "rb") as f:
        return Merges({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


class Splitter:
    """The pattern's pieces of a text. The standard library's engine is used where both agree, which is nearly everywhere."""

    #: PATTERN in the standard library's terms: a letter is a word character that is no decimal digit.
    SAME = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"

    def __init__(self) -> None:
        import sys

        import regex

        self.exact = regex.compile(PATTERN).findall
        self.fast = re.compile(self.SAME).findall
        # numbers that are no decimal digits, and separators that only one engine takes for white space
        odd = [chr(o) for o in range(0x10000) if unicodedata.category(chr(o)) in ("Nl", "No")] + [chr(o) for o in range(0x1C, 0x20)]
        self.odd = re.compile("[" + "".join(odd) + "]").search
        self.size = sys.getsizeof

    def __call__(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.size(text) >= 4 * len(text) or self.odd(text):  # four bytes a character: beyond the basic plane
            return self.exact(text)
        return self.fast(text)


class Encoder:
    def __init__(self, path: str):
        self.merges = load(path)
        self.split = Splitter()
        self.cache: dict[str, list[int]] = {}

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where each text ends."""
        split = list(map(self.split, texts))
        cache = self.cache
        pieces = list(chain.from_iterable(split))
        if new := set(pieces).difference(cache):
            if len(cache) + len(new) > CACHE:
                cache.clear()
                new = set(pieces)
            fresh = list(new)
            cache.update(zip(fresh, bpe([p.encode("utf-8", "replace") for p in fresh], self.merges)))
        ids = list(map(cache.__getitem__, pieces))
        flat = np.fromiter(chain.from_iterable(ids), np.int32)
        ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))])
        return flat, ends[np.cumsum([len(x) for x in split], dtype=np.int64)] if split else ends[:0]


def encode(documents: DataFrame, vocabulary: str = VOCABULARY, rows: int = 2 * SLICE_ROWS) -> DataFrame:
    """(doc_id, text) -> (doc_id, ids), a row for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                flat, ends = enc(part.column(1).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), lists], names=["doc_id", "ids"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>")
