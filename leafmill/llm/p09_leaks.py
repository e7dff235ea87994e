"""Evaluation texts leaking into training text (problem 9): size-partitioned MinHash containment search.

Texts are reduced to their letters and digits, lower case. A passage of `run` characters of a test item (60, or 20 for Chinese)
contains, wherever it starts, a whole aligned window of the item, windows being cut at a fixed stride. So every item is split into
windows, small sets of character shingles, and a document that holds the passage contains such a set entirely: containment 1.

Partition by size: items are divided into size classes (by the length of the passage that counts and by their own length); each class has
its own shingle length, window length and number of MinHash functions. Documents are large sets, so they are searched through sets of
the class's own size: the sliding window of the class over the whole document, whose MinHash is a running minimum. Where the MinHash
signature of a document window equals that of an item window, the pair is a candidate; equal sets always have equal signatures, so no
passage is lost. Candidates are verified by exact shingle containment: the longest common run around the match must reach `run` characters.

Test items are a set of bounded size (checked, MAX_ITEM_BYTES); they are broadcast. Documents are read once and never shuffled.
Null and empty texts and items hold and leak nothing. Items that repeat are reported each; a row repeated gives one result row.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

#: Text of test items that may be broadcast; beyond it leaks() goes through the items in blocks of this size, each against all documents.
MAX_ITEM_BYTES = 16_000_000
_KEEP = re.compile(r"[\W_]+")
_HAN = re.compile("[一-鿿]")
MULT = np.uint64(0x9E3779B97F4A7C15)
#: Odd multipliers of the MinHash functions.
FUNCTIONS = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0xD6E8FEB86659FD93)]


@dataclass(frozen=True)
class SizeClass:
    """Items with passages of `run` characters; shingles of `shingle` characters; windows of `window` characters every `stride`."""

    run: int
    shingle: int
    window: int
    stride: int
    functions: int

    @classmethod
    def of(cls, han: bool, length: int) -> SizeClass:
        if han:  # a passage of 20 contains a whole window of 13 that starts at a multiple of 8
            return cls(20, 8, 13, 8, 2)
        if length < 250:
            return cls(60, 16, 41, 20, 1)
        return cls(60, 16, 36, 25, 1)


def reduce(text: str) -> str:
    return _KEEP.sub("", text.casefold())


def shingles(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k characters from each position on, k a power of two, by doubling."""
    h, span, m = codes, 1, 0x100000001B3
    while span < k:
        h = h[:-span] * np.uint64(m) + h[span:]
        span *= 2
        m = (m * m + 2) | 1
        m &= (1 << 64) - 1
    h = (h ^ (h >> np.uint64(29))) * MULT
    return h ^ (h >> np.uint64(32))


def running_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum over each w neighbours, by doubling."""
    out, span = h, 1
    while span * 2 <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[: len(out) - (w - span)], out[w - span :]) if w > span else out


def signatures(h: np.ndarray, c: SizeClass) -> np.ndarray:
    """MinHash of every window of the class from the shingle hashes: 64 bits that mix the minima of its functions."""
    n = c.window - c.shingle + 1
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = running_min(h, n)
    for f in FUNCTIONS[: c.functions - 1]:
        g = h * f
        out = out * MULT + running_min(g ^ (g >> np.uint64(31)), n)
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


class Index:
    """MinHash signatures of the item windows, one table for each size class."""

    FILTER_BITS = 22

    def __init__(self, items: list[tuple[int, str]]):
        self.items = items
        self.text: list[str] = []
        by_class: dict[SizeClass, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for n, (_, raw) in enumerate(items):
            text = reduce(raw)
            self.text.append(text)
            han = len(_HAN.findall(text)) * 3 > len(text)
            c = SizeClass.of(han, len(text))
            sig = signatures(shingles(_codes(text), c.shingle), c) if len(text) >= c.window else []
            for at in range(0, len(sig), c.stride):
                by_class[c][int(sig[at])].append((n, at))
        self.classes = []
        for c, table in by_class.items():
            bits = np.zeros(1 << self.FILTER_BITS, bool)
            keys = np.array(list(table), np.uint64)
            bits[(keys >> np.uint64(64 - self.FILTER_BITS)).astype(np.int64)] = True
            self.classes.append((c, bits, dict(table)))

    def search(self, raw: list[str]) -> set[tuple[int, int]]:
        """(number of the text, item id) for each text that holds a passage of the item.

        The texts are searched as one string; no item has the separator, so no passage crosses it.
        """
        texts = [reduce(t) for t in raw]
        text = "\0".join(texts)
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        codes = _codes(text)
        found: set[tuple[int, int]] = set()
        hashes = {k: shingles(codes, k) for k in {c.shingle for c, *_ in self.classes} if len(codes) >= k}
        for c, bits, table in self.classes:
            if c.shingle not in hashes:
                continue
            sig = signatures(hashes[c.shingle], c)
            for at in np.flatnonzero(bits[(sig >> np.uint64(64 - self.FILTER_BITS)).view(np.int64)]):
                for n, there in table.get(int(sig[at]), ()):
                    key = (int(np.searchsorted(starts, at, side="right")) - 1, self.items[n][0])
                    if key not in found and self.holds(text, int(at), n, there, c):
                        found.add(key)
        return found

    def holds(self, text: str, at: int, n: int, there: int, c: SizeClass) -> bool:
        """Exact: the common run around the matched windows has the length that counts."""
        item = self.text[n]
        if text[at : at + c.window] != item[there : there + c.window]:
            return False
        lo = 0
        while lo < min(at, there) and text[at - lo - 1] == item[there - lo - 1]:
            lo += 1
        hi = c.window
        while hi < min(len(text) - at, len(item) - there) and text[at + hi] == item[there + hi]:
            hi += 1
        return lo + hi >= c.run


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id): documents that hold a passage of a test item."""
    items = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    blocks = max(1, -(-size // MAX_ITEM_BYTES))
    out = None
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        index = documents.sparkSession.sparkContext.broadcast(Index([tuple(r) for r in part.collect()]))

        def make(index=index):
            search = index.value.search

            def run(ids, texts) -> Iterator[tuple]:
                for n, item in search(texts):
                    yield ids[n], item

            return run

        found = map_batches(documents.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "text"), make, "doc_id bigint, item_id bigint")
        out = found if out is None else out.unionAll(found)
    return out.distinct()
