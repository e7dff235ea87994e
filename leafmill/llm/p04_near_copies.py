"""Near-duplicate records with small edits (problem 4): binary trie self-join over MinHash sketches.

Similarity: the share of distinct `SHINGLE`-character substrings that two texts have in common, after lower-casing and removing white space.

1. One pass over the texts: one-permutation MinHash (BINS bins) of the shingle set. Bands of ROWS bins give bucket keys, one bit of each
   of 64 bin groups a binary sketch. Texts that are equal after reduction are one class, of which one member goes on.
2. Trie self-join: the rows of a task, sorted by (bucket key, sketch), are a binary trie. In the key part no bit may differ; from there on
   node pairs are traversed together, differing bits accumulate, and a pair of nodes is pruned as soon as the budget is exceeded. The
   traversal is level by level over arrays of node pairs; a pair of leaves is finished by one population count.
3. Candidates, made distinct, are verified exactly on the texts.

Hot buckets are cut before anything is shuffled: a sample of at most about SAMPLE classes names the keys whose bucket is estimated at more than
BUCKET_ROWS members; the members of such a key are spread over chunks by a hash, and every pair of chunks becomes a bucket of its own, so no
task holds an unbounded bucket and no pair is dropped. A bucket that the sample missed is worked off in the task by pairs of chunks as well.
What belongs to a key that many rows share (one text copied a billion times, one large group) is found by partial aggregation, and joined back with
the few hot keys broadcast (at most HOT_KEYS of them). Similarity MIN_SHARE is found with a probability of 0.998 (48 bands of 4), 0.7 with over 0.99999.

pairs() gives all pairs, so its output is quadratic in the size of a group of copies; groups() is the bounded form, one row for each record.

Null bodies and bodies shorter than MIN_CHARS are no members. Repeated doc_ids count once. Pairs come with the smaller id first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, shared_dir

SHINGLE = 10
MIN_CHARS = 400
MIN_SHARE = 0.6
BINS, ROWS = 192, 4
#: Differing bits of 64 that a pair may have: at similarity 0.6, 12.8 are expected with a deviation of 3.2.
BUDGET = 26
BUCKET_ROWS = 2000
#: Classes among which hot bucket keys are looked for; and keys shared by many rows that may be broadcast (a key is hot from rows / HOT_KEYS rows on).
SAMPLE = 100_000
HOT_KEYS = 50_000
_SPACE = re.compile(r"\s+")
_MULT = np.uint64(0x9E3779B97F4A7C15)
_BOUNDS = (np.arange(BINS, dtype=np.float64) * (2.0**64 / BINS)).astype(np.uint64)


def reduce(text: str) -> str:
    return _SPACE.sub("", text.lower())


def shingle_set(reduced: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all substrings of SHINGLE characters."""
    c = np.frombuffer(reduced.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(c) < SHINGLE:
        return np.zeros(0, np.uint64)
    two = c[:-1] * np.uint64(0x100000001B3) + c[1:]
    four = two[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + two[2:]
    eight = four[:-4] * np.uint64(0x165667B19E3779F9) + four[4:]
    h = eight[: len(c) - 9] * np.uint64(0x27D4EB2F165667C5) + two[8:]
    h = (h ^ (h >> np.uint64(29))) * _MULT
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    h = np.sort(h ^ (h >> np.uint64(30)))
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def minhash(h: np.ndarray) -> np.ndarray:
    """Least hash of each bin; an empty bin takes that of the next filled one, marked by its distance."""
    at = np.searchsorted(h, _BOUNDS)
    first = h[np.minimum(at, len(h) - 1)]
    upper = np.concatenate([_BOUNDS[1:], [np.uint64(2**64 - 1)]])
    full = (at < len(h)) & (first >= _BOUNDS) & (first < upper)
    if full.all():
        return first
    where = np.flatnonzero(full)
    nxt = where[np.searchsorted(where, np.arange(BINS)) % len(where)]
    gap = ((nxt - np.arange(BINS)) % BINS).astype(np.uint64)
    return first[nxt] + gap * np.uint64(0xD6E8FEB86659FD93)


def bands_and_sketch(h: np.ndarray) -> tuple[list[int], int]:
    m = minhash(h)
    k = m.reshape(BINS // ROWS, ROWS)
    key = np.arange(BINS // ROWS, dtype=np.uint64) * _MULT
    for i in range(ROWS):
        key = (key ^ k[:, i]) * np.uint64(0x94D049BB133111EB)
        key ^= key >> np.uint64(31)
    mixed = m[:: BINS // 64][:64] * np.uint64(0xD6E8FEB86659FD93)
    bits = (mixed >> np.uint64(63)).astype(np.uint64)
    sketch = (bits << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64)
    return key.view(np.int64).tolist(), int(sketch.view(np.int64))


def sketches(md_corpus: DataFrame) -> DataFrame:
    """(doc_id, same, bands, sketch) of every record long enough; `same` is equal for texts that are equal after reduction."""

    def make():
        import hashlib

        def run(ids, texts) -> Iterator[tuple]:
            for i, t in zip(ids, texts):
                r = reduce(t)
                if len(r) < MIN_CHARS:
                    continue
                bands, sketch = bands_and_sketch(shingle_set(r))
                yield i, hashlib.blake2b(r.encode("utf-8", "surrogatepass"), digest_size=16).digest(), bands, sketch

        return run

    rows = md_corpus.where(F.col("body").isNotNull() & F.col("doc_id").isNotNull() & (F.length("body") >= MIN_CHARS)).select("doc_id", "body")
    return map_batches(rows, make, "doc_id bigint, same binary, bands array<bigint>, sketch bigint")


def trie_join(key: np.ndarray, sketch: np.ndarray, member: np.ndarray, side: np.ndarray | None = None, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different members within one key whose sketches differ in at most `budget` bits.

    side: 0, 1 or 2 for each row; rows of 0 and 1 are paired with the other side only.
    """
    order = np.lexsort((sketch.view(np.uint64), key))
    key, sketch, member = key[order], sketch[order].view(np.uint64), member[order]
    side = None if side is None else side[order]
    n = len(key)
    if n < 2:
        return member[:0], member[:0]
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    alo, ahi = cut[:-1], cut[1:]
    many = ahi - alo > 1
    alo, ahi = alo[many], ahi[many]  # trie nodes below which a whole key is matched
    blo, bhi = alo, ahi
    diff = np.zeros(len(alo), np.int64)
    left, right = [], []

    def leaves(x: np.ndarray, y: np.ndarray) -> None:
        ok = np.bitwise_count(sketch[x] ^ sketch[y]) <= budget
        x, y = x[ok], y[ok]
        ok = member[x] != member[y]
        if side is not None:
            ok &= (side[x] != side[y]) | (side[x] == 2)
        left.append(member[x[ok]]), right.append(member[y[ok]])

    for level in range(63, -1, -1):
        if not len(alo):
            break
        ones = np.concatenate([[0], np.cumsum((sketch >> np.uint64(level)) & np.uint64(1)).astype(np.int64)])
        amid, bmid = ahi - (ones[ahi] - ones[alo]), bhi - (ones[bhi] - ones[blo])
        self_pair = alo == blo
        children = [
            (alo, amid, blo, bmid, diff, None),
            (amid, ahi, bmid, bhi, diff, None),
            (alo, amid, bmid, bhi, diff + 1, None),
            (amid, ahi, blo, bmid, diff + 1, ~self_pair),  # of a node with itself this is the one before
        ]
        nxt = []
        for a0, a1, b0, b1, d, only in children:
            keep = (a1 > a0) & (b1 > b0) & (d <= budget)
            if only is not None:
                keep &= only
            keep &= (a0 != b0) | (a1 - a0 > 1)
            single = keep & (a1 - a0 == 1) & (b1 - b0 == 1)
            if single.any():
                leaves(a0[single], b0[single])
            keep &= ~single
            nxt.append((a0[keep], a1[keep], b0[keep], b1[keep], d[keep]))
        alo, ahi, blo, bhi, diff = (np.concatenate(x) for x in zip(*nxt))
    for a0, a1, b0, b1 in zip(alo, ahi, blo, bhi):  # equal sketches, or single against equal ones
        if a0 == b0:
            x, y = np.triu_indices(a1 - a0, 1)
            leaves(a0 + x, a0 + y)
        else:
            x, y = np.meshgrid(np.arange(a0, a1), np.arange(b0, b1), indexing="ij")
            leaves(x.ravel(), y.ravel())
    if not left:
        return member[:0], member[:0]
    x, y = np.concatenate(left), np.concatenate(right)
    return np.minimum(x, y), np.maximum(x, y)


def join_bucketwise(key: np.ndarray, sketch: np.ndarray, member: np.ndarray, side: np.ndarray, bucket_rows: int = BUCKET_ROWS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """trie_join of rows sorted by key, a bounded number of rows at a time: small buckets together, a large one by pairs of its chunks."""
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    size = np.diff(cut)
    large = np.repeat(size > 2 * bucket_rows, size)
    small = ~large & np.repeat(size > 1, size)
    if small.any():
        yield trie_join(key[small], sketch[small], member[small], side[small])
    for lo, hi in zip(cut[:-1][size > 2 * bucket_rows], cut[1:][size > 2 * bucket_rows]):
        chunks = [np.arange(at, min(at + bucket_rows, hi)) for at in range(lo, hi, bucket_rows)]
        for i, a in enumerate(chunks):
            yield trie_join(key[a], sketch[a], member[a], side[a])
            for b in chunks[i + 1 :]:
                both = np.concatenate([a, b])
                half = np.where(side[both] == 2, np.repeat([0, 1], [len(a), len(b)]), side[both])
                yield trie_join(key[both], sketch[both], member[both], half)


def _join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key: whole keys are joined as they are complete."""
    waiting: list[pa.RecordBatch] = []
    rows = 0

    def joined(t: pa.Table) -> Iterator[pa.RecordBatch]:
        for x, y in join_bucketwise(*(t.column(c).to_numpy() for c in ("key", "sketch", "member", "side"))):
            if len(x):  # a pair met in several bands of this task is one candidate
                both = np.unique(np.stack([x, y], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0], pa.int64()), pa.array(both[:, 1], pa.int64())], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        rows += batch.num_rows
        first, last = waiting[0].column(0)[0].as_py(), batch.column(0)[-1].as_py()
        if rows < 60_000 or first == last:
            continue
        t = pa.Table.from_batches(waiting)
        end = int(np.flatnonzero(t.column("key").to_numpy() != last)[-1]) + 1
        yield from joined(t.slice(0, end))
        waiting, rows = t.slice(end).to_batches(), t.num_rows - end
    if waiting:
        yield from joined(pa.Table.from_batches(waiting))


def hot_keys(bands: DataFrame, n: int, bucket_rows: int) -> DataFrame:
    """(key, chunks) of the bucket keys with more than about bucket_rows of the n classes; at most SAMPLE * bands / 20 rows, whatever n."""
    every = max(1, n // SAMPLE)
    least = max(20, bucket_rows // every) if every > 1 else bucket_rows
    counted = bands.where(F.pmod(F.xxhash64("member"), F.lit(every)) == 0).select(F.explode("bands").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least)
    return counted.select("key", F.ceil(F.col("n") * F.lit(2 * every / bucket_rows)).cast("int").alias("chunks"))


def candidates(sketched: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): pairs of classes, each by the least doc_id of its texts."""
    classes = sketched.groupBy("same").agg(F.min("doc_id").alias("member"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")).checkpoint()
    hot = hot_keys(classes, classes.count(), bucket_rows)
    rows = classes.select("member", "sketch", F.explode("bands").alias("key")).join(F.broadcast(hot), "key", "left")  # bounded, see hot_keys
    cold = F.col("chunks").isNull()
    own = F.pmod(F.xxhash64("member", F.lit(1)), F.col("chunks")).cast("int")
    spread = rows.withColumn("own", own).withColumn("other", F.explode(F.when(cold, F.array(F.lit(None).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1))))
    same_chunk = cold | (F.col("own") == F.col("other"))
    block = F.when(cold, F.col("key")).otherwise(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
    side = F.when(same_chunk, 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    keyed = spread.select(block.alias("key"), "sketch", "member", side.cast("long").alias("side"))
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_join_runs, "a bigint, b bigint").distinct()


def joined_back(rows: DataFrame, of: DataFrame, key: str, n: int) -> DataFrame:
    """rows joined with `of`, which has one row for each key and its number of rows in `copies`. Keys that more than n / HOT_KEYS of n rows share are at most
    HOT_KEYS; they are broadcast, so that none of their rows moves. The rest goes by an ordinary join."""
    least = max(1000, n // HOT_KEYS)
    hot = F.broadcast(of.where(F.col("copies") > least).withColumn("hot", F.lit(True)))
    value = [c for c in of.columns if c != key]
    near = rows.join(hot, key, "left")
    far = near.where("hot is null").drop(*value, "hot").join(of.where(F.col("copies") <= least), key)
    return near.where("hot").drop("hot").select(far.columns).unionAll(far)


def verified(pairs: DataFrame, md_corpus: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """(a, b, share) of the candidates whose share of common substrings reaches min_share."""

    def make():
        sets: dict[int, np.ndarray] = {}

        def of(i: int, text: str) -> np.ndarray:
            if i not in sets:
                if len(sets) > 2000:
                    sets.clear()
                sets[i] = shingle_set(reduce(text))
            return sets[i]

        def run(a, b, x, y) -> Iterator[tuple]:
            for i, j, s, t in zip(a, b, x, y):
                p, q = of(i, s), of(j, t)
                at = np.searchsorted(p, q)
                both = int((p[np.minimum(at, len(p) - 1)] == q).sum())
                share = both / (len(p) + len(q) - both)
                if share >= min_share:
                    yield i, j, share

        return run

    # only texts that stand in a candidate pair are moved
    needed = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = md_corpus.select("doc_id", "body").where(F.col("body").isNotNull() & (F.length("body") >= MIN_CHARS)).join(needed, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    both = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("body").alias("x")), "a").join(texts.select(F.col("doc_id").alias("b"), F.col("body").alias("y")), "b")
    return map_batches(both.select("a", "b", "x", "y"), make, "a bigint, b bigint, share double", rows=256)


def links(md_corpus: DataFrame, min_share: float = MIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """(pairs of classes with their share, membership (rep, doc_id, copies)); both cut from their lineage by checkpoints in the shared folder."""
    shared_dir(md_corpus.sparkSession)
    sketched = sketches(md_corpus).checkpoint()
    texts = sketched.select("same", "doc_id").distinct()
    of = texts.groupBy("same").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    member = joined_back(texts, of, "same", sketched.count()).select("rep", "doc_id", "copies")
    found = verified(candidates(sketched).checkpoint(), md_corpus, min_share)
    return found, member


def pairs(md_corpus: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """(doc_id_a, doc_id_b): all pairs of records, members of equal texts included."""
    found, member = links(md_corpus, min_share)
    of = lambda c, d: member.select(F.col("rep").alias(c), F.col("doc_id").alias(d))
    across = found.select("a", "b").join(of("a", "x"), "a").join(of("b", "y"), "b").select("x", "y")
    copied = lambda d: member.where("copies > 1").select("rep", F.col("doc_id").alias(d))
    within = copied("x").join(copied("y"), "rep").where("x < y").select("x", "y")
    both = across.unionAll(within)
    return both.select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(v, label): the least vertex of its connected group for every vertex of edges (a, b), which holds each edge in both directions.

    Contraction: under an order that is drawn anew each round, every vertex hooks to the least of itself and its neighbours and jumps on to where
    that one hooked; vertices that met are one from then on. It ends when no edge is left: the last vertex of a group in the order of the round is
    hooked to by none, so each round makes every unfinished group smaller, and a random order by a constant factor on average, whatever the ids.
    """
    shared_dir(edges.sparkSession)
    label = edges.select(F.col("a").alias("v")).distinct().withColumn("root", F.col("v"))
    left, turn = edges, 0
    while not left.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("rank"), F.col(c).alias("to"))  # noqa: B023, E731
        near = left.groupBy("a").agg(F.min(rank("b")).alias("near"))
        hook = near.select(F.col("a").alias("root"), F.least("near", rank("a"))["to"].alias("to"))
        hook = hook.join(hook.select(F.col("root").alias("to"), F.col("to").alias("far")), "to").select("root", "far").checkpoint()
        label = label.join(hook, "root", "left").select("v", F.coalesce("far", "root").alias("root"))
        of = lambda c: hook.select(F.col("root").alias(c), F.col("far").alias(f"{c}_far"))  # noqa: B023, E731
        left = left.join(of("a"), "a").join(of("b"), "b").where("a_far != b_far").select(F.col("a_far").alias("a"), F.col("b_far").alias("b")).distinct().checkpoint()
        turn += 1
    of = label.groupBy("root").agg(F.min("v").alias("label"), F.count(F.lit(1)).alias("copies"))
    return joined_back(label, of, "root", label.count()).select("v", "label")


def groups(md_corpus: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """(doc_id, class_id, n_links): one row for each record that has a copy; class_id is the least doc_id of its connected group, however long its chains.

    n_links counts the different texts a record is linked to and the other records of its own text.
    """
    found, member = links(md_corpus, min_share)
    found = found.select("a", "b").checkpoint()
    edges = found.unionAll(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    label = components(edges)
    degree = edges.groupBy(F.col("a").alias("rep")).agg(F.count(F.lit(1)).alias("links"))
    return (
        member.join(degree, "rep", "left")
        .join(label.select(F.col("v").alias("rep"), "label"), "rep", "left")
        .where("links is not null or copies > 1")
        .select("doc_id", F.coalesce("label", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
