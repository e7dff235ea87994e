"""Subject area of each document (problem 3): subject-specific interpolated n-gram language models.

For each subject a bigram model, interpolated with its unigram model and the background, is trained on the labelled samples; the background
model is the even mixture of all subjects' models. Tokens are words, or overlapping pairs of characters in Chinese. A sentence is scored by the
per-token cross-entropy of the background less that of each subject. The shares of a document's sentences are estimated from these scores
together (expectation-maximisation over the subjects and "none", whose score is calibrated on held-out samples), so that a sentence of
little evidence follows its document. A document is accepted for every subject that at least MIN_SHARE of its sentences are on: several, one or none.

Three rounds of self-training widen the vocabulary: all bodies that are clearly of one subject are added to its samples, and those of too little
evidence to the subject that their category has among the clear ones. Bodies are read once, to numbered tokens (Part), which are kept for the rounds and
the result; a round scores them once and counts on the executors (Lessons), and the driver gets the counts of pairs. The summary is cut from the body
and adds nothing to it.

Bodies that are nothing but residue (problem 6), null and empty ones have no subject. Whole bodies are read and scored. Repeated rows repeat.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string
from pyspark.sql.window import Window

from .common import map_batches, shared_dir
from .p02_markup import _FENCE as _FENCE_LINE
from .p05_lookalikes import Normaliser, prototypes
from .p06_residue import Model as Residue
from .p06_residue import SPAN, outside_code
from .p07_encoding import Repairer

MIN_SHARE = 1 / 3
#: Weights of bigram, unigram and background.
LAMBDA = (0.30, 0.40, 0.30)
#: Share of a category's records that must be of one subject before the category decides for an unreadable body.
CATEGORY_SHARE = 0.6
#: Rounds of self-training.
ROUNDS = 3
#: A part is closed after the bodies with which it has as many tokens.
PART_TOKENS = 1 << 20
#: Tokens are looked for in so many characters at once, or one sentence.
CHUNK = 1 << 18

# In these the first sign is looked for, then what belongs to it: else they scan slowly.
_MARK = re.compile(r"[<{\\&*_`~#|=\[\]}$](?:(?<=<)(?:!--.*?-->|[^<>\n]+>)|(?<=\{)\{[^{}\n]*\}\}|(?<=\\)[a-zA-Z]+\*?|(?<=&)[a-z]{2,8};|(?<=[*_`~#|=\[\]{}$])[*_`~#|=\[\]{}$]*)", re.S)
_LINK = re.compile(r"!\[[^\]\n]*\]\([^()\n]*\)|(?<=\])\([^()\s]+\)")
_CUT = re.compile(r"[-¬­](?:(?<=-)\n(?=[a-zß-ÿ])|(?<=¬)\n|(?<=­)\n?)")
_WRAP_HAN = re.compile(r"\n(?<=[一-鿿，、；：]\n)(?=[一-鿿，。、；：])")
#: Group 1 is the gap behind a sign.
_SENTENCE = re.compile(r"[.!?。！？\n](?:(?<!\n)(\s+|(?=[一-鿿]))|(?<=\n)(?:\s*\n|(?=\s*(?:[-*+•#>|]|\d+[.)]\s))))")
#: A unit counts as a sentence from this many tokens on.
MIN_TOKENS = 4
HAN_TOKENS = 7


_APART = "\n\0\n"  # between sentences while marks are removed; no mark reaches over it


def _split(text: str) -> Iterator[str]:
    at = 0
    for m in _SENTENCE.finditer(text):
        a, b = m.span(m.lastindex or 0)
        yield text[at:a]
        at = b
    yield text[at:]


def sentences(text: str) -> list[str]:
    text = outside_code(text)
    if "](" in text:
        text = _LINK.sub(" ", text)
    if "\n" in text:
        text = _CUT.sub("", text)
        if not text.isascii():
            text = _WRAP_HAN.sub("", text)
    if _MARK.search(text):
        text = "\n".join("" if _FENCE_LINE.match(x) else x for x in text.split("\n")) if "```" in text or "~~~" in text else text
        return [s for s in _MARK.sub(" ", _APART.join(filter(None, _split(text)))).split(_APART) if not s.isspace()]
    return [s for s in _split(text) if s and not s.isspace()]


_LABEL_ALONE = re.compile(r"(?m)^[^\S\n]*[^\W\d][^\n:：]*[:：][^\S\n]*$")


def without_slots(text: str, residue: Residue | None) -> str:
    """text without its unfilled placeholders (problem 6), and without labels that have nothing behind them then."""
    if not residue:
        return text
    slots = [m.span() for m in SPAN.finditer(text) if residue.span(text, m) > 0]
    if not slots:
        return text
    out, at = [], 0
    for a, b in slots:
        out.append(text[at:a])
        at = b
    return _LABEL_ALONE.sub("", "".join([*out, text[at:]]))


#: Kinds of characters of tokens: small ASCII letters, other letters, those of them that have a digit's value, digits, Han characters. 0: none of these.
_SMALL, _LETTER, _RAISED, _DIGIT, _HAN = range(1, 6)
#: Of each kind, those that stand in tokens together.
_GROUPS = np.array([0, 1, 1, 1, 2, 3], np.uint8)


@cache
def _kinds() -> np.ndarray:
    """The kind of every code point, made once a worker."""
    kinds = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, range(0x110000)))
    for m in re.finditer(r"[^\W_]+", every):
        kinds[m.start() : m.end()] = [_DIGIT if c.isdecimal() else _RAISED if c.isdigit() else _LETTER for c in m.group()]
    kinds[ord("a") : ord("z") + 1] = _SMALL
    kinds[0x4E00:0xA000] = _HAN
    return kinds


def tokenise(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """(tokens of all sentences one after another, number of those of each sentence). A unit that is too short for a sentence has none.

    Tokens are words in lower case, a mark (0) for numbers and codes (up to three small ASCII letters before digits, with or without a hyphen), and
    overlapping pairs of neighbouring Han characters.
    """
    lower = [t.lower() for t in texts]
    point = np.frombuffer("\n".join([*lower, "0"]).encode("utf-32-le", "surrogatepass"), np.uint32)  # the last is the mark
    kind = _kinds().take(point)
    group = _GROUPS.take(kind)
    group[-1] = 0
    edge = np.flatnonzero(group[1:] != group[:-1]) + 1
    start, end = np.append(0, edge), np.append(edge, len(group))  # runs of characters of one group
    start, end = (x[group[start] > 0] for x in (start, end))
    of = group[start]
    short = np.flatnonzero((of[:-1] == 1) & (of[1:] == 2) & (end[:-1] - start[:-1] <= 3))
    a, b, then = start[short], end[short], start[short + 1]
    beside = (then == b) | (then == b + 1) & (point[b] == ord("-"))
    beside &= (kind[a] == _SMALL) & (kind[(a + b) // 2] == _SMALL) & (kind[b - 1] == _SMALL)
    start, end = (np.delete(x, short[beside]) for x in (start, end))  # letters of a code: the digits stand for it
    first = np.searchsorted(start, np.cumsum([0, *(len(t) + 1 for t in lower)]))  # run of each sentence, and the end
    zero = (group[start] == 2) | (kind[end - 1] == _RAISED)
    start[zero], end[zero] = len(point) - 1, len(point)
    han = kind[start] == _HAN
    many = np.where(han, np.maximum(end - start - 1, 1), 1)  # tokens of each run
    size = np.diff(np.append(0, np.cumsum(many))[first])
    words_first = np.append(point[start], 0)[first[:-1]] < ord("一")
    size[(size < HAN_TOKENS) & ~(words_first & (size >= MIN_TOKENS))] = 0
    kept = np.repeat(size > 0, np.diff(first))
    start, many, length = start[kept], many[kept], np.where(han, np.minimum(end - start, 2), end - start)[kept]
    start, length = np.repeat(start, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many), np.repeat(length, many)
    ends = np.append(0, np.cumsum(length))
    chars = point.take(np.arange(ends[-1]) + np.repeat(start - ends[:-1], length))
    text = chars.tobytes().decode("utf-32-le").encode()
    if len(text) > len(chars):
        ends = np.append(0, np.cumsum(1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)))[ends]
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(text)), size


def _freeze(what: object) -> tuple[bytes, int]:
    rest = pickle.dumps(what)
    return pa.compress(rest, codec="zstd", asbytes=True), len(rest)


def _thaw(rest: bytes, length: int) -> tuple:
    return pickle.loads(pa.decompress(rest, length, codec="zstd", asbytes=True))


@dataclass
class Part:
    """The sentences of some bodies, as numbers of the pairs of neighbouring words in them. A pair ends in its token, so that there is one for each."""

    words: list[str]
    before: np.ndarray  #: of each pair, the number of its first word in words; their number at the start of a sentence
    now: np.ndarray  #: of each pair, the number of its last word
    code: np.ndarray  #: of each token, the number of its pair
    size: np.ndarray  #: tokens of each sentence
    docs: np.ndarray  #: sentences of each body

    def freeze(self) -> tuple[list[str], bytes, int]:
        """(words, the rest compressed, its length)."""
        return self.words, *_freeze((self.before, self.now, self.code, self.size, self.docs))

    @classmethod
    def thaw(cls, words: list[str], rest: bytes, length: int) -> Part:
        return cls(words, *_thaw(rest, length))


def _chunk[T](those: Iterator[T], length: Callable[[T], int]) -> Iterator[T]:
    """The next of those, until they have CHUNK characters together."""
    room = CHUNK
    for x in those:
        yield x
        if (room := room - length(x)) <= 0:
            return


def pack(bodies: Iterable[list[str]], most: float = float("inf")) -> Part:
    """bodies: the sentences of each body; of an iterator no more chunks of bodies are taken than needed for `most` tokens."""
    bodies, found = iter(bodies), [pa.array([], pa.large_string())]
    sizes, units = [np.zeros(0, np.int64)], []
    while sum(map(len, found)) < most and (chunk := list(_chunk(bodies, lambda b: sum(map(len, b))))):
        units += map(len, chunk)
        rest = (s for b in chunk for s in b)
        while some := list(_chunk(rest, len)):
            tokens, size = tokenise(some)
            found.append(tokens)
            sizes.append(size)
    numbered, size = pa.concat_arrays(found).dictionary_encode(), np.concatenate(sizes).astype(np.int32)
    docs = np.bincount(np.repeat(np.arange(len(units)), units)[size > 0], minlength=len(units)).astype(np.int32)
    size = size[size > 0]
    words, now = numbered.dictionary.to_pylist(), numbered.indices.to_numpy().astype(np.int64)
    before = np.empty_like(now)
    before[1:] = now[:-1]
    before[_starts(size)] = len(words)
    numbered = pa.array(before * (len(words) + 1) + now).dictionary_encode()
    pairs, code = numbered.dictionary.to_numpy(), numbered.indices.to_numpy()
    return Part(words, (pairs // (len(words) + 1)).astype(np.int32), (pairs % (len(words) + 1)).astype(np.int32), code, size, docs)


def _starts(size: np.ndarray) -> np.ndarray:
    return np.cumsum(size, dtype=np.int64) - size


@dataclass
class Models:
    subjects: list[str]
    ids: dict[str, int]
    unigram: np.ndarray  #: (words + 1, subjects): difference in nats of an unseen pair ending in the word
    keys: np.ndarray  #: sorted pairs seen in training
    bigram: np.ndarray  #: (pairs, subjects)
    threshold: float = 0.0

    def look_up(self, part: Part) -> tuple[np.ndarray, np.ndarray]:
        """((pairs, subjects): differences; whether its last word is known) of the pairs of a part."""
        unknown = len(self.ids)
        number = np.array([*(self.ids.get(w, unknown) for w in part.words), unknown + 1], np.int64)
        now = number.take(part.now)
        out = self.unigram.take(now, 0)
        if len(self.keys):
            key = number.take(part.before) * (unknown + 2) + now
            order = np.argsort(key)  # neighbours are looked up much faster one after another
            at = np.empty_like(key)
            at[order] = np.minimum(np.searchsorted(self.keys, key[order]), len(self.keys) - 1)
            hit = np.flatnonzero(self.keys.take(at) == key)
            out[hit] = self.bigram.take(at[hit], 0)
        return out, now < unknown

    def score(self, part: Part) -> tuple[np.ndarray, np.ndarray]:
        """((sentences, subjects): mean difference of cross-entropy, background minus subject; share of known words of each sentence)."""
        if not len(part.size):
            return np.zeros((0, len(self.subjects)), np.float32), np.zeros(0)
        difference, known = self.look_up(part)
        start = np.append(_starts(part.size), len(part.code))
        out = np.empty((len(part.size), len(self.subjects)), np.float32)
        for i in range(0, len(out), 2048):  # so many that the CPU's cache holds them
            at = start[i : i + 2049]
            np.add.reduceat(difference.take(part.code[at[0] : at[-1]], 0), at[:-1] - at[0], 0, out=out[i : i + 2048])
        return out / part.size[:, None], np.add.reduceat(known.take(part.code), start[:-1], dtype=np.int32) / part.size

    def shares(self, score: np.ndarray, size: np.ndarray, docs: np.ndarray, rounds: int = 8) -> np.ndarray:
        """(documents, subjects): share of the sentences of each document; docs has the number of sentences of each, which follow one another."""
        k = len(self.subjects)
        out = np.zeros((len(docs), k))
        full = np.flatnonzero(docs)
        if not len(full):
            return out
        score = np.concatenate([score, np.full((len(size), 1), self.threshold)], 1) * size[:, None] * 0.7
        ends = np.append(0, np.cumsum(docs[full], dtype=np.int64))
        for i in range(0, len(full), 256):  # so many that the CPU's cache holds them
            some, at = docs[full[i : i + 256]], ends[i : i + 257]
            own = score[at[0] : at[-1]]
            like = np.ascontiguousarray(np.exp(np.clip(own - own.max(1, keepdims=True), -60, 0)).T)  # subjects by sentences
            doc = np.repeat(np.arange(len(some)), some)
            pi = np.full((k + 1, len(some)), 1 / (k + 1))
            for _ in range(rounds):
                post = (pi + 1e-3).take(doc, 1)
                post *= like
                post /= post.sum(0)
                pi = np.add.reduceat(post, at[:-1] - at[0], 1) / some
            out[full[i : i + 256]] = pi[:k].T
        return out


@dataclass
class Counts:
    """How often pairs of words stand in sentences of a subject (or of a claim, see Lessons); a row may come more than once."""

    pair: np.ndarray  #: number of the first word (of all words: of the start of a sentence) x (number of words + 1) + number of the last
    subject: np.ndarray
    n: np.ndarray

    def __add__(self, other: Counts) -> Counts:
        return Counts(np.concatenate([self.pair, other.pair]), np.concatenate([self.subject, other.subject]), np.concatenate([self.n, other.n]))


def counts(part: Part, subject: np.ndarray, k: int, ids: dict[str, int]) -> Counts:
    """subject: that of each body, k where it has none."""
    of = np.repeat(np.repeat(subject, part.docs), part.size)
    taken = of < k
    at, n = (f.to_numpy() for f in pa.array(part.code[taken].astype(np.int64) * k + of[taken]).value_counts().flatten())
    number = np.array([*(ids[w] for w in part.words), len(ids)], np.int64)
    return Counts((number[part.before] * (len(ids) + 1) + number[part.now])[at // k], at % k, n)


def fit(seen: Counts, words: list[str], subjects: list[str]) -> Models:
    k, n = len(subjects), len(words)
    pairs, at = np.unique(seen.pair, return_inverse=True)
    c2 = np.zeros((len(pairs), k), np.int64)
    np.add.at(c2, (at, seen.subject), seen.n)
    before, last = pairs // (n + 1), pairs % (n + 1)
    used = np.unique(last)  # a word that no lesson has is unknown
    number = np.full(n + 1, -1)
    number[used] = np.arange(len(used))
    n, words = len(used), [words[i] for i in used]
    number[-1] = n + 1
    before, last = number[before], number[last]
    c1, first = np.zeros((n + 1, k)), np.zeros((n + 2, k))
    np.add.at(c1, last, c2)
    np.add.at(first, before, c2)
    l2, l1, l0 = LAMBDA
    p1 = c1 / np.maximum(c1.sum(0), 1)
    ground = p1.mean(1, keepdims=True) + 1e-7  # every subject counts alike, whatever its share of the samples

    def difference(p: np.ndarray) -> np.ndarray:
        return (np.log(p) - np.log(p.mean(1, keepdims=True))).astype(np.float32)

    uni = difference((l2 + l1) * p1 + l0 * ground)
    uni[n] = 0
    keys = before * (n + 2) + last
    order = np.argsort(keys)
    big = np.empty((len(keys), k), np.float32)
    for i in range(0, len(keys), 50_000):
        of = order[i : i + 50_000]
        b, h = last[of], first[before[of]]
        w2 = l2 * h / (h + 3)  # a history that a subject has hardly seen gives its weight to the unigram
        big[i : i + 50_000] = difference(w2 * c2[of] / np.maximum(h, 1) + (l1 + l2 - w2) * p1[b] + l0 * ground[b])
    return Models(subjects, dict(zip(words, range(n))), uni, keys[order], big)


def _labelled(lessons: list[tuple[str, str]], subjects: list[str]) -> tuple[Part, np.ndarray]:
    """lessons: (subject, sentence); each is a body of its own."""
    return pack([t] for _, t in lessons), np.array([subjects.index(s) for s, _ in lessons], np.int64)


def calibrate(labelled: list[tuple[str, str]], subjects: list[str]) -> tuple[float, float]:
    """(threshold, held-out accuracy): every fifth sentence is held out; the threshold lets 98 of 100 true sentences pass, within bounds."""
    part, y = _labelled([x for i, x in enumerate(labelled) if i % 5], subjects)
    m = fit(counts(part, y, len(subjects), dict(zip(part.words, range(len(part.words))))), part.words, subjects)
    part, y = _labelled([x for i, x in enumerate(labelled) if i % 5 == 0], subjects)
    s = m.score(part)[0]
    right = s.argmax(1) == y
    t = float(np.quantile(s[right, y[right]], 0.02)) if right.any() else 0.1
    return min(max(0.6 * t, 0.03), 0.2), float(right.mean())


@dataclass
class Opinion:
    """What models say of bodies of at least three sentences; the others teach nothing."""

    top: np.ndarray
    best: np.ndarray
    second: np.ndarray
    enough: np.ndarray

    @classmethod
    def of(cls, m: Models, part: Part) -> Opinion:
        shares = m.shares(m.score(part)[0], part.size, part.docs)
        second = np.partition(shares, -2, 1)[:, -2] if len(m.subjects) > 1 else np.zeros(len(shares))
        return cls(shares.argmax(1), shares.max(1), second, part.docs >= 3)

    @property
    def clear(self) -> np.ndarray:
        return self.enough & (self.best >= 0.7) & (self.second < 0.12)

    def votes(self, categories: list[str]) -> Counter:
        """Clear bodies by category and subject."""
        return Counter((categories[i], int(self.top[i])) for i in np.flatnonzero(self.clear))

    def claims(self, categories: list[str], k: int) -> tuple[list[tuple[str | None, int]], np.ndarray]:
        """((category, subject) of each claim, number of the claim of each body; that of claims where it has none).

        A body teaches the subject that it is clear of (no category then). One of little evidence teaches the subject of its category, whichever that is
        (k) or if it is this one; one of two subjects nothing.
        """
        weak = ~self.clear & self.enough & (self.second < 0.12)
        names = list(dict.fromkeys(categories))
        number = dict(zip(names, range(len(names))))
        category = np.where(self.clear, len(names), np.array([number[c] for c in categories], np.int64))
        subject = np.where(self.best < 0.4, k, self.top)
        some = np.flatnonzero(self.clear | weak)
        used, at = np.unique(category[some] * (k + 1) + subject[some], return_inverse=True)
        of = np.full(len(categories), len(used))
        of[some] = at
        return [([*names, None][x // (k + 1)], int(x % (k + 1))) for x in used], of


@dataclass
class Lessons:
    """What bodies may teach: the counts of pairs by claim, as what a category means is known only when all bodies have been read."""

    claims: list[tuple[str | None, int]]
    counts: Counts  #: subject: the number of the claim

    @classmethod
    def of(cls, opinion: Opinion, part: Part, categories: list[str], k: int, ids: dict[str, int]) -> Lessons:
        claims, of = opinion.claims(categories, k)
        return cls(claims, counts(part, of, len(claims), ids) if claims else Counts(*np.zeros((3, 0), np.int64)))

    def taught(self, meaning: dict[str, int], k: int) -> Counts:
        said = [s if c is None else m if s in (k, m := meaning.get(c, k)) else k for c, s in self.claims]
        subject = np.array(said, np.int64)[self.counts.subject]
        return Counts(*(x[subject < k] for x in (self.counts.pair, subject, self.counts.n)))


def meanings(votes: Counter) -> dict[str, int]:
    """What a category means here: the subject of most of its clear documents."""
    of: dict[str, Counter] = defaultdict(Counter)
    for (category, subject), n in votes.items():
        of[category][subject] += n
    return {c: s for c, n in of.items() for s, most in n.most_common(1) if most >= max(3, CATEGORY_SHARE * n.total())}


def category_key(category: str | None) -> str:
    return (category or "").strip().lower()


def learn(
    samples: list[tuple[str, str]], subjects: list[str], words: Iterable[str], read: Callable[[Models, dict[str, int]], tuple[Counter, Callable[[dict[str, int]], Counts]]]
) -> tuple[Models, dict[str, float]]:
    """samples: (subject, text), labelled; words: those of all bodies. read(models, numbers of words) goes over all bodies: (votes, lessons under meanings)."""
    every = [(s, p) for s, x in samples if x and s in subjects for p in sentences(x)]
    base = [x for x, n in zip(every, tokenise([p for _, p in every])[1]) if n]
    threshold, accuracy = calibrate(base, subjects)
    part, y = _labelled(base, subjects)
    vocabulary = sorted({*part.words, *words})
    ids = dict(zip(vocabulary, range(len(vocabulary))))
    taught = counts(part, y, len(subjects), ids)
    m, added = fit(taught, vocabulary, subjects), 0
    m.threshold = threshold
    for _ in range(ROUNDS if len(vocabulary) else 0):
        votes, lessons = read(m, ids)
        more = lessons(meanings(votes))
        added = int(more.n.sum())
        m = fit(taught + more, vocabulary, subjects)
        m.threshold = threshold
    return m, {"held_out_accuracy": accuracy, "threshold": threshold, "added_tokens": float(added)}


def train(samples: list[tuple[str, str]], bodies: list[tuple[str, str | None]], subjects: list[str], residue: Residue | None = None) -> tuple[Models, dict[str, float]]:
    """On one machine. samples: (subject, text), labelled; bodies: (text, category), not labelled."""
    part, k = pack(map(Reader(residue, {}), (b for b, _ in bodies))), len(subjects)
    categories = [category_key(c) for _, c in bodies]

    def read(m: Models, ids: dict[str, int]) -> tuple[Counter, Callable]:
        opinion = Opinion.of(m, part)
        lessons = Lessons.of(opinion, part, categories, k, ids)
        return opinion.votes(categories), lambda meaning: lessons.taught(meaning, k)

    return learn(samples, subjects, part.words, read)


class Reader:
    """The sentences of a body, without residue, look-alikes and wrong decoding."""

    def __init__(self, residue: Residue | None, table: dict[int, str]):
        self.residue, self.repair, self.plain = residue, Repairer(), Normaliser(table)

    def __call__(self, body: str) -> list[str]:
        if not body.isascii():
            body = self.plain(self.repair(body)[2] or body)
        if self.residue and self.residue.only_residue(outside_code(body), False):
            return []
        return sentences(without_slots(body, self.residue))


def verdicts(m: Models, part: Part) -> list[tuple[int, list[tuple[str, float]]]]:
    """(readable sentences, [(subject, share)]) of each body."""
    score, known = m.score(part)
    readable = known > 1 / 3  # garbled rests are no sentences
    docs = np.bincount(np.repeat(np.arange(len(part.docs)), part.docs)[readable], minlength=len(part.docs))
    shares = m.shares(score[readable], part.size[readable], docs)
    return [(int(n), [(m.subjects[i], float(row[i])) for i in np.flatnonzero(row > 0.02)]) for n, row in zip(docs, shares)]


class Judge:
    def __init__(self, models: Models, residue: Residue | None, table: dict[int, str]):
        self.models, self.read = models, Reader(residue, table)

    def __call__(self, bodies: list[str]) -> list[tuple[int, list[tuple[str, float]]]]:
        """(readable sentences, [(subject, share)]) of each body."""
        return verdicts(self.models, pack(map(self.read, bodies)))


def parts(md_corpus: DataFrame, front_matter: DataFrame, residue: Residue | None) -> DataFrame:
    """(doc_ids, categories, words, rest, length): Part by Part, all bodies with the categories of their records, read once and kept by a checkpoint."""
    spark = md_corpus.sparkSession
    shared_dir(spark)
    shared = spark.sparkContext.broadcast((residue, prototypes(spark)))  # 1 MB of weights and a fixed table, whatever the input
    said = front_matter.where("doc_id is not null and written_at is not null").groupBy("doc_id").agg(F.max(F.struct("written_at", "category"))["category"].alias("category"))
    bodies = md_corpus.where(F.col("doc_id").isNotNull() & F.col("body").isNotNull()).select("doc_id", "body").join(said, "doc_id", "left").select("doc_id", "body", "category")

    def make():
        read = Reader(*shared.value)

        def run(ids, texts, categories) -> Iterator[tuple]:
            units, at = map(read, texts), 0
            while at < len(ids):
                part = pack(units, PART_TOKENS)
                of = slice(at, at := at + len(part.docs))
                yield ids[of], list(map(category_key, categories[of])), *part.freeze()

        return run

    return map_batches(bodies, make, "doc_ids array<bigint>, categories array<string>, words array<string>, rest binary, length bigint", 10_000).checkpoint()


def _over_parts(kept: DataFrame, shared: object, columns_of: Callable[..., Iterable], schema: str) -> DataFrame:
    """Rows of the columns that columns_of(shared, doc_ids, categories, part) gives for each part."""
    sent = kept.sparkSession.sparkContext.broadcast(shared)  # models: the words and pairs of words of samples and bodies
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, categories, *frozen = (c[i].as_py() for c in batch.columns)
                columns = columns_of(sent.value, ids, categories, Part.thaw(*frozen))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types, strict=True)], names=arrow.names)

    return kept.mapInArrow(run, schema)


def model(kept: DataFrame, subject_samples: DataFrame, subjects: DataFrame) -> tuple[Models, dict[str, float]]:
    """Fitted to the samples and to all bodies; kept: their parts."""
    names = sorted(r[0] for r in subjects.where("subject is not null").select("subject").distinct().collect())
    samples = sorted(tuple(r) for r in subject_samples.where("subject is not null and sample is not null").select("subject", "sample").collect())

    def read(m: Models, ids: dict[str, int]) -> tuple[Counter, Callable]:
        def columns_of(shared, _, categories, part) -> Iterable:
            m, ids = shared
            opinion = Opinion.of(m, part)
            found = opinion.votes(categories)
            return [[c for c, _ in found]], [[s for _, s in found]], [list(found.values())], *([x] for x in _freeze(Lessons.of(opinion, part, categories, len(names), ids)))

        told = _over_parts(kept, (m, ids), columns_of, "category array<string>, subject array<int>, n array<bigint>, rest binary, length bigint").persist()
        votes = told.select(F.explode(F.arrays_zip("category", "subject", "n")).alias("v")).groupBy("v.category", "v.subject").agg(F.sum("v.n"))

        def lessons(meaning: dict[str, int]) -> Counts:
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for rest, length in zip(*batch.columns):
                        c = _thaw(rest.as_py(), length.as_py()).taught(meaning, len(names))
                        own = pa.table([c.pair, c.subject, c.n], ["pair", "subject", "n"]).group_by(["pair", "subject"]).aggregate([("n", "sum")])
                        yield from own.select(["pair", "subject", "n_sum"]).rename_columns(["pair", "subject", "n"]).to_batches()

            found = told.select("rest", "length").mapInArrow(run, "pair bigint, subject bigint, n bigint").groupBy("pair", "subject").agg(F.sum("n").alias("n")).toArrow()
            told.unpersist()
            return Counts(*(c.to_numpy() for c in found.columns))

        return Counter({(c, s): n for c, s, n in votes.collect()}), lessons

    return learn(samples, names, (r[0] for r in kept.select(F.explode("words")).distinct().collect()), read)


def judge(kept: DataFrame, models: Models) -> DataFrame:
    """(doc_id, subject, share): share of the readable sentences on each subject; subject null for a body without readable sentences."""

    def columns_of(m, ids, _, part) -> Iterable:
        rows = [(i, s, share) for i, (n, found) in zip(ids, verdicts(m, part)) for s, share in (found if n else [(None, 0.0)])]
        return [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]

    return _over_parts(kept, models, columns_of, "doc_id bigint, subject string, share double")


def subjects_of(md_corpus: DataFrame, front_matter: DataFrame, subject_samples: DataFrame, subjects: DataFrame, residue: Residue | None, min_share: float = MIN_SHARE) -> DataFrame:
    """(doc_id, subject): every subject accepted for a record."""
    kept = parts(md_corpus, front_matter, residue)
    scored = judge(kept, model(kept, subject_samples, subjects)[0])
    return scored.where(F.col("subject").isNotNull() & (F.col("share") >= min_share - 1e-9)).select("doc_id", "subject").distinct()


def composition(accepted: DataFrame, md_corpus: DataFrame, subjects: DataFrame) -> DataFrame:
    """(subject, n_docs, share) over all records; a record of several subjects counts for each."""
    total = max(1, md_corpus.count())
    per = accepted.groupBy("subject").agg(F.countDistinct("doc_id").alias("n_docs"))
    n = F.coalesce("n_docs", F.lit(0))
    return subjects.select("subject").join(per, "subject", "left").select("subject", n.alias("n_docs"), (n / F.lit(total)).alias("share"))


def category_subjects(accepted: DataFrame, front_matter: DataFrame, share: float = CATEGORY_SHARE) -> DataFrame:
    """(category, subject, share): what a hand-written category means in this corpus, where one subject has at least `share` of its records."""
    latest = front_matter.where("doc_id is not null").groupBy("doc_id").agg(F.max_by("category", "written_at").alias("category"))
    norm = F.lower(F.trim(F.col("category")))
    n = latest.join(accepted, "doc_id").groupBy(norm.alias("category"), "subject").agg(F.count(F.lit(1)).alias("n"))
    of = Window.partitionBy("category")
    return n.withColumn("share", F.col("n") / F.sum("n").over(of)).where((F.col("share") >= share) & F.col("category").isNotNull()).select("category", "subject", "share")
