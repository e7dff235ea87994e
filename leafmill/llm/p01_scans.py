"""Noise in text from scanned pages (problem 1): page furniture, words cut at line ends, misread characters.

1. Corpus vocabulary: document frequency of every word (of every pair of neighbouring characters in Chinese) over all records, counted
   before the shuffle. Kept are words of at least VOCABULARY_SHARE of the records (and at least MIN_DOCS). A text has some D
   distinct words, so at most D / VOCABULARY_SHARE words can be kept, whatever the number of records: a bound that allows a broadcast.
2. Each record by itself: page numbers are lines of one form whose numbers count up; headers and footers are lines that repeat, but for misreadings,
   at page edges; what remains is joined to paragraphs, a word cut at a line end is joined when the vocabulary knows the whole, and
   misread characters are undone when that makes a frequent word of an unknown one.

Only text broken into lines counts as scanned. Null and empty bodies have no defect and come back unchanged. Texts of any length are
treated whole; repeated rows give repeated results; without a vocabulary (a tiny corpus) only page furniture is found.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, shared_dir

VOCABULARY_SHARE = 5e-4
MIN_DOCS = 4
#: A frequent form must be so many times as frequent as the rare one that it replaces.
RATIO = 8
#: Misread characters that make a defect.
MISREAD = 3

# What scanners read, and what stood there.
SIGNS = {"@": "a", "!": "il", "5": "s", "0": "o", "1": "li", "9": "g", "6": "b", "+": "t", "|": "li", "$": "s", "8": "b"}
_ALIKE = [("c", "e"), ("cl", "d"), ("b", "h"), ("vv", "w"), ("ii", "u"), ("rn", "m"), ("l", "i"), ("f", "t"), ("n", "u"), ("c", "o"), ("li", "h"), ("q", "g"), ("nn", "m"), ("v", "y"), ("j", "i")]
#: Either of a pair may be read for the other.
LETTERS = _ALIKE + [(b, a) for a, b in _ALIKE]
HAN = dict(zip("末己厍敎汁入侍朗曰埸祖盲未已库数计人待期日场组直士土干于大太千目自体休", "未已库数计人待期日场组直末己厍敎汁入侍朗曰埸祖盲土士于干太大干自目休体", strict=True))

_HAN = re.compile("[一-鿿]")
_WORD = re.compile(r"[^\W\d_]+")
_LATIN_TOKEN = re.compile(r"(?<!\w)[A-Za-zÀ-ÖØ-öø-ÿœŒ0-9@!+|$]*[A-Za-zÀ-ÖØ-öø-ÿœŒ][A-Za-zÀ-ÖØ-öø-ÿœŒ0-9@!+|$]*(?!\w)")
_TAIL = re.compile(r"(?<![\w@!+|$])([A-Za-zÀ-ÖØ-öø-ÿœŒ0-9@!+|$]*[A-Za-zÀ-ÖØ-öø-ÿœŒ@!+|$])([-¬\u00ad‐]?)\s*$")
_HEAD = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿœŒ@!+|$][A-Za-zÀ-ÖØ-öø-ÿœŒ0-9@!+|$]*")
_PLAIN = re.compile(r"[A-Za-zäöüßÄÖÜéèêëàâçùûîïôœæÉÈÀÂÇÊÎÔŒ@!+|$0-9]+")
_HIDDEN = re.compile("[\u200b-\u200d\u2060\ufeff]|\u00ad(?!\n)")
_NUMBER = re.compile(r"(?<![A-Za-zÀ-ÿ])(?=[\dOlI]*\d)[\dOlI]*[OlI][\dOlI]*(?![A-Za-zÀ-ÿ])|(?<=[一-鿿-])[lO]{1,4}(?=[一-鿿，。])")
_MARKUP = re.compile(r"^(?:    |\t)|^\s*(?:[#>|*+~`<\\{!=]|\[(?!\s*\d+\s*\]\s*$)|[-•] |\d+[.)] |```|~~~|\$\$)|[;{}]\s*$|</|\|\s*$")
_END = re.compile(r"[.!?。！？:：;；”\"»)）]\s*$")
#: Forms of a page number; a line holds nothing else.
_PAGE = [
    re.compile(p, re.I)
    for p in (
        r"(?:page|seite|pagina|p|s|pg|blatt|folio)\.?\s*(\d{1,4})(?:\s*(?:of|von|sur|/|de)\s*(\d{1,4}))?",
        r"第\s*(\d{1,4})\s*[页頁](?:\s*[,，/]?\s*共\s*(\d{1,4})\s*[页頁])?",
        r"[-–—·•*~\[(|（【]?\s*(\d{1,4})\s*[-–—·•*~\])|）】]?",
        r"[-–—·\[(]?\s*(\d{1,4})\s*(?:/|of|von|sur)\s*(\d{1,4})\s*[-–—·\])]?",
    )
]
_ROMAN = re.compile(r"[-–—·\[(]?\s*([ivxlc]{1,7})\s*[-–—·\])]?", re.I)
_FOLD = str.maketrans({**{k: v[0] for k, v in SIGNS.items()}, **{k: v for k, v in HAN.items() if v in "未已库数计人待期日场组直"}, "O": "o", "l": "i", "I": "i", " ": None, "　": None})


def fold(line: str) -> str:
    """Equal for lines that differ in likely misreadings only."""
    s = line.strip().translate(_FOLD).lower().translate(_FOLD)
    for a, b in (("rn", "m"), ("ci", "d"), ("vv", "w"), ("ii", "u")):
        s = s.replace(a, b)
    return s.replace("c", "e").replace("h", "b")


def alike(a: str, b: str) -> bool:
    """Fuzzy equality of folded lines: at most one difference in eight characters."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 2 or min(len(a), len(b)) < 6:
        return False
    room = max(1, len(a) // 8)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= room
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    return max(len(a), len(b)) - lo - hi <= room


class Forms:
    """Groups of folded lines, each named by its first form; `at` finds the first group that is alike among any number of them.

    Only groups that share a key are compared, and forms that are alike always share one: of equal length, with at most `room` differences, one of room + 1
    pieces is equal; of other lengths, where the differences stand together, half of what is outside them is equal at the start or at the end.
    """

    def __init__(self) -> None:
        self.first: list[str] = []
        self.exact: dict[str, int] = {}
        self.keys: dict[tuple, list[int]] = defaultdict(list)
        self.keyed = 0

    @staticmethod
    def pieces(f: str) -> list[tuple]:
        n = len(f)
        k = max(1, n // 8) + 1
        return [(n, i, f[n * i // k : n * (i + 1) // k]) for i in range(k)]

    @staticmethod
    def ends(f: str, n: int) -> list[tuple]:
        half = (n - max(1, n // 8) + 1) // 2
        return [(n, "start", f[:half]), (n, "end", f[-half:])]

    def near(self, f: str) -> Iterable[int]:
        """Groups that may be alike, in their order: the few of a short text all, else those with a common key."""
        if len(self.first) <= 100:
            return range(len(self.first))
        for k in range(self.keyed, len(self.first)):
            g = self.first[k]
            for key in self.pieces(g) + self.ends(g, len(g)):
                self.keys[key].append(k)
        self.keyed = len(self.first)
        keys = self.pieces(f) + [key for n in range(max(6, len(f) - 2), len(f) + 3) if n != len(f) for key in self.ends(f, n)]
        return sorted({k for key in keys for k in self.keys.get(key, ())})

    def at(self, f: str) -> int:
        """Number of the group of f, which is opened where there is none."""
        k = self.exact.get(f)
        if k is None:
            k = next((k for k in self.near(f) if alike(self.first[k], f)), None)
            if k is None:
                k = len(self.first)
                self.first.append(f)
            self.exact[f] = k
        return k


def _roman(s: str) -> int:
    value = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}
    n = [value[c] for c in s.lower()]
    return sum(-a if b > a else a for a, b in zip(n, n[1:] + [0]))


def page_numbers(lines: list[str]) -> set[int]:
    """Indexes of lines that hold a page number: one form, numbers counting up by one."""
    by_form: dict[object, list[tuple[int, int]]] = defaultdict(list)
    for i, line in enumerate(lines):
        s = line.strip()
        if not s or len(s) > 26:
            continue
        for k, p in enumerate(_PAGE):
            if m := p.fullmatch(s):
                by_form[k, re.sub(r"\d+", "9", s), m.group(2) if p.groups > 1 else None].append((i, int(m.group(1))))
                break
        else:
            if m := _ROMAN.fullmatch(s):
                by_form["roman", re.sub("[ivxlcIVXLC]+", "i", s), None].append((i, _roman(m.group(1))))
    out: set[int] = set()
    for found in by_form.values():
        run = [found[0]]
        for item in found[1:] + [(-1, -1)]:
            if item[1] == run[-1][1] + 1:
                run.append(item)
                continue
            if len(run) >= 2:
                out.update(i for i, _ in run)
            run = [item]
    return out


def headers(lines: list[str], numbers: set[int], wrapped: bool) -> set[int]:
    """Indexes of lines that repeat at page edges."""
    full, fenced = [], False
    for i, x in enumerate(lines):
        if x.lstrip().startswith(("```", "~~~")):
            fenced = not fenced
        elif x.strip() and not fenced:
            full.append(i)
    place = {i: k for k, i in enumerate(full)}
    edge: set[int] = set()
    for i in numbers & place.keys():
        k = place[i]
        edge.update(j for j in full[max(0, k - 2) : k + 3] if j not in numbers)
    forms, groups = Forms(), defaultdict(list)
    for i in full:
        s = lines[i].strip()
        if i in numbers or not 4 <= len(s) <= 100 or not s[0].isalnum() or _MARKUP.search(s) or not re.search(r"[^\W\d_]{2}", s):
            continue
        if numbers and i not in edge and place[i] > 1:
            continue
        groups[forms.at(fold(s))].append(i)
    out: set[int] = set()
    #: A line of running text is at least so long.
    wide = sorted(len(lines[i]) for i in full)[len(full) // 2] / 2 if full else 0
    for at in groups.values():
        if len(at) < 2:
            continue
        if numbers:
            near = sum(i in edge or place[i] == 0 for i in at)
            if near >= 2 and near * 2 >= len(at):
                out.update(at)
        elif wrapped:
            # an edge without a number: first or last line, or in the middle of a sentence
            edges = broken = 0
            for i in at:
                k = place[i]
                before = lines[full[k - 1]] if k else ""
                goes_on = k + 1 < len(full) and lines[full[k + 1]].strip()[:1].islower()
                edges += k in (0, len(full) - 1) or not _END.search(before) or goes_on
                broken += 0 < k < len(full) - 1 and len(before) > wide and not _END.search(before)
            s = lines[at[0]].strip()
            # or, where pages end with sentences, a line that comes back again and again far apart
            apart = len(at) > 2 and min(place[b] - place[a] for a, b in zip(at, at[1:])) > 3
            misread = len({lines[i].strip() for i in at}) > 1
            if (edges * 2 > len(at) or broken or apart or misread) and not re.search(r"[.。]$", s):
                out.update(at)
    return out


def is_wrapped(lines: list[str]) -> bool:
    """Text broken into lines: enough pairs of neighbouring lines of one paragraph."""
    pairs = broken = 0
    for x, y in zip(lines, lines[1:]):
        if len(x) > 14 and len(y) > 2 and not _MARKUP.search(x) and not _MARKUP.search(y):
            pairs += 1
            broken += not _END.search(x) or len(x) > 25
    return pairs >= 2 and broken * 2 > pairs


def words(text: str) -> set[str]:
    out: set[str] = set()
    for w in _WORD.findall(text.lower()):
        if w.isascii() or not _HAN.search(w):
            out.add(w)
        else:
            out.update(map("".join, zip(w, w[1:])))
    return out


class Scanner:
    def __init__(self, vocabulary: dict[str, int]):
        self.df = vocabulary
        self.top = max(vocabulary.values(), default=0)  # a word with more than a share of this has no form that is RATIO times as frequent
        #: No longer token can be a misreading of a known word: each of two confusions takes one letter for two at most.
        self.longest = max(map(len, vocabulary), default=0) + 2
        self.memo: dict[str, tuple[str, int]] = {}

    def known(self, w: str) -> int:
        return self.df.get(w.lower(), 0)

    def undo(self, token: str) -> tuple[str, int]:
        """(word, characters changed): the frequent word that the token is a misreading of, else the token itself and 0."""
        if token in self.memo:
            return self.memo[token]
        if len(self.memo) > 200_000:
            self.memo.clear()
        self.memo[token] = out = self._undo(token)
        return out

    def _undo(self, token: str) -> tuple[str, int]:
        low = token.lower()
        if not 3 <= len(low) <= self.longest:
            return token, 0
        letters = low.isalpha()
        have = self.df.get(low, 0)
        if letters and have and have * RATIO >= self.top:
            return token, 0
        best, best_df, changes = token, max(have * RATIO, 0), 0
        if not letters:
            core = low.strip("@!+|$")
            if core.isalpha() and (self.df.get(core, 0) and (core == low or low.endswith("!"))):
                return token, 0
            signs = [i for i, c in enumerate(low) if c in SIGNS]
            if any(not c.isalpha() and c not in SIGNS for c in low) or len(signs) * 2 > len(low):
                return token, 0
            for pick in product(*(SIGNS[low[i]] for i in signs)):
                w = list(low)
                for i, c in zip(signs, pick):
                    w[i] = c
                for k, (cand, n) in enumerate(self._letters("".join(w), len(low) // 3 - len(signs))):
                    if (f := self.df.get(cand, 0)) > best_df or f and f == best_df and len(signs) + n < changes:
                        best, best_df, changes = cand, f, len(signs) + n
                    if k == 0 and f:
                        break
        else:
            for cand, n in self._letters(low, max(1, len(low) // 3)):
                if n and (f := self.df.get(cand, 0)) > best_df:
                    best, best_df, changes = cand, f, n
        if not changes or best_df < MIN_DOCS:
            return token, 0
        if token[:1].isupper():
            best = best[:1].upper() + best[1:]
        return (best.upper() if token.isupper() and len(token) > 1 else best), changes

    @staticmethod
    def _letters(w: str, most: int) -> Iterator[tuple[str, int]]:
        """The word itself, then with one letter confusion undone, then two; `most` keeps short words from turning into any other."""
        yield w, 0
        if most < 1:
            return
        once: dict[str, None] = {}
        for x in Scanner._undone(w):
            if x not in once:
                once[x] = None
                yield x, 1
        if most < 2:
            return
        twice = set(once) | {w}
        for x in once:
            for y in Scanner._undone(x):
                if y not in twice:
                    twice.add(y)
                    yield y, 2

    @staticmethod
    def _undone(w: str) -> Iterator[str]:
        for seen, was in LETTERS:
            i = w.find(seen)
            while i >= 0:
                yield w[:i] + was + w[i + len(seen) :]
                i = w.find(seen, i + 1)

    def join(self, left: str, right: str, mark: str) -> str | None:
        """The whole word, if the two ends of neighbouring lines are its parts."""
        whole = left + right
        if not (_PLAIN.fullmatch(whole) and right[:1] == right[:1].lower()):
            return None
        n = self.known(whole)
        if not n:
            n = self.known(self.undo(whole)[0])
        if mark in ("¬", "\u00ad"):
            return whole
        l, r = self.known(left), self.known(right)
        if mark:
            # a compound of its own has parts that are words, and its closed form is none
            return whole if n >= max(1, min(l, r) // 4) or not (l and r) else None
        if n >= MIN_DOCS and (n > RATIO * l or n > RATIO * r):
            return whole
        return None

    def __call__(self, text: str | None) -> tuple[list[str], str | None]:
        """(defects, repaired text)."""
        if not text or "\n" not in text:
            return [], text
        if not text.isascii():
            text = _HIDDEN.sub("", text)
        lines = text.split("\n")
        numbers = page_numbers(lines)
        wrapped = is_wrapped(lines)
        if not wrapped and not numbers:
            return [], text
        furniture = headers(lines, numbers, wrapped)
        defects = []
        if numbers:
            defects.append("page_number")
        if furniture:
            defects.append("running_header")
        out, split, wrong = self._flow(lines, numbers | furniture, wrapped)
        if split and wrapped:
            defects.append("split_word")
        if wrong >= MISREAD and wrapped:
            defects.append("misread")
        return defects, out if defects else text

    def _flow(self, lines: list[str], drop: set[int], wrapped: bool) -> tuple[str, int, int]:
        """Joined paragraphs, number of words cut, number of misread characters."""
        paragraphs: list[str] = []
        now, split, wrong = "", 0, 0
        gap = page = fenced = False  # a blank line, page furniture since the last line

        def close() -> None:
            nonlocal now, wrong
            if now:
                now, n = self._line(now)
                wrong += n
                paragraphs.append(now)
            now = ""

        for i, line in enumerate(lines):
            if i in drop:
                page = True
                continue
            s = line.strip()
            if not s:
                gap = True
                continue
            fence = s.startswith(("```", "~~~"))
            if not wrapped or fenced or fence or _MARKUP.search(line):
                fenced ^= fence
                close()
                paragraphs.append(line.rstrip())
                gap = page = False
                continue
            if now and gap and not (page and not _END.search(now)):
                close()
            if not now:
                now = s
            else:
                now, cut = self._append(now, s)
                split += cut
            gap = page = False
        close()
        return "\n\n".join(paragraphs), split, wrong

    def _append(self, now: str, s: str) -> tuple[str, int]:
        end = now[-60:]
        tail, head = _TAIL.search(end), _HEAD.match(s)
        if tail and head:
            left, mark, right = tail.group(1), tail.group(2).replace("‐", "-"), head.group()
            after_hyphen = end[: tail.start()].endswith("-")
            if not (after_hyphen and mark == "-") and (whole := self.join(left, right, mark)):
                return now[: len(now) - len(end) + tail.start()] + whole + s[head.end() :], 1
            if mark:
                return now + s, 0
        if _HAN.search(now[-1]) or _HAN.search(s[0]) or now[-1] in "，。；：、" or s[0] in "，。；：、）":
            return now + s, 0
        return now + " " + s, 0

    def _line(self, s: str) -> tuple[str, int]:
        wrong = 0
        if not s.isascii() and _HAN.search(s):
            new = list(s)
            for i, c in enumerate(s):
                if c in HAN:
                    alt = HAN[c]
                    a, b = s[i - 1 : i], s[i + 1 : i + 2]
                    have = max(self.df.get(a + c, 0) if a else 0, self.df.get(c + b, 0) if b else 0)
                    could = max(self.df.get(a + alt, 0) if a else 0, self.df.get(alt + b, 0) if b else 0)
                    if could >= MIN_DOCS and could > RATIO * have:
                        new[i] = alt
                        wrong += 1
            s = "".join(new)

        def number(m: re.Match) -> str:
            nonlocal wrong
            wrong += sum(c in "OlI" for c in m.group())
            return m.group().replace("O", "0").replace("l", "1").replace("I", "1")

        s = _NUMBER.sub(number, s)

        def token(m: re.Match) -> str:
            nonlocal wrong
            t = m.group()
            if t.isalpha() and (have := self.df.get(t.lower(), 0)) and have * RATIO >= self.top:
                return t
            if t.isupper() and len(t) < 4 or t.isdigit():
                return t
            new, n = self.undo(t)
            wrong += n
            return new

        return _LATIN_TOKEN.sub(token, s), wrong


#: Stands for every record among the counted words; no word has this form.
_RECORDS = " "


def vocabulary(md_corpus: DataFrame, share: float = VOCABULARY_SHARE) -> dict[str, int]:
    """Document frequency of the words of at least `share` of the records; its size is bounded, see above."""

    def make():
        def run(texts) -> Iterator[tuple]:
            count: Counter[str] = Counter()
            for t in texts:
                count.update(words(t) if t else ())
                count[_RECORDS] += 1
            yield from count.items()

        return run

    counted = map_batches(md_corpus.select("body"), make, "word string, n bigint", rows=8192)
    spark = md_corpus.sparkSession
    shared_dir(spark)
    # counted once and written: the number of records, which the threshold needs, stands among the words
    totals = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_DOCS).checkpoint()
    records = (totals.where(F.col("word") == _RECORDS).agg(F.max("n").alias("n")).first() or {"n": 0})["n"] or 0
    least = max(MIN_DOCS, round(share * records))
    return {r["word"]: r["n"] for r in totals.where((F.col("n") >= least) & (F.col("word") != _RECORDS)).toLocalIterator()}


def scan(md_corpus: DataFrame, vocab: dict[str, int] | None = None, every: bool = False) -> DataFrame:
    """(doc_id, defects, repaired) of the records with a defect; with every=True of all rows, unchanged where there is none."""
    shared = md_corpus.sparkSession.sparkContext.broadcast(vocabulary(md_corpus) if vocab is None else vocab)

    def make():
        see = Scanner(shared.value)

        def run(ids, texts) -> Iterator[tuple]:
            for i, t in zip(ids, texts):
                defects, new = see(t)
                if defects:
                    yield i, defects, new
                elif every:
                    yield i, [], t

        return run

    rows = md_corpus.select("doc_id", "body")
    return map_batches(rows if every else rows.where(F.col("doc_id").isNotNull() & F.col("body").isNotNull()), make, "doc_id bigint, defects array<string>, repaired string")
