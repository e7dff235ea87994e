"""Garbled text from a wrong character encoding (problem 7): round-trip repair.

A stretch of text that was decoded with the wrong encoding is encoded again under that candidate and strictly decoded as the intended one. The result
is accepted only when the garbling cost of the stretch drops; layers are peeled one by one until no candidate lowers the cost.

Three families of damage are tried:

* UTF-8 read as a single-byte encoding: every stretch of characters that form well-formed UTF-8 under the candidate;
* double-byte Chinese read as Latin-1 / Windows-1252, and UTF-8 read as GB18030: maximal runs of non-ASCII characters;
* single-byte Western text read as another single-byte encoding: word by word, as such damage replaces one letter by one sign.

What has been replaced for good (U+FFFD, or the three-character mark that two such readings leave behind) is found and reported as not recoverable.
Null and empty texts are no cases and come back unchanged; texts of any length are scanned whole; repeated rows give repeated rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame

from .common import map_batches

#: Single-byte encodings under which UTF-8 is looked for.
SINGLE_BYTE = ("cp1252", "latin-1", "cp1251", "mac_roman", "cp437", "cp850")
#: (shown as, was): single-byte Western text under another single-byte encoding.
WESTERN = (("cp437", "cp1252"), ("mac_roman", "cp1252"), ("cp850", "cp1252"))
#: What U+FFFD in UTF-8, read as GBK, looks like.
LOST_MARK = "锟斤拷"


def byte_table(codec: str) -> dict[str, int]:
    """Character -> byte; bytes that the encoding leaves undefined stand for themselves, as lenient decoders have it."""
    table = {}
    for b in range(0x80, 0x100):
        try:
            table[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            table[chr(b)] = b
    return table


def _plausible(ch: str) -> bool:
    o = ord(ch)
    return (
        0xC0 <= o <= 0xFF and ch not in "ÃÂÐÞþð×÷"
        or ch in "œŒŸ"
        or o in (0xA0, 0xA7, 0xAB, 0xB0, 0xB1, 0xB7, 0xBB, 0xD7, 0xF7, 0x20AC, 0x2026)
        or 0x2013 <= o <= 0x201E
        or 0x2018 == o
        or 0x3001 <= o <= 0x3011
        or 0xFF01 <= o <= 0xFF5E
        or 0x4E00 <= o <= 0x9FA5 and _common_han(ch)
        or 0x1F300 <= o <= 0x1FAFF
    )


@lru_cache(30_000)
def _common_han(ch: str) -> bool:
    try:
        return len(ch.encode("gb2312")) == 2
    except UnicodeEncodeError:
        return False


@lru_cache(70_000)
def _weight(ch: str) -> int:
    return 0 if ch < "\x80" else 1 if _plausible(ch) else 3


def garbling_cost(text: str) -> int:
    """0 for ASCII, 1 a usual character of the corpus languages, 3 any other."""
    return sum(map(_weight, text))


_BROKEN_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ](?=[㐀-鿿])|[㐀-鿿](?=[A-Za-zÀ-ÖØ-öø-ÿ])")


def cost_beside(text: str, before: str, after: str) -> int:
    """garbling_cost of a stretch, and 2 for each place where a Latin letter and a Han character stand together, its neighbours included."""
    return garbling_cost(text) + 2 * len(_BROKEN_WORD.findall(before + text + after))


class _Utf8Under:
    """UTF-8 that was read as one single-byte encoding."""

    def __init__(self, codec: str):
        table = byte_table(codec)
        self.nested = codec in ("cp1252", "latin-1")  # only these come in layers: a layer may leave odd characters
        self.table = {ord(c): chr(b) for c, b in table.items()}
        cls = lambda lo, hi: "[" + "".join(re.escape(c) for c, b in table.items() if lo <= b <= hi) + "]"
        tail = cls(0x80, 0xBF)
        self.find = re.compile(f"(?:{cls(0xC2, 0xDF)}{tail}|{cls(0xE0, 0xEF)}{tail}{{2}}|{cls(0xF0, 0xF4)}{tail}{{3}})+")
        #: The same, from the first character on: whether there is any such stretch.
        self.any = re.compile(f"{cls(0xC2, 0xF4)}(?:(?<={cls(0xC2, 0xDF)}){tail}|(?<={cls(0xE0, 0xEF)}){tail}{{2}}|(?<={cls(0xF0, 0xF4)}){tail}{{3}})").search

    def _one(self, m: re.Match) -> str:
        old = m.group()
        try:
            new = old.translate(self.table).encode("latin-1").decode("utf-8")
        except UnicodeError:
            return old
        if not self.nested and any(_weight(c) > 1 for c in new):
            return old
        return new if garbling_cost(new) < garbling_cost(old) else old

    def __call__(self, text: str) -> str:
        return self.find.sub(self._one, text) if self.any(text) else text


_HIGH = re.compile("[^\x00-\x7f]+")
_LATIN_RUN = re.compile("[\x80-\xff€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]{2,}")
_TO_LATIN = {ord(c): chr(b) for c, b in byte_table("cp1252").items()}


def _pairs(first: range, second: tuple[int, ...]) -> str:
    return "".join(re.escape(c) for x in first for y in second if len(c := bytes([x, y]).decode("gb18030", "ignore")) == 1)


#: Characters that the first two bytes of a three-byte UTF-8 sequence make under GBK: rare in real Chinese.
_LEAD3 = _pairs(range(0xE2, 0xEA), tuple(range(0x80, 0xC0)))
#: The same of two-byte sequences: common characters too, so they count beside Latin letters only.
_LEAD2 = _pairs(range(0xC3, 0xC6), tuple(range(0x80, 0xC0)))
_GBK_SIGN = re.compile(f"[{_LEAD3}{_LEAD2}](?:(?<=[{_LEAD3}])|(?<=[A-Za-z].)|[A-Za-z])")


#: Well-formed UTF-8, and a sequence that is cut at the end or whose beginning is lost.
_WHOLE = re.compile(rb"(?:[\x00-\x7f]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3})*")
_CUT_TAIL, _CUT_HEAD = re.compile(rb"[\xc2-\xf4][\x80-\xbf]{0,2}\Z"), re.compile(rb"[\x80-\xbf]{1,3}")


def _strict_utf8(raw: bytes, lost_before: bool, lost_after: bool) -> tuple[str, bool] | None:
    """(raw decoded strictly, whether a sequence was cut at the end); None where it does not decode. Beside a lost byte, the rest of the sequence that it
    belonged to is lost with it."""
    if lost_before and (m := _CUT_HEAD.match(raw)):
        raw = raw[m.end() :]
    end = _WHOLE.match(raw).end()
    cut = bool(end < len(raw) and lost_after and _CUT_TAIL.match(raw, end))
    try:
        return (raw[:end] if cut else raw).decode("utf-8"), cut
    except UnicodeDecodeError:
        return None


def utf8_under_gbk(text: str) -> str:
    """UTF-8 read as GB18030. Where the wrong reading lost a byte, U+FFFD stays; all else decodes strictly or is left as it is."""
    if not _GBK_SIGN.search(text):
        return text

    def part(old: str, before: str, after: str) -> str:
        try:
            got = _strict_utf8(old.encode("gb18030"), before == "\ufffd", after != "")
        except UnicodeEncodeError:
            return old
        if got is None or not got[0] or any(_weight(c) > 1 for c in got[0]):
            return old
        good, mark = got[0], "\ufffd" if got[1] and after != "\ufffd" else ""  # what stands behind the run was swallowed and broken
        if all(c < "\u0180" for c in good):
            return good + mark if cost_beside(good, before, after) < cost_beside(old, before, after) else old
        # Chinese for Chinese: three bytes a character became one and a half characters
        return good + mark if 2 * garbling_cost(good) < garbling_cost(old) + len(old) else old

    def one(m: re.Match) -> str:
        parts = [text[max(0, m.start() - 1) : m.start()], *re.split("(\ufffd+)", m.group()), text[m.end() : m.end() + 1]]
        return "".join(p if not p or p[0] == "\ufffd" else part(p, (parts[k - 1] or parts[max(0, k - 2)])[-1:], (parts[k + 1] or parts[min(len(parts) - 1, k + 2)])[:1]) for k, p in enumerate(parts[:-1]) if k)

    return _HIGH.sub(one, text)


def gbk_under_latin(text: str) -> str:
    """Double-byte Chinese read as Latin-1 or Windows-1252."""

    def one(m: re.Match) -> str:
        old = m.group()
        try:
            raw = old.translate(_TO_LATIN).encode("latin-1")
        except UnicodeEncodeError:
            return old
        for cut in (0, 1):
            try:
                new = raw[: len(raw) - cut].decode("gb18030") + old[len(old) - cut :]
            except UnicodeDecodeError:
                continue
            han = new[: len(new) - cut]
            if not han or sum(map(_common_han, han)) < 0.8 * len(han):
                continue
            # one or two characters might be letters of a Latin word: the cost has to halve, and no letter may touch them
            short = len(old) < 4 and (2 * garbling_cost(new) >= garbling_cost(old) or re.search("[A-Za-z]", m.string[max(0, m.start() - 1) : m.start()] + m.string[m.end() : m.end() + 1]))
            if not short and garbling_cost(new) < garbling_cost(old):
                return new
        return old

    return _LATIN_RUN.sub(one, text)


class _WesternUnder:
    """Western letters read under another single-byte encoding; accepted a word at a time."""

    #: Letters of German and French beyond ASCII.
    LETTERS = "äöüßÄÖÜéèêëàâçùûîïôœæÉÈÊÀÂÇÎÔÙÛŒ"

    def __init__(self, shown: str, was: str):
        pairs = {}
        for c in self.LETTERS:
            try:
                pairs[c.encode(was).decode(shown)] = c
            except UnicodeError:
                continue
        self.shown, self.was = shown, was
        signs = "".join(k for k, v in pairs.items() if k != v and not k.isspace() and not (k.isalpha() and k.isascii()))
        cls = "[" + re.escape(signs) + "]"
        letters = "A-Za-zÀ-ÖØ-öø-ÿœŒ"
        self.find = re.compile(f"(?:[{letters}]|{cls})*(?:[a-z]{cls}|{cls}[a-z])(?:[{letters}]|{cls})*")
        self.any = re.compile(f"{cls}(?:[a-z]|(?<=[a-z].))").search  # a sign beside a small letter: else there is nothing to find

    @staticmethod
    def cost(word: str) -> int:
        """Signs and letters of other scripts that touch letters, and capitals after small letters."""
        bad = 0
        for i, c in enumerate(word):
            if c.isascii():
                continue
            if not ("À" <= c <= "ÿ" or c in "œŒ") or c in "×÷":
                bad += 2
            elif c.isupper() and i and word[i - 1].islower():
                bad += 2
            elif c not in _WesternUnder.LETTERS:
                bad += 1
        return bad

    def _one(self, m: re.Match) -> str:
        old = m.group()
        try:
            new = old.encode(self.shown).decode(self.was)
        except UnicodeError:
            return old
        if self.cost(new) or not self.cost(old):  # the cost of the word has to fall to nothing
            return old
        changed = [(i, a) for i, (a, b) in enumerate(zip(old, new)) if a != b]
        # a ligature alone, or a dash or quotation mark at the edge of a word, is ordinary; so is an apostrophe within
        inner = [a for i, a in changed if 0 < i < len(old) - 1 and a not in "ﬂ’‘·-"]
        edge = [a for i, a in changed if i in (0, len(old) - 1) and a not in "ﬂ’‘“”„‚–—…«»°·£¿"]
        begins = not m.string[m.string.rfind("\n", 0, m.start()) + 1 : m.start()].strip("# ")
        if not inner and not edge and not (changed == [(0, "…")] and len(old) > 3 and begins):
            return old
        return new

    def __call__(self, text: str) -> str:
        return self.find.sub(self._one, text) if self.any(text) else text


class Repairer:
    """Scan and repair of one text at a time; holds the compiled candidates."""

    def __init__(self) -> None:
        self.steps = [_Utf8Under(c) for c in SINGLE_BYTE]
        self.steps += [gbk_under_latin, utf8_under_gbk]
        self.western = [_WesternUnder(*p) for p in WESTERN]
        # one cheap scan decides whether any single-byte candidate can apply
        tail = "\x80-¿€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
        # (a character beyond ASCII that is no Han one, and what makes it a sign: the scan stops at few characters)
        self.any_sign = re.compile(
            "[\x80-\u25ffﬂ\ufffd](?:(?<=[\x80-\x9f¡-¦¨-ª¬-¯²-¶¸-º¼-¿Ð×Þðþˆ-˿Ͱ-ӿ†-‥‧-₫₭-◿ﬂ\ufffd])"
            f"|(?<=[Â-ô])[{tail}]|(?<=[À-ÿ])[À-ÿ]{{2}}|(?<=…)[a-zß-ÿ]|(?<=‚)Ä|(?<=[a-zß-ÿ][À-ÖØ-Þ])|(?<=[„‰ÂÊÁËÈ])[Ä-ü])"
        )
        # what no right text holds: control characters, lead and tail of UTF-8 that do not decode
        self.left_sign = re.compile(f"[\x80-\x9f]|[ÃÂ][{tail}]|â[€‚„]|{LOST_MARK}")

    def layer(self, text: str) -> str:
        """One layer, by the candidate that lowers the garbling cost most."""
        return self._layer(text, self.any_sign.search(text) is not None)

    def _layer(self, text: str, signs: bool) -> str:
        best, best_cost = text, None
        for step in self.steps if signs else [utf8_under_gbk]:
            new = step(text)
            if new != text and (best_cost is None or garbling_cost(new) < best_cost):
                best, best_cost = new, garbling_cost(new)
        return best

    def western_layer(self, text: str) -> str:
        """One Western encoding undone, the one that leaves the least garbling cost."""
        tried = [(garbling_cost(new), k, new) for k, w in enumerate(self.western) if (new := w(text)) != text]
        return min(tried)[2] if tried else text

    def __call__(self, text: str | None) -> tuple[bool, bool, str | None]:
        """(is a case, all of it recovered, repaired text)."""
        if not text or text.isascii():
            return False, True, text
        new, seen = text, set()
        while new not in seen:  # until nothing changes; a text that comes back ends it as well
            seen.add(new)
            signs = self.any_sign.search(new) is not None
            if (peeled := self._layer(new, signs)) == new and signs:  # letters are for the time when no layer is left
                peeled = self.western_layer(new)
            new = peeled
        lost = "�" in text or "�" in new or LOST_MARK in text
        changed = new != text
        return lost or changed, not (lost or changed and self.left_sign.search(new)), new


def repair(fields: DataFrame, every: bool = False) -> DataFrame:
    """(doc_id, field, text) -> (doc_id, field, recovered, repaired) of the cases; with every=True of all rows, with recovered null where there is no case."""

    def make():
        fix = Repairer()

        def run(ids, names, texts) -> Iterator[tuple]:
            for i, n, t in zip(ids, names, texts):
                case, whole, new = fix(t)
                if case:
                    yield i, n, whole, new
                elif every:
                    yield i, n, None, t

        return run

    return map_batches(fields.select("doc_id", "field", "text"), make, "doc_id bigint, field string, recovered boolean, repaired string")
