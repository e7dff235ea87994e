"""Personal information inside free text (problem 10): a character-level bidirectional LSTM with CRF transitions, in numpy.

The weights are fitted by p10_train on spans that it writes by rule, and lie beside this module (WEIGHTS).

A decoded span becomes a row only if an exact check finds the value in it: an at-sign in some spelling, enough digits in a row, a number beside a capitalised
word, two capitalised words of any script that only a name's punctuation or particles part, Han characters. So a stretch of text without any such place (stretches())
cannot give a row whatever the network says, and is not run through it; every other stretch is, with its surroundings, and is decoded by Viterbi. What the
checks cannot confirm is not found: names in scripts that have neither capitals nor Han characters, and names all in small letters.

Long stretches are covered by overlapping windows, which are reconciled over the text: at a seam each character takes the label of the window in
which it stands further from the edge, neighbouring characters of a kind form one span, and a span that is cut by a seam closes again. The check
then grows a span of a numeric kind to the whole number or address it touches and derives its value.

Null and empty texts hold nothing. Whole texts are covered, whatever their length. Repeated rows repeat; found rows are distinct.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

KINDS = ("email", "phone", "id_number", "address", "name")
TAGS = len(KINDS) + 1
#: Characters of a window, and those at either end that another window decides.
WINDOW, MARGIN = 768, 24
EMBED, HIDDEN = 16, 20
VOCAB = 512
#: Characters before and after a place that a value may stand at; stretches that come nearer than JOIN are one.
BEFORE, AFTER, JOIN = 40, 40, 16
#: Characters that run through the network at once; texts that are looked at together have at most about CHARS, in ROWS rows.
BATCH = 300_000
CHARS, ROWS = 8_000_000, 4096
#: Weights as p10_train fitted them.
WEIGHTS = Path(__file__).with_name("p10_weights.npz")

_EXT_LOWER, _EXT_UPPER, _PUNCT, _OTHER, _HAN0 = 100, 101, 102, 103, 112


@lru_cache(70_000)
def _char_id(c: str) -> int:
    o = ord(c)
    if o < 128:
        return max(1, o - 30) if o >= 32 else 1
    if 0x4E00 <= o <= 0x9FFF:
        return _HAN0 + o * 40503 % 65536 % (VOCAB - _HAN0)
    if own := {"，": 104, "。": 105, "：": 106, "、": 107, "（": 108, "）": 109}.get(c):
        return own
    if c.isspace():
        return 2
    if 0xFF01 <= o <= 0xFF5E:  # full-width forms
        return _char_id(unicodedata.normalize("NFKC", c))
    if c.isalpha():
        return _EXT_UPPER if c.isupper() else _EXT_LOWER
    return _PUNCT if not c.isalnum() else _OTHER


_TABLE = np.array([_char_id(chr(o)) for o in range(0x10000)], np.int16)


def char_ids(text: str) -> np.ndarray:
    o = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _TABLE[np.where(o < 0x10000, o, 0xFFFD)]


# --------------------------------------------------------------------------------------------------------------------------- network


class Net:
    """Weights: embedding, two LSTM directions (stacked on axis 0), emission, transition."""

    NAMES = ("embed", "wx", "wh", "b", "we", "be", "trans")

    def __init__(self, seed: int = 1, weights: dict[str, np.ndarray] | None = None):
        if weights is not None:
            for k in self.NAMES:
                setattr(self, k, weights[k])
            return
        g = np.random.default_rng(seed)
        n = lambda *s, scale: (g.standard_normal(s) * scale).astype(np.float32)
        self.embed = n(VOCAB, EMBED, scale=0.3)
        self.wx = n(2, EMBED, 4 * HIDDEN, scale=1 / np.sqrt(EMBED))
        self.wh = n(2, HIDDEN, 4 * HIDDEN, scale=1 / np.sqrt(HIDDEN))
        self.b = np.zeros((2, 1, 4 * HIDDEN), np.float32)
        self.b[:, :, HIDDEN : 2 * HIDDEN] = 1  # forget gate
        self.we = n(2, HIDDEN, TAGS, scale=0.3)
        self.be = np.zeros(TAGS, np.float32)
        self.trans = np.zeros((TAGS, TAGS), np.float32)

    def weights(self) -> dict[str, np.ndarray]:
        return {k: getattr(self, k) for k in self.NAMES}

    def save(self, path: str) -> None:
        np.savez_compressed(path, **self.weights())

    @classmethod
    def load(cls, path: str | Path = WEIGHTS) -> Net:
        with np.load(path) as f:
            return cls(weights={k: f[k] for k in cls.NAMES})

    def _tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Per direction and gate: what each character adds, and the recurrent weights. Gates in the order input, forget, output, cell.

        tanh serves all gates, as sigmoid(z) = (tanh(z / 2) + 1) / 2; so the first three are halved. The output is kept twice as large, without the last halving,
        so what it is multiplied with is halved as well."""
        half = np.ones(4 * HIDDEN, np.float32)
        half[: 3 * HIDDEN] = 0.5
        apart = lambda m: np.ascontiguousarray(m.reshape(2, -1, 4, HIDDEN).transpose(0, 2, 1, 3))
        return apart((np.matmul(self.embed[None], self.wx) + self.b) * half), apart(self.wh * half * np.float32(0.5))

    def emissions(self, x: np.ndarray, length: np.ndarray) -> np.ndarray:
        """(windows, places, tags); each row of x has `length` characters, read forward and, from its own last one on, backward."""
        n, top = x.shape
        table, wh = self._tables()
        half_we = self.we * np.float32(0.5)
        place = np.arange(top)
        mirror = np.maximum(length[:, None] - 1 - place[None, :], 0)
        inside = place[None, :] < length[:, None]
        rows = (x, np.where(inside, np.take_along_axis(x, mirror, 1), 0))
        out = np.empty((2, top, n, TAGS), np.float32)
        z, add = np.empty((4, n, HIDDEN), np.float32), np.empty((4, n, HIDDEN), np.float32)
        hs = np.empty((16, n, HIDDEN), np.float32)
        for d in (0, 1):
            h, c, th = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32), np.empty((n, HIDDEN), np.float32)
            chars = np.ascontiguousarray(rows[d].T.astype(np.int64))
            for t in range(top):
                np.take(table[d], chars[t], axis=1, out=add, mode="clip")
                np.matmul(h, wh[d], out=z)
                z += add
                np.tanh(z, out=z)
                gates = z[:3]
                gates += 1
                z[3] *= z[0]
                c *= z[1]
                c += z[3]
                c *= 0.5
                np.tanh(c, out=th)
                h = np.multiply(th, z[2], out=hs[t % 16])
                if t % 16 == 15 or t == top - 1:
                    lo = t - t % 16
                    np.matmul(hs[: t + 1 - lo], half_we[d], out=out[d, lo : t + 1])
        e = out[0].transpose(1, 0, 2) + self.be
        e += np.take_along_axis(out[1].transpose(1, 0, 2), mirror[:, :, None], 1)
        return e

    def decode(self, x: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Best tags of every window by Viterbi, traced only where an excursion from "none" can pay. An excursion over some places gains at most the sum of S over
        them plus c, where S is the lead of the best tag over "none" and the best inner transition, and c the best way in and out; so a place through which no
        excursion has a positive bound has "none" on the best path, and the chain is exactly cut there."""
        n, top = x.shape
        e = self.emissions(x, length)
        t = self.trans
        inner, way_in, way_out = float(t[1:, 1:].max()), float(t[0, 1:].max()), float(t[1:, 0].max())
        inside = np.arange(top)[None, :] < length[:, None]
        gain = np.where(inside, e[:, :, 1:].max(2) - e[:, :, 0] + (inner - t[0, 0]), -1e6).astype(np.float64)
        ends = length - 1
        gain[:, 0] += max(0.0, t[0, 0] - way_in)  # at an edge there is no way in, or out, to pay for
        gain[np.arange(n), ends] += max(0.0, t[0, 0] - way_out)
        total = np.cumsum(gain, 1)
        before = total - np.minimum.accumulate(np.concatenate([np.zeros((n, 1)), total[:, :-1]], 1), 1)
        after = np.maximum.accumulate(total[:, ::-1], 1)[:, ::-1] - total + gain
        open_ = inside & (before + after - gain + (way_in + way_out - inner - t[0, 0]) > 0)
        path = np.zeros((n, top), np.int8)
        edge = np.diff(np.pad(open_, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        (row, lo), (_, hi) = np.nonzero(edge == 1), np.nonzero(edge == -1)
        size = hi - lo
        order = np.argsort(size, kind="stable")
        at = 0
        while at < len(order):
            most = int(size[order[at]] * 1.3) + 4
            end = min(at + int(np.searchsorted(size[order[at:]], most, side="right")), at + max(1, 400_000 // most))
            part, at = order[at:end], end
            self._trace(e, path, row[part], lo[part], size[part], length)
        return path

    def _trace(self, e: np.ndarray, path: np.ndarray, row: np.ndarray, lo: np.ndarray, size: np.ndarray, length: np.ndarray) -> None:
        """Viterbi over runs of places; what is beside a run within its window has tag "none"."""
        top = int(size.max())
        where = lo[:, None] + np.minimum(np.arange(top)[None, :], size[:, None] - 1)
        s = e[row[:, None], where]
        t = self.trans
        best = s[:, 0] + np.where((lo > 0)[:, None], t[0][None], 0)
        after = np.where((lo + size < length[row])[:, None], t[:, 0][None], 0)
        back = np.zeros((top, len(row), TAGS), np.int8)
        for k in range(1, top):
            both = best[:, :, None] + t[None]
            back[k] = both.argmax(1)
            live = k < size
            best = np.where(live[:, None], both.max(1) + s[:, k], best)
        cur = (best + after).argmax(1)
        got = np.zeros((len(row), top), np.int8)
        every = np.arange(len(row))
        for k in range(top - 1, -1, -1):
            got[:, k] = cur
            cur = np.where(k < size, back[k][every, cur], cur)
        inside = np.arange(top)[None, :] < size[:, None]
        path[np.broadcast_to(row[:, None], inside.shape)[inside], where[inside]] = got[inside]


# ------------------------------------------------------------------------------------------------------------------------- detection

# Capitalised words that begin sentences; beside a name they are no part of it.
_STARTERS = "Der|Die|Das|Den|Dem|Ein|Eine|Im|In|Am|An|Laut|Nach|Vor|Für|Seit|Bei|Mit|Wie|Gemäß|Binnen|Zum|Zur|Auf|Aus|Und|Teil|Bericht|Vermerk|Akte|Woche|Standort|Protokoll|Fassung|The|This|That|For|From|With|When|If|As|Le|La|Les|Un|Une|Des|Du|Pour|Dans|Selon|Depuis|Report|Review|Notes"
_AT = r"\s{0,2}(?:@|＠|\[at\]|\(at\)|\{at\}| at )\s{0,2}"
_DOT = r"(?:\.|\s?[\[({]dot[\])}]\s?| dot )"
_EMAIL = re.compile(rf"[\w+-]+(?:{_DOT}[\w+-]+)*{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+", re.I | re.A)
_PHONE = re.compile(r"(?<![\w-])(?<!\d[./-])\+?\(?\d(?:[\d()./-]|[ \u00a0](?=[\d(]))*\d(?![\w])", re.A)
_PHONE_CUT = re.compile(r"(?<![\w-])(?<!\d[./-])\+?\(?\d(?:[\d()./-]|[ \n](?=[\d(]))*\d(?![\w])", re.A)
_IP = re.compile(r"\d{1,3}(?:\.\d{1,3}){3}")
# Small words within names.
_PARTICLES = {"von", "van", "de", "du", "des", "la", "le", "der", "den", "di", "da", "zu", "zur", "of", "al", "el", "bin", "dos", "ten", "af"}
#: A capital of any script.
_CAPITAL = "".join(chr(o) for o in range(0x80, 0x10000) if chr(o).isupper())
_CAPITAL = f"[A-Z{_CAPITAL}]"
# The patterns begin with the sign that they look for, and look back after it: so a text is scanned fast.
_SMALL = rf"(?:(?:{'|'.join(sorted(_PARTICLES))})\s)*"
#: Two capitalised words, or an initial and one, with nothing between but what names have.
_PAIR = re.compile(rf"{_CAPITAL}(?<!\w.)[\w'’-]*(?:,?\s{{1,3}}|\.\s{{0,3}}){_SMALL}{_CAPITAL}")
#: A house number before or behind a capitalised word (with small words between, as in streets of Romance languages), or within Han characters.
_NUMBER_FIRST = rf"\d(?<![\w-].)\d{{0,3}}[A-Za-z]?(?: bis| ter)?,?\s(?:[a-zß-ÿ'’]+[\s'’]){{0,4}}{_CAPITAL}"
_HOUSE = re.compile(rf"{_NUMBER_FIRST}|{_CAPITAL}[\w'’.-]*\s{{1,2}}\d{{1,4}}[A-Za-z]?\b|[㐀-鿿]\s?\d{{1,4}}\s?[㐀-鿿]")
_CAPITAL_PLACE = re.compile(rf"{_CAPITAL}(?<!\w.)[\w'’.-]*(?:(?<=\.)|,?\s{{1,3}})(?:\d{{1,4}}[A-Za-z]?\b|{_SMALL}{_CAPITAL})")
_NUMBER_PLACE = re.compile(_NUMBER_FIRST)
_DIGITS = re.compile(r"\d[\d()（）+./\s\u00a0-]{3,}\d")
_AT_PLACE = re.compile(r"[@＠\[({](?:(?<=[@＠])|\s?at\s?[\])}])", re.I)
_AT_WORD = re.compile(r"\sat\s(?=.{1,80}\sdot\s)", re.I)
_HAN_RUN = re.compile("[㐀-鿿]+")


def stretches(text: str) -> list[tuple[int, int]]:
    """Where a value can stand, with its surroundings: (start, end), in order and apart. Outside of them no exact check can succeed."""
    found = [m.span() for p in (_AT_PLACE, _CAPITAL_PLACE, _NUMBER_PLACE) for m in p.finditer(text)]
    for m in _DIGITS.finditer(text):
        n = sum(map(str.isdigit, m.group()))
        if n >= 7 or n >= 5 and text[max(0, m.start() - 2) : m.start()].rstrip(" ")[-1:].isupper():
            found.append(m.span())
    if " dot " in text or " DOT " in text or " Dot " in text:
        found += [m.span() for m in _AT_WORD.finditer(text)]
    if not text.isascii():
        found += [m.span() for m in _HAN_RUN.finditer(text)]
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        a, b = max(0, a - BEFORE), min(len(text), b + AFTER)
        if out and a - out[-1][1] < JOIN:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


_ID = re.compile(r"(?<![A-Za-z0-9])(?:(?<!-)[A-Z]{1,2} ?)?\d(?:\d|[ -](?=\d))*\d(?: ?[A-DX](?![A-Za-z]))?(?![0-9])", re.A)
_ID_CUT = re.compile(r"(?<![A-Za-z0-9])(?:(?<!-)[A-Z]{1,2}[ \n]?)?\d(?:\d|[ \n-](?=\d))*\d(?:[ \n]?[A-DX](?![A-Za-z]))?(?![0-9])", re.A)
_ID_DASH = re.compile(r"\d{3}-\d{2}-\d{4}")
# Small words within names.
_AFTER_NAME = "称的审提签整表说认在核记负于已将和与及曾未同"
_BEFORE_NAME = "据由人者经与和及向请给为是叫"
_STARTER_SET = set(_STARTERS.split("|"))
_WORD_BEFORE = re.compile(r"(?<![\w:'’-])([A-ZÀ-Þ](?:[\w'’-]*[a-zß-ÿ]|\.)),? \Z")
_WORD_AFTER = re.compile(r"(,? (?:[A-Z]\. )?[A-ZÀ-Þ][\w'’-]*[a-zß-ÿ])(?= ?[|\n,.;:]|\Z)")
_BULLET = re.compile(r"\s*(?:[*+•#>-]|\d+[.)])+\s*")


def email_value(s: str) -> str:
    s = re.sub(rf"{_AT}", "@", s.strip(), flags=re.I)
    s = re.sub(r"\s?[\[({]dot[\])}]\s?| dot ", ".", s, flags=re.I)
    return re.sub(r"\s", "", s).lower()


class Finder:
    def __init__(self, net: Net):
        self.net = net

    def tags(self, texts: list[str]) -> list[np.ndarray]:
        """A tag for each character of each text: every stretch is covered by windows, and windows of like length run together."""
        out = [np.zeros(len(t), np.int8) for t in texts]
        step = WINDOW - 2 * MARGIN
        # text, first and last character, whether another window of the stretch lies before and after
        where = []
        for n, t in enumerate(texts):
            for lo, hi in stretches(t):
                for at in range(lo, max(lo + 1, hi - 2 * MARGIN), step):
                    end = min(at + WINDOW, hi)
                    where.append((n, at, end, at > lo, end < hi))
        where.sort(key=lambda w: w[2] - w[1])
        ids = {n: char_ids(texts[n]) for n in {w[0] for w in where}}
        at = 0
        while at < len(where):
            end = at + 1
            while end < len(where) and (end + 1 - at) * (where[end][2] - where[end][1]) < BATCH:
                end += 1
            part, at = where[at:end], end
            length = np.array([hi - lo for _, lo, hi, _, _ in part])
            x = np.zeros((len(part), int(length[-1])), np.int16)
            for row, (n, lo, hi, _, _) in zip(x, part):
                row[: hi - lo] = ids[n][lo:hi]
            path = self.net.decode(x, length)
            for r in np.flatnonzero(path.any(1)):
                n, lo, hi, more_before, more_after = part[r]
                first, last = lo + MARGIN * more_before, hi - MARGIN * more_after
                out[n][first:last] = path[r, first - lo : last - lo]
        return out

    def __call__(self, texts: list[str]) -> list[list[tuple[int, int, str, str]]]:
        """(start, end, kind, value) of each text, without overlaps."""
        out: list[list[tuple[int, int, str, str]]] = []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= CHARS):
                size += len(texts[end])
                end += 1
            out += [self.spans(t, g) for t, g in zip(texts[at:end], self.tags(texts[at:end]))]
            at = end
        return out

    def spans(self, text: str, tags: np.ndarray) -> list[tuple[int, int, str, str]]:
        if not tags.any():
            return []
        cut = np.flatnonzero(np.diff(np.concatenate([[0], tags, [0]])))
        raw = [(int(a), int(b), int(tags[a])) for a, b in zip(cut[:-1], cut[1:]) if tags[a]]
        merged: list[list[int]] = []
        for a, b, k in raw:  # a gap of one or two signs within a kind closes
            if merged and merged[-1][2] == k and a - merged[-1][1] <= 2 and not re.search(r"[|\n;，。]", text[merged[-1][1] : a]):
                merged[-1][1] = b
            else:
                merged.append([a, b, k])
        found: list[tuple[int, int, str, str]] = []
        for a, b, k in merged:
            for span in self.exact(text, a, b, KINDS[k - 1]):
                if all(span[1] <= f[0] or f[1] <= span[0] for f in found):
                    found.append(span)
        return sorted(found)

    def exact(self, text: str, a: int, b: int, kind: str) -> Iterator[tuple[int, int, str, str]]:
        """The whole values that a decoded span touches."""
        lo, hi = max(0, a - 60), min(len(text), b + 60)
        if kind == "email":
            for m in _EMAIL.finditer(text, lo, hi):
                if m.end() > a and m.start() < b:
                    yield m.start(), m.end(), kind, email_value(re.sub(r"^mailto:", "", m.group()))
        elif kind == "phone":
            for form in (_PHONE, _PHONE_CUT) if "\n" in text[a:b] else (_PHONE,):  # a number cut at a line end only where it has too few digits
                got = False
                for m in form.finditer(text, lo, hi):
                    digits = re.sub(r"\D", "", m.group())
                    if min(m.end(), b) - max(m.start(), a) >= 4 and 7 <= len(digits) <= 16 and not _IP.fullmatch(m.group()):
                        got = True
                        yield m.start(), m.end(), kind, digits
                if got:
                    break
        elif kind == "id_number":
            for form in (_ID, _ID_CUT) if "\n" in text[a:b] else (_ID,):
                got = False
                for m in form.finditer(text, lo, hi):
                    value = re.sub(r"[^0-9A-Z]", "", m.group())
                    dashed = "-" in m.group() and not _ID_DASH.fullmatch(m.group())
                    if min(m.end(), b) - max(m.start(), a) >= 4 and 8 <= len(value) <= 19 and not dashed:
                        got = True
                        yield m.start(), m.end(), kind, value
                if got:
                    break
        else:
            while a < b and (text[a].isspace() or text[a] in ",.|，。：:;"):
                a += 1
            while b > a and (text[b - 1].isspace() or text[b - 1] in ",|，。：:;"):
                b -= 1
            if kind == "address":
                if b - a >= 6 and _HOUSE.search(text, a, min(len(text), b + 1)):
                    yield a, b, kind, ""
            elif kind == "name":
                a, b = self.whole_name(text, a, b)
                s = text[a:b]
                words = re.findall(r"[^\W\d_][\w'’-]*", s)
                han = re.search("[一-鿿]", s)
                line = text.rfind("\n", 0, a) + 1
                if han:  # a word of a sentence or an item of a list is no name by itself
                    before, after = text[a - 1 : a], text[b : b + 1]
                    if "一" <= before <= "鿿" and before not in _BEFORE_NAME or "一" <= after <= "鿿" and after not in _AFTER_NAME or _BULLET.fullmatch(text[line:a]) or text[line : line + 1] == "|" and text[line:a].rstrip().endswith("|"):
                        return
                elif not _PAIR.search(text, a, b):
                    return
                elif any(w[0].islower() and w.lower() not in _PARTICLES for w in words) or re.search(r"\b[A-Z]{2}\b", s) and not re.search(r"[A-ZÀ-Þ]{4}", s):
                    return
                if not re.search(r"\d|@", s) and (2 <= len(s) <= 4 if han else len(words) >= 2 and sum(w[0].isupper() for w in words) >= 2 and len(s) >= 5):
                    yield a, b, kind, ""


    @staticmethod
    def whole_name(text: str, a: int, b: int) -> tuple[int, int]:
        """A decoded part of a name grown to the whole one: the capitalised words and initials beside it on its line, or the family name before
        two characters."""
        if "一" <= text[a : a + 1] <= "鿿":
            han = lambda i: 0 <= i < len(text) and "一" <= text[i] <= "鿿"
            if b - a == 2 and han(a - 1) and text[a - 1] not in _BEFORE_NAME and not (han(a - 2) and text[a - 2] not in _BEFORE_NAME):
                a -= 1
            elif b - a == 2 and han(b) and text[b] not in _AFTER_NAME and not (han(b + 1) and text[b + 1] not in _AFTER_NAME):
                b += 1
            return a, b
        while a and text[a - 1].isalpha():
            a -= 1
        while b < len(text) and (text[b].isalpha() or text[b] in "'’-" and text[b + 1 : b + 2].isalpha()):
            b += 1
        for _ in range(2):
            if (m := _WORD_BEFORE.search(text, max(0, a - 30), a)) and m.group(1) not in _STARTER_SET:
                a = m.start(1)
        for _ in range(2):
            if m := _WORD_AFTER.match(text, b):
                b = m.end(1)
        return a, b


def find(documents: DataFrame, net: Net | None = None) -> DataFrame:
    """(doc_id, kind, value) of every value found; a row for each place."""
    shared = documents.sparkSession.sparkContext.broadcast(net or Net.load())  # tens of kB, whatever the input

    def make():
        finder = Finder(shared.value)

        def run(ids, texts) -> Iterator[tuple]:
            for i, spans in zip(ids, finder(texts)):
                for _, _, kind, value in spans:
                    yield i, kind, value

        return run

    return map_batches(documents.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text"), make, "doc_id bigint, kind string, value string", ROWS)


def redact(documents: DataFrame, net: Net | None = None) -> DataFrame:
    """(doc_id, text): texts with <KIND> in the place of each value, a row for each row."""
    shared = documents.sparkSession.sparkContext.broadcast(net or Net.load())  # tens of kB, whatever the input

    def make():
        finder = Finder(shared.value)

        def run(ids, texts) -> Iterator[tuple]:
            for i, t, spans in zip(ids, texts, finder([t or "" for t in texts])):
                if t is None:
                    yield i, None
                    continue
                out, at = [], 0
                for a, b, kind, _ in spans:
                    out += [t[at:a], f"<{kind.upper()}>"]
                    at = b
                yield i, "".join([*out, t[at:]])

        return run

    return map_batches(documents.select("doc_id", "text"), make, "doc_id bigint, text string", ROWS)
