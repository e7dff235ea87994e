"""Visually identical text with different characters (problem 5): confusables skeleton.

skeleton(text): decompose canonically, replace every character by its prototype from the look-alike table, decompose again. Two texts that look the
same have equal skeletons, so originals are grouped by it.

The table (prototypes()) is the public one of Unicode's security mechanisms, as the library that comes with Spark holds it (some 17,000
characters), asked for every assigned character once a session; compatibility forms of letters and digits, which that table leaves out in part, are
added by rule from the character database, and radicals without a decomposition, invisible characters and spaces from short lists.

The usual form of a text replaces a character by the usual one (ASCII letter or digit) that has the same prototype and is of the same kind (capital,
small, digit), keeps what is ordinary (letters of other scripts in words of their own script, accents, emoji, the record's punctuation), and has
the skeleton of the text. A field is a case if it differs from its usual form while the skeletons are equal.

Null and empty texts have no case and stay as they are; whole texts are scanned; equal texts in repeated rows share one group.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches
from .p07_encoding import Repairer

# Characters beyond the public table.
#: Radicals without a decomposition in the character database.
RADICALS = dict(zip("⺠⻁⻄⻅⻆⻉⻋⻓⻔⻘⻙⻚⻛⻜⻝⻢⻣⻤⻥⻦⻧⻨⻩⻬⻮⻰⻳", "民虎西见角贝车长门青韦页风飞食马骨鬼鱼鸟卤麦黄齐齿龙龟", strict=True))
INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\ufeff"
SPACES = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
#: Letters beyond ASCII that stand for themselves although their prototype is a pair of ASCII letters.
LIGATURE_LETTERS = "œŒæÆ"


def compatibility_forms() -> dict[str, str]:
    """Characters whose only difference to letters, digits or Han characters is the form: full-width, mathematical, ligatures, radicals and the like."""
    out = dict(RADICALS)
    blocks = [(0x2C7C, 0x2C7E), (0x2E9F, 0x2EA0), (0x2EF3, 0x2EF4), (0x2F00, 0x2FD6), (0xF900, 0xFB00), (0xFB00, 0xFB07), (0xFF10, 0xFF1A), (0xFF21, 0xFF3B), (0xFF41, 0xFF5B), (0x1D400, 0x1D800), (0x2100, 0x2150), (0x2F800, 0x2FA1E), (0xFF66, 0xFF9E)]
    for lo, hi in blocks:
        for o in range(lo, hi):
            ch = chr(o)
            how = unicodedata.decomposition(ch)
            plain = unicodedata.normalize("NFKC", ch)
            if how and plain != ch and plain.isalnum() and (lo != 0x2100 or how.startswith("<font>")):
                out[ch] = plain
    return out


FORMS = compatibility_forms()
_TABLES: dict[str, dict[int, str]] = {}


def prototypes(spark: SparkSession) -> dict[int, str]:
    """Code point -> prototype, of every character that has another one than its own decomposition. Made once an application, on the driver."""
    key = spark.sparkContext.applicationId
    if key not in _TABLES:
        _TABLES.clear()
        known = [chr(o) for o in range(0x21, 0x30000) if not 0xD800 <= o < 0xE000 and unicodedata.category(chr(o)) not in ("Cn", "Co", "Cs")]
        check = getattr(spark._jvm.com.ibm.icu.text, "SpoofChecker$Builder")().build()  # type: ignore[union-attr]
        found = check.getSkeleton("\n".join(known)).split("\n")
        assert len(found) == len(known)
        table = {ord(c): p for c, p in zip(known, found) if p != unicodedata.normalize("NFD", c)}
        of = lambda s: unicodedata.normalize("NFD", unicodedata.normalize("NFD", s).translate(table))
        table |= {ord(c): of(plain) for c, plain in FORMS.items()}
        table |= {ord(c): "" for c in INVISIBLE} | {ord(c): " " for c in SPACES}
        _TABLES[key] = table
    return _TABLES[key]


def skeleton(text: str, table: dict[int, str]) -> str:
    return unicodedata.normalize("NFD", unicodedata.normalize("NFD", text).translate(table))


def _kind(c: str) -> str:
    return unicodedata.category(c) if c.isalpha() or c.isdigit() else ""


def usual_characters(table: dict[int, str]) -> dict[str, str]:
    """Character -> the usual one of the same prototype and kind; for those of a left-to-right script only, as text of another direction does not pass for Latin."""
    usual: dict[tuple[str, str], str] = {}
    for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789":
        usual.setdefault((skeleton(c, table), _kind(c)), c)
    out = {}
    for o, p in table.items():
        c = chr(o)
        if o < 0x100 or c in LIGATURE_LETTERS or c in FORMS or not c.isalnum() or unicodedata.bidirectional(c) not in ("L", "EN"):
            continue
        if "LATIN" in unicodedata.name(c, "") and unicodedata.decomposition(c):
            continue  # a letter with an accent
        k = _kind(c)
        plain = usual.get((p, k)) or usual.get((p, {"Lo": "Lu", "Lm": "Ll", "Lt": "Lu", "No": "Nd", "Nl": "Lu"}.get(k, k))) or usual.get((p, "Ll" if k != "Nd" else "Lu"))
        if plain:
            out[c] = plain
    return out


def _cls(chars) -> str:
    return "[" + "".join(re.escape(c) for c in sorted(chars)) + "]"


class Normaliser:
    """The usual form of texts, under one look-alike table."""

    def __init__(self, table: dict[int, str]) -> None:
        self.table = table
        usual = usual_characters(table)
        self.stand_ins = set(usual)
        #: One scan decides whether anything here is worth a closer look.
        signs = set(INVISIBLE + SPACES) | set(FORMS) | self.stand_ins | {chr(o) for o in range(0x300, 0x370)}
        self.any_sign = re.compile(_cls(c for c in signs if c < "\U00010000"))
        self.forms = {ord(k): v for k, v in FORMS.items()}
        self.radicals = {ord(k): v for k, v in FORMS.items() if not k.isalnum()}  # symbols to the database, so in no word
        self.letters = {ord(k): v for k, v in usual.items()}
        self.word = re.compile("[^\\W_]+")
        self.emoji = "☀-⟿⬀-⯿\U0001f000-\U0001faff️"
        self.joiner = re.compile(f"(?<=[{self.emoji}])‍(?=[{self.emoji}])")
        self.hidden = re.compile(_cls(INVISIBLE))
        # a no-break space beside French double punctuation, and an ideographic space in Chinese, are usual
        self.usual_space = re.compile("[  ](?=[:;!?»%€])|(?<=[«])[  ]|(?m:^)　{1,2}(?=[一-鿿])|(?<=[、。，：；！？])　")
        self.space = re.compile(_cls(SPACES))

    def _word(self, m: re.Match) -> str:
        w = m.group()
        if w.isascii():
            return w
        plain = w.translate(self.forms)
        mine = [c for c in plain if c in self.stand_ins]
        if not mine:
            return plain
        is_latin = lambda c: "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ɏ"
        rest = [c for c in plain if c.isalpha() and c not in self.stand_ins]
        # within a Latin word, or a whole word of look-alikes: a stand-in; a word with letters of its own script: foreign
        if any(map(is_latin, rest)) or (not rest and len(plain) > 1):
            return plain.translate(self.letters)
        return plain

    def __call__(self, text: str) -> str:
        """The one form: look-alikes replaced, invisible characters gone, plain spaces, accents composed."""
        if text.isascii():
            return text
        # four bytes a character: the text has one beyond the basic plane (a class with those would scan slowly)
        if sys.getsizeof(text) < 4 * len(text) and not self.any_sign.search(text):
            return text
        keep = ""
        out = self.joiner.sub(keep, text)
        out = self.hidden.sub("", out)
        out = self.usual_space.sub(lambda m: {" ": "", " ": "", "　": ""}[m.group()[0]] * len(m.group()), out)
        out = self.space.sub(" ", out)
        out = unicodedata.normalize("NFC", out)
        out = self.word.sub(self._word, out.translate(self.radicals))
        for mark, ch in ((keep, "‍"), ("", " "), ("", " "), ("", "　")):
            out = out.replace(mark, ch)
        return out

    def case(self, text: str) -> str | None:
        """The usual form of a text that differs from it and has the same skeleton; None for a text that is usual."""
        if text.isascii() or (form := self(text)) == text:
            return None
        return form if skeleton(form, self.table) == skeleton(text, self.table) else None


def normalise(fields: DataFrame) -> DataFrame:
    """(doc_id, field, text) -> (doc_id, field, found, normal, skeleton_id), a row for each row.

    found: the field has a stand-in or an unusual invisible or space character, and is no case of problem 7. normal: the usual form of a case,
    else the text. skeleton_id: SHA-256 of the skeleton; equal for texts that look the same. All null for a null text, but found is false.
    """
    shared = fields.sparkSession.sparkContext.broadcast(prototypes(fields.sparkSession))  # a table of fixed size

    def make():
        import hashlib

        norm, garbled = Normaliser(shared.value), Repairer()

        def run(ids, names, texts) -> Iterator[tuple]:
            for i, n, t in zip(ids, names, texts):
                if t is None:
                    yield i, n, False, None, None
                    continue
                form = norm.case(t)
                found = form is not None and not garbled(t)[0]
                yield i, n, found, form if found else t, hashlib.sha256(skeleton(t, norm.table).encode("utf-8", "replace")).hexdigest()

        return run

    return map_batches(fields.select("doc_id", "field", "text"), make, "doc_id bigint, field string, found boolean, normal string, skeleton_id string")


def find(fields: DataFrame) -> DataFrame:
    """(doc_id, field) of the cases: fields that differ from a usual form of equal skeleton and are no case of problem 7."""
    shared = fields.sparkSession.sparkContext.broadcast(prototypes(fields.sparkSession))  # a table of fixed size

    def make():
        norm, garbled = Normaliser(shared.value), Repairer()

        def run(ids, names, texts) -> Iterator[tuple]:
            for i, n, t in zip(ids, names, texts):
                if t and norm.case(t) is not None and not garbled(t)[0]:
                    yield i, n

        return run

    return map_batches(fields.select("doc_id", "field", "text"), make, "doc_id bigint, field string")


def groups(normalised: DataFrame) -> DataFrame:
    """Fields grouped by equal skeleton: (field, skeleton_id, n, n_found) of the skeletons that a case has; n counts all fields of that look."""
    return (
        normalised.where(F.col("skeleton_id").isNotNull())
        .groupBy("field", "skeleton_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("found").cast("bigint")).alias("n_found"))
        .where("n_found > 0")
    )


assert sys.maxunicode == 0x10FFFF
