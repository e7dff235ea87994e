"""Markup residue in text documents (problem 2): a linear-chain conditional random field over DOM leaf blocks.

A body is cut into leaf blocks: text between line ends, block-level tags and inline elements, each with what the elements open around it mean, at any depth. Every leaf
has ancestor-tag features and text features; the chain's labels are LABELS. The weights are fitted by p02_train on labelled pages that it writes by
rule, and lie beside this module (WEIGHTS); a batch of pages at a time is decoded by Viterbi.

A record uses a language if a leaf is decoded as that language and shows a sign of the language's own, or, for html, stands in an element; code leaves
count for what marks them as code only; signs that languages share count for none by themselves.

Null and empty bodies use no markup and come back unchanged. Whole bodies are decoded, whatever their length; repeated rows repeat.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

LABELS = ("plain", "html", "markdown", "wiki", "latex", "code", "note")
PLAIN, CODE, NOTE = 0, 5, 6
LANGUAGES = LABELS[1:5]

# Element names.
BLOCK = "html|head|body|div|p|h[1-6]|ul|ol|li|dl|dt|dd|table|thead|tbody|tfoot|tr|td|th|section|article|header|footer|nav|aside|main|blockquote|pre|figure|figcaption|form|fieldset|noscript|script|style|title|hr|br|center|address|option|select|textarea|button"
INLINE = "a|b|i|u|s|em|strong|span|kbd|code|small|big|sub|sup|font|mark|img|abbr|cite|q|del|ins|tt|var|samp|label|input|meta|link|iframe|svg|time|strike|ref|nowiki"
VOID = {"br", "hr", "img", "meta", "link", "input"}
#: Weights as p02_train fitted them.
WEIGHTS = Path(__file__).with_name("p02_field.npz")

_TAG = re.compile(rf"<(/?)({BLOCK}|{INLINE})\b((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<!DOCTYPE[^>]*>|<!--.*?-->", re.I | re.S)
_BLOCK = re.compile(rf"(?:{BLOCK})\Z", re.I)
#: An inline element with all that stands in it, or a tag that is alone.
_INLINE_ELEMENT = re.compile(rf"<({INLINE})\b[^<>]*>[^<>]*</\1\s*>|</?(?:{INLINE})\b[^<>]*>", re.I)
_FENCE = re.compile(r"^\s{0,3}(```+|~~~+)")
_SIGN = re.compile(r"[#*`<>&\\{}|~_\[=$]|''|^\s*(?:[-+•]|\d+[.)]) ")
_ENTITY = re.compile(r"&(?:[a-zA-Z]{2,8}|#\d{2,6}|#x[0-9a-fA-F]{2,5});")

#: Signs of one language alone.
OWN = {
    "html": re.compile(rf"</?(?:{BLOCK}|{INLINE})(?<!ref)(?<!nowiki)\b(?:\s[^<>]*|/)?>|<!DOCTYPE|&(?:[a-zA-Z]{{2,8}}|#\d{{2,6}}|#x[0-9a-fA-F]{{2,5}});", re.I),
    "markdown": re.compile(r"^\s{0,3}#{1,6}\s+\S|^\s{0,3}(?:```|~~~)|\*\*[^\s*][^*\n]*\*\*|(?<![\w*\\])\*[^\s*](?:[^*\n]*[^\s*])?\*(?!\*)|(?<![^\W一-鿿])__[^\s_][^\n]*?__|(?<!`)`[^`\n]+`(?!`)|(?<!\[)\[[^\[\]\n]*\]\([^()\s]+\)|~~[^\s~][^~\n]*~~|^\s{0,3}>\s?\S|^\s*\|?\s*:?-{2,}:?\s*(?:\|\s*:?-{2,}:?\s*)+\|?\s*$"),
    "wiki": re.compile(r"^\s*(={2,6})\s*[^=\n].*?\1\s*$|'''?[^'\n]+'''?|\[\[[^\[\]\n]+\]\]|\{\{[^{}\n|]*\|[^{}\n]*\}\}|^\s*\{\||^\s*\|\}|</?(?:ref|nowiki)\b"),
    "latex": re.compile(r"\\(?:begin|end|section|subsection|subsubsection|paragraph|chapter|title|author|date|textbf|textit|emph|texttt|underline|cite|ref|label|footnote|url|href|usepackage|documentclass|caption|includegraphics)\b\*?\s*[\[{]|\\(?:maketitle|item|tableofcontents|noindent|newpage|frac|sqrt|sum|int|alpha|beta|cdot|leq|geq|times)\b|^\s*\\\[|\\\]\s*$|\$[^$\n]*[\\^_=][^$\n]*\$|\\\(.+?\\\)"),
}
_MD_HASH = re.compile(r"^\s{0,3}#\s+\S")

FEATURES = [
    ("md head", re.compile(r"^\s{0,3}#{1,6}\s+\S")),
    ("md strong", re.compile(r"\*\*[^\s*][^*]*\*\*|__[^\s_][^_]*__|~~[^\s~][^~]*~~")),
    ("md em", re.compile(r"(?<![\w*\\])\*[^\s*](?:[^*]*[^\s*])?\*(?!\*)")),
    ("md code", re.compile(r"(?<!`)`[^`]+`(?!`)")),
    ("md link", re.compile(r"(?<!\[)\[[^\[\]]*\]\([^()\s]+\)")),
    ("md quote", re.compile(r"^\s{0,3}>\s?\S")),
    ("md rule", re.compile(r"^\s*\|?\s*:?-{2,}:?\s*(?:\|\s*:?-{2,}:?\s*)+\|?\s*$")),
    ("wiki head", re.compile(r"^\s*={2,6}[^=].*=\s*$")),
    ("wiki quote", re.compile(r"'''?[^']+''")),
    ("wiki link", re.compile(r"\[\[[^\[\]]+\]\]")),
    ("wiki box", re.compile(r"\{\{[^{}|]*\|[^{}]*\}\}")),
    ("wiki table", re.compile(r"^\s*(?:\{\||\|\}|\|-|!\s)")),
    ("tex command", re.compile(r"\\[a-zA-Z]+\*?\s*[\[{]")),
    ("tex word", re.compile(r"\\[a-zA-Z]{2,}")),
    ("tex math", re.compile(r"\$[^$]*[\\^_=][^$]*\$|^\s*\\\[|\\\]\s*$")),
    ("html tag", re.compile(rf"</?(?:{BLOCK}|{INLINE})\b[^<>]*>", re.I)),
    ("html entity", _ENTITY),
    ("note", re.compile(r"<!--")),
    ("bullet", re.compile(r"^\s*[-*+•]\s")),
    ("number", re.compile(r"^\s*\d+[.)]\s")),
    ("row", re.compile(r"^\s*\|.*\|\s*$")),
    ("blank slot", re.compile(r"\{\{[^{}|]*\}\}|\$\{|<<|%\w+%")),
    ("compare", re.compile(r"\w\s?[<>]\s?\w")),
    ("price", re.compile(r"\$\d")),
    ("cite", re.compile(r"(?<!\[)\[[\w-]{1,8}\](?![(\]])")),
    ("times", re.compile(r"\d \* \d")),
    ("under", re.compile(r"[a-z]_[a-z0-9]")),
    ("code sign", re.compile(r"[;{]\s*$|\w\(.*\)|--\w+|^\s{4}\S")),
    ("sentence", re.compile(r"[.。!?！？]\s*$")),
]
CONTEXT = ["bias", "no sign", "in pre", "in head", "in list", "in table", "in inline", "in element", "in fence", "fence", "short"]
N_FEATURES = len(FEATURES) + len(CONTEXT)
_AT = {n: i for i, n in enumerate(CONTEXT)}


#: What lies between two leaves: nothing, a line end, an empty line or the edge of a block.
INLINE_ON, LINE, BLOCK_EDGE = 0, 1, 2


class Ancestors:
    """What the open elements around a leaf mean to it; the same object serves all leaves between two tags."""

    __slots__ = ("any", "cell", "code", "head", "item", "pre")

    def __init__(self, count: Counter[str], heads: list[int]):
        self.any = bool(count)
        self.code = any(count[x] for x in ("pre", "code", "script", "style"))
        self.pre = any(count[x] for x in ("pre", "script", "style"))
        self.head = heads[0] if heads else 0
        self.item = bool(count["li"])
        self.cell = bool(count["td"] or count["th"])


class Leaf:
    """A piece of text; before: how it goes on from the leaf before it (INLINE_ON, LINE, BLOCK_EDGE)."""

    __slots__ = ("before", "fence", "opened", "text", "within")

    def __init__(self, text: str, within: Ancestors, fence: str, opened: str, before: int):
        self.text, self.within, self.fence, self.opened, self.before = text, within, fence, opened, before


_NOTHING = Ancestors(Counter(), [])


def leaves(text: str) -> list[Leaf]:
    """Leaf blocks in order, at any depth of elements: the text between line ends and tags, where an inline element within a line is a leaf of its own. fence is
    "in", "mark" or ""."""
    out: list[Leaf] = []
    stack: list[str] = []
    count: Counter[str] = Counter()
    heads: list[int] = []
    within = _NOTHING
    fence = opened = ""
    gap = BLOCK_EDGE

    def add(piece: str, where: Ancestors, mark: str, by: str) -> None:
        nonlocal gap
        out.append(Leaf(piece, where, mark, by, gap))
        gap = INLINE_ON

    def pop() -> str:
        name = stack.pop()
        count[name] -= 1
        if not count[name]:
            del count[name]
        if name[0] == "h" and name[1:].isdigit():
            heads.pop()
        return name

    def put(piece: str) -> None:
        nonlocal opened
        if not piece.strip():
            return
        at = 0
        if "<" in piece:
            for m in _INLINE_ELEMENT.finditer(piece):
                if piece[at : m.start()].strip():
                    add(piece[at : m.start()], within, "", opened)
                    opened = ""
                    at = m.start()
                add(piece[at : m.end()], within, "", opened)
                opened, at = "", m.end()
        if piece[at:].strip():
            add(piece[at:], within, "", opened)
            opened = ""

    for line in text.split("\n"):
        gap = max(gap, LINE)
        if "`" in line or "~" in line:
            m = _FENCE.match(line)
            if m and (not fence or line.strip().startswith(fence[:3])):
                fence = "" if fence else m.group(1)
                add(line, within, "mark", opened)
                continue
        if fence:
            add(line, within, "in", opened)
            continue
        if not line.strip():
            gap = BLOCK_EDGE
            continue
        if "<" not in line:
            put(line)
            continue
        at = 0
        for m in _TAG.finditer(line):
            name = (m.group(2) or "").lower()
            if not name or not _BLOCK.match(name) and name not in ("code",):
                continue
            put(line[at : m.start()])
            at = m.end()
            edge = gap if name == "code" else LINE if name == "br" else BLOCK_EDGE
            gap = max(gap, edge)
            opened = opened or name
            if m.group(1):
                if count[name]:
                    while pop() != name:
                        pass
                    within = Ancestors(count, heads)
            elif name not in VOID and not m.group(3).endswith("/"):
                if name in ("p", "li", "td", "th", "tr") and stack and stack[-1] == name:
                    pop()
                stack.append(name)
                count[name] += 1
                if name[0] == "h" and name[1:].isdigit():
                    heads.append(int(name[1:]))
                within = Ancestors(count, heads)
            if m.group(1) or name in VOID:
                add(m.group(), Ancestors(count + Counter([name]), heads), "", "")
                gap = edge
        put(line[at:])
    return out


def feature_ids(leaf: Leaf) -> list[int]:
    n = len(FEATURES)
    out = [n + _AT["bias"]]
    t = leaf.text
    if leaf.fence:
        out.append(n + _AT["in fence" if leaf.fence == "in" else "fence"])
    elif _SIGN.search(t):
        out += [i for i, (_, p) in enumerate(FEATURES) if p.search(t)]
    else:
        out.append(n + _AT["no sign"])
        if t.rstrip()[-1:] in ".。!?！？":
            out.append(len(FEATURES) - 1)
    w = leaf.within
    if w.any:
        out.append(n + _AT["in element"])
        for name, there in (("in pre", w.code), ("in head", w.head), ("in list", w.item), ("in table", w.cell)):
            if there:
                out.append(n + _AT[name])
    if len(t) < 12:
        out.append(n + _AT["short"])
    return out


class Field:
    """Weights of the chain: emission (features x labels), transition (labels x labels), start."""

    def __init__(self, emission: np.ndarray, transition: np.ndarray, start: np.ndarray):
        self.emission, self.transition, self.start = emission, transition, start

    def save(self, path: str | Path) -> None:
        np.savez_compressed(path, emission=self.emission, transition=self.transition, start=self.start)

    @classmethod
    def load(cls, path: str | Path = WEIGHTS) -> Field:
        with np.load(path) as f:
            return cls(f["emission"], f["transition"], f["start"])

    def scores(self, pages: list[list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """Emission scores (pages, longest, labels), and which places are filled."""
        length = np.array([len(p) for p in pages])
        top = max(1, int(length.max()) if len(length) else 1)
        flat = [f for p in pages for f in p]
        out = np.zeros((len(pages), top, len(LABELS)))
        mask = np.arange(top)[None, :] < length[:, None]
        if flat:
            size = np.array([len(f) for f in flat])
            cols = np.concatenate([np.array(f, np.int64) for f in flat])
            out[mask] = np.add.reduceat(self.emission[cols], np.concatenate([[0], np.cumsum(size)[:-1]]), 0)
        return out, mask

    def viterbi(self, pages: list[list[list[int]]]) -> list[np.ndarray]:
        """Best label sequence of each page. Pages of like length share a matrix."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            top = int(len(pages[order[at]]) * 1.4) + 2
            end = at + 1
            while end < len(order) and len(pages[order[end]]) <= top and (end - at) * top < 60_000:
                end += 1
            rows, at = order[at:end], end
            s, mask = self.scores([pages[i] for i in rows])
            best = self.start + s[:, 0]
            back = np.zeros(s.shape, np.int8)
            for t in range(1, s.shape[1]):
                both = best[:, :, None] + self.transition[None]
                back[:, t] = both.argmax(1)
                new = both.max(1) + s[:, t]
                best = np.where(mask[:, t, None], new, best)
            lengths = mask.sum(1)
            last = best.argmax(1)
            path = np.zeros(mask.shape, np.int64)
            cur = last.copy()
            for t in range(s.shape[1] - 1, -1, -1):
                ends = lengths - 1 == t
                cur = np.where(ends, last, cur)
                path[:, t] = cur
                if t:
                    prev = back[np.arange(len(rows)), t, cur]
                    cur = np.where(t < lengths, prev, cur)
            for r, i in enumerate(rows):
                out[i] = path[r, : lengths[r]]
        return out


def languages(ls: list[Leaf], path: np.ndarray) -> list[str]:
    """Languages of a decoded body: those that the field names for a leaf, where the leaf shows a sign of that language's own."""
    found: set[str] = set()
    hash_only = True
    for leaf, label in zip(ls, path.tolist()):
        if label in (PLAIN, NOTE) or leaf.fence == "in":
            continue
        if label == CODE:  # a code block counts for what marks it
            if leaf.fence == "mark":
                found.add("markdown")
                hash_only = False
            elif leaf.within.code:
                found.add("html")
            continue
        lang = LABELS[label]
        text = re.sub(r"<!--.*?-->", "", leaf.text) if "<!--" in leaf.text else leaf.text
        text = _SLOT.sub(" ", text) if "{{" in text or "<<" in text or "${" in text else text
        if OWN[lang].search(text) or lang == "html" and (leaf.opened or leaf.within.any):
            found.add(lang)
            if lang == "markdown" and not _MD_HASH.match(text):
                hash_only = False
    if "markdown" in found and hash_only and "wiki" in found:
        found.remove("markdown")  # a single # is a numbered item there
    return sorted(found)


_SLOT = re.compile(r"\{\{[^{}|\n]*\}\}|\$\{[^{}\n]*\}|<<[^<>\n]*>>")


def clean(ls: list[Leaf], path: np.ndarray, langs: Iterable[str] = LANGUAGES) -> str:
    """Clean text with headings, lists, tables, code blocks and formulas kept, in one notation. Lines of a paragraph stay lines; blocks are parted by an empty
    line. langs: the languages that the record uses; a leaf without a label of its own is cleaned of the signs of these."""
    out: list[str] = []
    code: list[str] = []
    edge = BLOCK_EDGE
    row_open = wiki_table = False
    formula: list[str] | None = None

    def say(s: str, sep: str | None = None) -> None:
        nonlocal edge
        if not s.strip():
            return
        if edge != INLINE_ON or sep:
            s = s.lstrip()
            if out:
                out[-1] = out[-1].rstrip()
        out.append((("", "\n", "\n\n")[edge] if sep is None else sep) * bool(out) + s)
        edge = INLINE_ON

    def flush() -> None:
        nonlocal edge
        if code:
            edge = BLOCK_EDGE
            say("```\n" + "\n".join(code) + "\n```")
            code.clear()
            edge = BLOCK_EDGE

    for leaf, label in zip(ls, path.tolist()):
        t, w = leaf.text, leaf.within
        closing = t.startswith("</")
        if leaf.fence == "in" or (w.pre or label == CODE and not w.any and not leaf.fence) and not closing:
            code.append(_entity(t) if w.any else t)
            continue
        if code and not closing:
            flush()
        edge = max(edge, leaf.before)
        if leaf.fence == "mark":
            flush()
            edge = BLOCK_EDGE
            continue
        if closing or t.lower().startswith(("<br", "<hr")):
            if t.lower().startswith(("</tr", "</table")):
                row_open = False
            continue
        if label == NOTE or "<!--" in t:
            say(t)
            continue
        s = t.strip()
        if m := _ENVIRONMENT.fullmatch(s):  # formulas stand between $$; other environments are only marks
            if m.group(1) == "begin" and m.group(2) in FORMULA:
                formula = []
            elif formula is not None and m.group(1) == "end":
                edge = BLOCK_EDGE
                say("$$" + " ".join(formula) + "$$")
                formula = None
            edge = BLOCK_EDGE
            continue
        if formula is not None:
            formula.append(s)
            continue
        if "wiki" in langs and s.startswith(("{|", "|}")):
            wiki_table, edge = s[0] == "{", BLOCK_EDGE
            continue
        if wiki_table and s[:1] in "|!":
            if s[:2] not in ("|-", "|+"):
                say("| " + re.sub(r"\s*(?:\|\||!!)\s*", " | ", _inline(s[1:].strip(), w, 3)) + " |")
            continue
        kind = label if label in (1, 2, 3, 4) else next((LABELS.index(x) for x in langs if OWN[x].search(t)), PLAIN)
        if kind == PLAIN and not w.any and not leaf.opened:
            say(t)
            continue
        core = _inline(s, w, kind)
        if w.code and core:
            core = f"`{core}`"
        if core:
            lead, trail = t[: len(t) - len(t.lstrip())], t[len(t.rstrip()) :]
            say(lead + core + trail, " | " if w.cell and row_open and edge == BLOCK_EDGE else None)
        row_open = w.cell
        if core.startswith("#") or w.head:
            edge = BLOCK_EDGE
    if formula:
        say(" ".join(formula))
    flush()
    return "".join(out).rstrip()


#: Environments whose body is a formula.
FORMULA = {"equation", "equation*", "align", "align*", "gather", "gather*", "math", "displaymath", "eqnarray", "multline"}
_ENVIRONMENT = re.compile(r"\\(begin|end)\{(\w+\*?)\}(?:\[[^\]]*\]|\{[^}]*\})*")


def _entity(s: str) -> str:
    import html

    return html.unescape(s) if "&" in s else s


def _inline(s: str, within: Ancestors, label: int) -> str:
    """One leaf without its signs, in the common notation."""
    s = _entity(_TAG.sub(lambda m: m.group() if m.group().startswith("<!--") else "", s)) if "<" in s or "&" in s else s
    head = within.head
    if m := re.match(r"(#{1,6})\s+(.*)", s):
        head, s = len(m.group(1)), m.group(2)
    elif m := re.match(r"(={2,6})\s*(.*?)\s*=+$", s):
        head, s = len(m.group(1)) - 1, m.group(2)
    elif m := re.match(r"\\((?:sub)*)section\*?\{(.*)\}$", s):
        head, s = 1 + m.group(1).count("sub"), m.group(2)
    elif m := re.match(r"\\(?:title|chapter)\*?\{(.*)\}$", s):
        head, s = 1, m.group(1)
    bullet = "- " if within.item else ""
    if m := re.match(r"\s*(?:\\item|[-*+•])\s+(.*)", s):
        bullet, s = "- ", m.group(1)
    if re.match(r"\\maketitle|\\tableofcontents|\[\[Category:", s):
        return ""
    if label == 3:
        s = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]]*)\]\]", r"\1", s)
        s = re.sub(r"'{2,5}", "", s)
        s = re.sub(r"\{\{[^{}]*\}\}", "", s)
    elif label == 4:
        s = re.sub(r"\\(?:emph|textbf|textit|texttt|underline)\{([^{}]*)\}", r"\1", s)
        s = re.sub(r"\s*\\(?:cite|label|footnote)\{[^{}]*\}", "", s)
        s = re.sub(r"\\\[\s*(.*?)\s*\\\]", r"$$\1$$", s)
        s = re.sub(r"\\\(\s*(.*?)\s*\\\)", r"$\1$", s)
    elif label == 2:
        s = re.sub(r"!?\[([^\[\]]*)\]\([^()\s]+\)", r"\1", s)
        s = re.sub(r"\*\*(\S[^*]*)\*\*|__(\S[^_]*)__|~~(\S[^~]*)~~", lambda m: m.group(1) or m.group(2) or m.group(3), s)
        s = re.sub(r"(?<![\w*])\*(\S[^*]*)\*", r"\1", s)
        s = re.sub(r"^>\s?", "", s)
    return ("#" * min(head, 6) + " " if head and s else "") + (bullet if s else "") + s


def decode(md_corpus: DataFrame, text: bool = False, field: Field | None = None) -> DataFrame:
    """(doc_id, markup array) of the records that use markup; with text=True (doc_id, markup, cleaned) of every record, unchanged where there is none."""
    shared = md_corpus.sparkSession.sparkContext.broadcast(field or Field.load())  # some kB, whatever the input

    def make():
        field = shared.value

        def run(ids, bodies) -> Iterator[tuple]:
            todo = [(i, b, leaves(b) if b and _SIGN.search(b) else []) for i, b in zip(ids, bodies)]
            for (i, b, ls), path in zip(todo, field.viterbi([[feature_ids(x) for x in ls] for _, _, ls in todo])):
                found = languages(ls, path)
                if text:
                    yield i, found, clean(ls, path, found) if found else b
                elif found:
                    yield i, found

        return run

    schema = "doc_id bigint, markup array<string>" + ", cleaned string" * text
    rows = md_corpus.select("doc_id", "body")
    return map_batches(rows if text else rows.where(F.col("doc_id").isNotNull() & F.col("body").isNotNull()), make, schema)
