"""Template residue and error-page text (problem 6): a regularised linear classifier on hashed n-grams.

Two kinds of unit are scored by one hashed weight vector with separate feature namespaces:

* segments: sentences and lines of a field outside code; a field whose segments are (nearly) all residue is filler, an error page,
  an access or script notice, or a default or error title;
* spans: bracketed or marked tokens outside code; a field with one that scores as an unfilled placeholder is a case. Nothing but the score decides.

Training labels are weak. Segments: response-status and phrase patterns on whole fields. Spans: phrases that name what is to be filled in, where the span
stands free, are residue; spans that are glued to a notation (link, command, index, box) are content; others have no label. They come from a
sample of SAMPLE_ROWS rows, of which every segment and span counts, and from units that are put together by rule from the word lists
below and the public list of response codes. A host (first folder of relpath) is either in training or in validation, never in both;
train() gives the figures of the unseen hosts.

Null and empty texts are no cases. Every row is scored on its whole text. Repeated rows give repeated results.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from http import HTTPStatus

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, sample_keys
from .p05_lookalikes import Normaliser, prototypes
from .p07_encoding import Repairer

BITS = 18
#: Bodies of the training sample, and titles; and bytes that a sampled text has at most. Classification covers all rows.
SAMPLE_ROWS = 2500
SAMPLE_BYTES = 16_384

# Phrases of the weak labels.
STATUS = r"(?:error|fehler|erreur|错误)\s*[45]\d\d|^[45]\d\d\b[^.]{0,40}(?:found|unavailable|forbidden|denied|error|timeout|不存在|introuvable|gateway|service)"
PHRASES = (
    STATUS,
    r"^lorem ipsum",
    r"access denied|do not have permission|zugriff verweigert|fehlt die berechtigung|accès refusé|n'avez pas le droit|访问被拒绝|无权(?:访问|查看)|没有权限",
    r"javascript|requires? scripts|skripte und cookies|scripts? et (?:les )?cookies|需要脚本|启用脚本",
    r"session has expired|sitzung ist abgelaufen|session a expiré|登录已过期",
    r"just a moment|checking your browser|something went wrong|too many requests|gateway timeout|temporarily unavailable|vorübergehend nicht verfügbar|momentanément indisponible|系统维护中|请求过于频繁|服务器内部错误|服务暂(?:时|不)|网关超时|加载失败|interner serverfehler|ein fehler ist aufgetreten|zeitüberschreitung|erreur interne|une erreur s'est produite|délai d'attente",
    r"^(?:page|seite|la page)\b.*(?:not found|could not be|nicht gefunden|introuvable)|not found$|nicht gefunden|introuvable|页面不存在|已删除或移动",
    r"^(?:sample text|beispieltext|blindtext|texte? (?:d'exemple|factice)|测试(?:文本|测试)?|示例文本|text hier)",
    r"^x{4,}$|^test(?: test)+\W*$|^asdf",
    r"^(?:untitled(?: document)?|document|new document|presentation|présentation|dokument|unbenannt(?:es dokument)?|sans titre|document sans nom|未命名文档|新建文档|演示文稿|无标题)\s*\(?\d*\)?$",
    r"^(?:click to (?:insert|add)|your headline|titel hier|cliquez pour|单击添加|在此输入|title_placeholder|add title|\[document title\])",
)
# Parts of notices, by language; each is put together from one entry of every list.
NOTICES: dict[str, list[tuple[list[str], ...]]] = {
    "en": [
        (["The page", "This page", "The document", "The requested file", "The address you entered"], ["was not found", "does not exist", "has been moved or deleted", "is no longer available", "could not be opened"], [".", " on this server.", "."]),
        (["Please enable", "Please turn on", "Activate", "You have to allow"], ["JavaScript", "scripts", "scripts and cookies", "cookies"], [" in your browser.", " and reload.", " to view this site.", " first."]),
        (["This site", "The application", "This view"], [" requires", " needs", " does not work without"], [" JavaScript.", " scripts.", " scripts and cookies."]),
        (["Your session", "Your login"], [" has expired", " has timed out"], [". Log in again.", "; please sign in.", "."]),
        (["Access", "Permission"], [" denied", " refused", " forbidden"], [".", " for this resource.", ""]),
        (["You are not allowed to", "You lack the rights to"], [" open", " view"], [" this page.", " this folder."]),
        (["An error occurred", "Something failed", "The server did not answer", "The connection timed out"], [". Please try again later.", ". Retry in a few minutes.", "."]),
        (["The service", "This server", "The site"], [" is down for maintenance", " is unavailable at present", " is overloaded"], [".", ", try again later."]),
        (["Wait a moment", "Hold on", "One moment"], [" while we check your browser.", " please...", "..."]),
        (["Too many", "An unusual number of"], [" requests"], [" from your address.", ", slow down."]),
    ],
    "de": [
        (["Die Seite", "Diese Adresse", "Das Dokument"], [" wurde nicht gefunden", " existiert nicht", " wurde verschoben oder gelöscht"], [".", " auf diesem Server."]),
        (["Bitte schalten Sie", "Schalten Sie"], [" JavaScript", " Skripte", " Skripte und Cookies"], [" ein.", " im Browser ein."]),
        (["Diese Seite", "Die Anwendung"], [" benötigt", " verlangt", " läuft nicht ohne"], [" JavaScript.", " Skripte.", " Skripte und Cookies."]),
        (["Ihre Anmeldung", "Ihre Sitzung"], [" ist abgelaufen", " wurde beendet"], [". Bitte neu anmelden.", "."]),
        (["Zugriff", "Zugang"], [" verweigert", " nicht erlaubt"], [".", ""]),
        (["Der Dienst", "Der Server"], [" ist zurzeit nicht erreichbar", " wird gewartet"], [".", ". Versuchen Sie es später."]),
        (["Es ist ein Fehler aufgetreten", "Zeitüberschreitung"], [".", ". Bitte später erneut versuchen."]),
    ],
    "fr": [
        (["La page", "Ce document", "Cette adresse"], [" est introuvable", " n'existe pas", " a été déplacé ou supprimé"], [".", " sur ce serveur."]),
        (["Veuillez autoriser", "Merci d'activer"], [" JavaScript", " les scripts", " les scripts et les cookies"], [".", " puis recharger."]),
        (["Ce site", "Cette application"], [" exige", " nécessite", " ne marche pas sans"], [" JavaScript.", " les scripts."]),
        (["Votre session"], [" a expiré", " est terminée"], [". Reconnectez-vous.", "."]),
        (["Accès"], [" refusé", " interdit"], [".", ""]),
        (["Le service", "Le serveur"], [" est indisponible", " est en maintenance"], [".", ". Réessayez plus tard."]),
        (["Une erreur est survenue", "Délai dépassé"], [".", ". Réessayez."]),
    ],
    "zh": [
        (["页面", "该网页", "请求的文件"], ["不存在", "未找到", "已被移动或删除", "无法打开"], ["。", ""]),
        (["请启用", "请开启", "需要启用"], ["脚本", "JavaScript", "脚本和Cookie"], ["后重试。", "以继续。", "。"]),
        (["本站", "本应用"], ["需要", "依赖"], ["脚本支持。", "JavaScript。"]),
        (["会话", "登录"], ["已过期", "已失效", "超时"], ["，请重新登录。", "。"]),
        (["拒绝访问", "无权打开此页", "没有访问权限"], ["。", ""]),
        (["服务器", "该服务"], ["维护中", "暂时无法使用", "繁忙"], ["，请稍后再试。", "。"]),
        (["发生错误", "请求超时", "网络异常"], ["，请稍后再试。", "。"]),
    ],
}
WORD_FOR_ERROR = {"en": "Error", "de": "Fehler", "fr": "Erreur", "zh": "错误"}
REFERENCES = {"en": ["Reference", "Request id", "Incident"], "de": ["Referenz", "Vorgang", "Kennung"], "fr": ["Référence", "Incident"], "zh": ["参考编号", "请求编号"]}
#: Names that programs give to what has none, with and without a number.
DEFAULT_NAMES = ["Untitled", "Untitled document", "Document", "New document", "Presentation", "Unbenannt", "Unbenanntes Dokument", "Dokument", "Neues Dokument", "Präsentation", "Sans titre", "Document sans nom", "Nouveau document", "Présentation", "无标题", "未命名文档", "新建文档", "演示文稿", "文档"]
#: What stands where a title is to be written.
TITLE_SLOTS = [(["Click", "Tap"], [" to add", " to edit"], [" title", " the title", " text"]), (["Klicken,", "Hier"], [" um Titel", " Titel"], [" hinzuzufügen", " einfügen"]), (["Cliquez pour"], [" ajouter", " modifier"], [" un titre", " le titre"]), (["单击此处", "点击"], ["添加", "输入"], ["标题", "文本"]), (["Your", "Add"], [" title", " headline", " text"], [" here", " goes here"])]
FILLERS = ["sample text", "placeholder text", "dummy text", "Beispieltext", "Blindtext", "Platzhaltertext", "texte d'exemple", "texte factice", "示例文本", "测试文本", "测试", "test", "xxxx", "asdf"]
LATIN = "lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor incididunt ut labore dolore magna aliqua enim minim veniam quis nostrud".split()
#: Sentences that only talk about such things.
TALK: list[tuple[list[str], ...]] = [
    (["The handbook", "The article", "Her lecture", "This chapter"], [" explains", " describes", " compares"], [" what a 404 means to a visitor.", " how a 503 differs from a 502.", " why pages ask for JavaScript.", " the use of lorem ipsum by printers.", " when access is denied and why.", " how templates mark a title or a date."]),
    (["Das Handbuch", "Der Aufsatz"], [" erklärt,", " beschreibt,"], [" was ein 404 bedeutet.", " wie sich 502 und 503 unterscheiden.", " warum Seiten nach JavaScript fragen."]),
    (["Le manuel", "L'article"], [" explique", " décrit"], [" ce que veut dire un 404.", " la différence entre 502 et 503.", " pourquoi un site demande JavaScript."]),
    (["手册", "这篇文章"], ["解释", "说明"], ["404的含义。", "502与503有何不同。", "网页为何需要脚本。"]),
]
SLOT_WORDS = "title name date company customer client author number amount total version service department address city email subject project titel datum firma kunde betrag abteilung projekt ort titre nom numéro montant société ville projet 标题 姓名 日期 部门 公司 客户 项目 编号 金额 负责人 合同 名称".split()


def _put_together(parts: tuple[list[str], ...], r: random.Random) -> str:
    out = ""
    for p in parts:
        x = r.choice(p)
        out += (" " if out and out[-1].isascii() and out[-1].isalpha() and x[:1].isascii() and x[:1].isalnum() else "") + x
    return out


def written_segments(r: random.Random, n: int = 1200) -> Iterator[tuple[str, bool, int]]:
    """(segment, is_title, label), put together by rule."""
    codes = [c for c in HTTPStatus if c >= 400]
    for _ in range(n):
        lang = r.choice(list(NOTICES))
        roll = r.random()
        if roll < 0.4:
            parts = list(r.choice(NOTICES[lang]))
            if r.random() < 0.25:  # what was asked for is named
                parts.insert(1, [f" /{''.join(r.choice('abcdefgh') for _ in range(4))}_{r.choice(LATIN)}" + (" " if lang != "zh" else "")])
            yield _put_together(tuple(parts), r).replace("  ", " "), r.random() < 0.3, 1
        elif roll < 0.45:
            code = f"{r.choice('ABCDEFKLMN')}{r.choice('ABCDEFKLMN')}-{r.randint(100, 9999)}"
            yield r.choice(REFERENCES[lang]) + r.choice([" ", ": "]) + r.choice([code, str(r.randint(1000, 99999))]) + r.choice([".", ""]), False, 1
        elif roll < 0.6:
            c = r.choice(codes)
            yield r.choice([f"{c.value} {c.phrase}", f"{WORD_FOR_ERROR[lang]} {c.value}", f"{WORD_FOR_ERROR[lang]} {c.value}: {c.phrase}", f"HTTP {c.value}", c.phrase]), r.random() < 0.5, 1
        elif roll < 0.75:
            yield r.choice(DEFAULT_NAMES) + r.choice(["", f" {r.randint(1, 40)}", str(r.randint(1, 40)), f" ({r.randint(1, 9)})"]), True, 1
        elif roll < 0.8:
            yield _put_together(r.choice(TITLE_SLOTS), r), r.random() < 0.8, 1
        elif roll < 0.88:
            yield (" ".join(r.choice(LATIN) for _ in range(r.randint(3, 14))).capitalize() + "."), r.random() < 0.3, 1
        else:
            f = r.choice(FILLERS)
            yield (" " if f.isascii() else "").join([f] * r.randint(1, 4)), r.random() < 0.5, 1
    for _ in range(n // 3):
        yield _put_together(r.choice(TALK), r), r.random() < 0.3, 0


def written_spans(r: random.Random, n: int = 3000) -> Iterator[tuple[str, int]]:
    """(text with one span or more, label of its spans), put together by rule."""
    word = lambda: r.choice("report valve harbour museum plaintiff reactor garden Bericht Ventil Hafen rapport vanne musée 报告 阀门 港口 温室".split())

    def slot() -> str:
        a, b = r.choice(SLOT_WORDS), r.choice(SLOT_WORDS)
        han = "一" <= a[0] <= "鿿"
        if han:
            return a + (r.choice("名称 编号 日期".split()) if r.random() < 0.3 else "")
        return r.choice([a, a, a.upper(), a.capitalize(), f"{a}_{b}", f"{a}_{b}".upper(), f"{a}.{b}", a.capitalize() + b.capitalize(), f"{a}-{b}"])

    def placeholder() -> str:
        s = slot()
        if "一" <= s[0] <= "鿿" and r.random() < 0.5:
            return r.choice([f"【{s}】", f"【请填写{s}】", f"（请填写{s}）", f"（请输入{s}）", f"XXXX{s}"])
        return r.choice([f"{{{{{s}}}}}", f"{{{{ {s} }}}}", f"${{{s}}}", f"%{s}%", f"<<{s}>>", f"{{{s}}}", f"[{s}]", f"[{r.choice(['Insert', 'Enter', 'Add', 'Your'])} {s}{r.choice([' here', ''])}]", f"[{s} {r.choice(['eintragen', 'einfügen', 'ausfüllen', 'à compléter', 'à remplir', 'here'])}]", "_" * r.randint(5, 20)])

    def notation() -> str:
        n = lambda: r.randint(1, 99)
        return r.choice([
            lambda: f"[{word()}]({word()}.md)", lambda: f"[{word()} {word()}]({word()}/{n()}.md)", lambda: f"![{word()}]({word()}.png)", lambda: f"[{n()}]", lambda: f"[{n()}, {n()}]", lambda: f"[AB-{n()}{n()}]", lambda: f"[[{word()}]]", lambda: f"[[{word()}|{word()}]]", lambda: f"[[Category:{word()}]]", lambda: f"{{{{{word().capitalize()}|code=X-{n()}}}}}", lambda: f"{{{{cite|X-{n()}}}}}",
            lambda: f"\\emph{{{word()}}}", lambda: f"\\section{{{word()} {word()}}}", lambda: f"\\section*{{{word().capitalize()} {n()}}}", lambda: f"\\begin{{{word()}}}", lambda: f"\\end{{{r.choice(['itemize', 'equation', 'align*'])}}}", lambda: f"$x_{{{n()}}} = \\frac{{y^{{2}}}}{{d + {n()}}}$", lambda: f"\\sum_{{i={n()}}}^{{{n()}}} w", lambda: f"\\[ x = \\sqrt{{y + {n()}}} \\]", lambda: f"\\cite{{{word()}{n()}}}",
            lambda: f"[^{n()}]", lambda: f"[{word()}][{n()}]", lambda: f"{n()}% of {n()}%", lambda: f"【{n()}】", lambda: f"{word()}[{n()}]", lambda: f"f{{{word()}}}",
        ])()

    for _ in range(n):
        y = int(r.random() < 0.5)
        before, after = r.choice([" ", " ", "\n", "", " ", "|", "：", "阀", "(", "\""]), r.choice([" ", ".", "\n", "", ",", "。", "，", "的", " ", ":", ")", "|"])
        yield (word() + before if before else "") + (placeholder() if y else notation()) + after + (word() if after.isspace() else ""), y


_TAG = re.compile(r"<!--.*?-->|</?[A-Za-z][^<>]*>|<!DOCTYPE[^>]*>", re.S)
_TITLE_TAG = re.compile(r"<title>.*?</title>", re.S | re.I)
_FENCE = re.compile(r"^[ \t]*(```+|~~~+)[^\n]*\n.*?(?:^[ \t]*\1[ \t]*$|\Z)", re.S | re.M)
_PRE = re.compile(r"<pre\b.*?(?:</pre>|\Z)|<(script|style|code)\b.*?(?:</\1>|\Z)|`[^`\n]+`", re.S | re.I)
_SENTENCE = re.compile(r"[^\n。！？!?.]+(?:[.!?。！？]+(?![\w])|[.!?](?=\w)[^\n。！？!?.]*)*\n?")
_TOKEN = re.compile(r"[A-Za-zÀ-ÿœ']+|\d+|[一-鿿]|[^\s\w]")
_CODE = re.compile(r"\b[A-Z]{2}-?\d+\b")
_IDENT = re.compile(r"/?\b[a-z]+(?:_[a-z0-9]+)+\b|/[a-z]+[a-z0-9_]*\b")
_DIGIT = re.compile(r"\d")
_LETTER = re.compile(r"[^\W\d_]")
#: Everything that might be a placeholder: what stands between two marks on a line. The first sign is looked for, then what belongs to it.
SPAN = re.compile(
    r"[{$%<\[【（X_T](?:(?<=\{)\{[^{}\n]+\}\}|(?<=\{)[^{}\n]+\}|(?<=\$)\{[^{}\n]+\}|(?<=%)[^\W\d][\w.\-]*%|(?<=<)<[^<>\n]+>>|(?<=\[)[^\[\]\n]+\]|(?<=【)[^【】\n]+】"
    r"|(?<=（)请[^（）\n]+）|(?<=X)XXX[一-鿿]+|(?<=_)_{4,}|(?<=\bT)[O]DO:[^\n]+)"
)
#: Signs beside a span that make it part of a notation.
_GLUE_BEFORE, _GLUE_AFTER = re.compile(r"[\w\\!\[\]}^_*$#`{]\Z", re.A), re.compile(r"[(\[\]{}^]")
_SLOT_WORD = re.compile(r"(?<![^\W_])(?:" + "|".join(w for w in SLOT_WORDS if w.isascii() or w[0] < "一") + r")(?![^\W_])|" + "|".join(w for w in SLOT_WORDS if w[0] >= "一"), re.I)


def outside_code(text: str) -> str:
    if "```" in text or "~~~" in text:
        text = _FENCE.sub("\n", text)
    if "<" in text or "`" in text:
        text = _PRE.sub(" ", text)
    return text


def segments(text: str) -> Iterator[str]:
    if "<" in text:
        text = _TAG.sub("\n", _TITLE_TAG.sub("\n", text))
    for m in _SENTENCE.finditer(text):
        s = m.group().strip()
        if _LETTER.search(s) or s.isdigit():
            yield s


@lru_cache(300_000)
def _h(s: str) -> int:
    return zlib.crc32(s.encode("utf-8", "replace")) & ((1 << BITS) - 1)


def segment_features(segment: str, is_title: bool, short: bool) -> list[int]:
    """Hashed word 1- and 2-grams with numbers, codes and identifiers folded, and length and title features."""
    s = _CODE.sub(" 7 ", segment) if _DIGIT.search(segment) else segment
    if "_" in s or "/" in s:
        s = _IDENT.sub(lambda m: " 8 " if m.group()[0] == "/" else " 6 ", s)
    tokens = [t.lower() if not t.isdigit() else ("0" if len(t) != 3 else t[0] + "dd") if t not in "678" else t for t in _TOKEN.findall(s)]
    out = [_h("s " + t) for t in tokens] + [_h("s " + a + " " + b) for a, b in zip(["^", *tokens], [*tokens, "$"])]
    out.append(_h(f"len {min(len(tokens) // 4, 8)}"))
    out.append(_h(f"title {is_title} short {short}"))
    return out


def span_features(text: str, m: re.Match) -> list[int]:
    """Character n-grams of the span's shape, and what stands beside it."""
    span = m.group()
    before, after = text[max(0, m.start() - 2) : m.start()], text[m.end() : m.end() + 1]
    shape = re.sub(r"\d", "9", span)
    kinds = re.sub("[一-鿿]+", "C", re.sub("[^\\W\\d_A-Z]+", "a", re.sub("[A-Z]+", "A", shape)))
    grams = [shape[i : i + 4].lower() for i in range(max(1, len(shape) - 3))]
    kind = lambda c: "w" if c.isalnum() else c if c else "^"
    out = [_h("p " + g) for g in grams]
    out += [_h("k " + kinds), _h("k3 " + kinds[:3]), _h("b " + span[0] + kind(before[-1:])), _h("b2 " + span[0] + span[1:2] + "".join(map(kind, before))), _h("a " + span[-1] + kind(after)), _h("d " + span[:2] + span[-2:] if not span[1:2].isalnum() else "d1 " + span[0] + span[-1])]
    return out


def weak_span_label(text: str, m: re.Match) -> int | None:
    """1 placeholder, 0 content, None unknown: by what the span says, and whether it stands free."""
    span = m.group()
    if _GLUE_BEFORE.search(text[: m.start()][-1:]) or _GLUE_AFTER.match(text, m.end()) or not _LETTER.search(span):
        return 0 if span[0] != "_" else None
    return 1 if _SLOT_WORD.search(span) and len(span) < 40 else None


def weak_segment_label(text: str, is_title: bool) -> int | None:
    """1 residue, 0 content, None unknown, for a whole field."""
    flat = re.sub(r"\s+", " ", _TAG.sub(" ", _TITLE_TAG.sub(" ", text))).strip().lower()
    hit = any(re.search(p, flat) for p in PHRASES)
    if not hit:
        return 0 if len(flat) > (12 if is_title else 60) else None
    if flat.startswith("lorem ipsum") or is_title:
        return 1
    return 1 if len(flat) < 190 else 0


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    bias_segment: float = 0.0
    bias_span: float = 0.0

    def segment(self, s: str, is_title: bool, short: bool) -> float:
        f = segment_features(s, is_title, short)
        return float(self.weights[f].sum()) * 8 / len(f) + self.bias_segment

    def span(self, text: str, m: re.Match) -> float:
        f = span_features(text, m)
        return float(self.weights[f].sum()) * 8 / len(f) + self.bias_span

    def has_placeholder(self, text: str) -> bool:
        return any(self.span(text, m) > 0 for m in SPAN.finditer(text))

    def only_residue(self, text: str, is_title: bool) -> bool:
        """All but a tenth of the text, in characters, is residue."""
        short, bad, room = len(text) < 400, 0, 0.1 * len(text)
        n = 0
        for s in segments(text):
            n += 1
            if self.segment(s, is_title, short) <= 0:
                bad += len(s)
                if bad > room:
                    return False
        return n > 0

    def case(self, text: str | None, is_title: bool) -> bool:
        if not text or not text.strip():
            return False
        plain = outside_code(text)
        return self.only_residue(plain, is_title) or self.has_placeholder(plain)


def fit(rows: list[tuple[str, bool, str]], steps: int = 60, l2: float = 1e-4) -> tuple[Model, dict[str, float]]:
    """rows: (text, is_title, host). Logistic regression by full-batch gradient steps with an adaptive rate; figures are of unseen hosts."""
    feats: list[list[int]] = []
    labels: list[int] = []
    kinds: list[int] = []
    held: list[bool] = []

    def add(f: list[int], y: int, kind: int, out: bool) -> None:
        feats.append(f), labels.append(y), kinds.append(kind), held.append(out)

    r = random.Random(11)
    for s, is_title, y in written_segments(r):
        for seg in segments(s):
            for short in (True, False) if y == 0 else (True,):
                add(segment_features(seg, is_title, short), y, 0, False)
    for t, y in written_spans(r):
        for m in SPAN.finditer(t):
            add(span_features(t, m), y, 1, False)
    for text, is_title, host in rows:
        if not text or not text.strip():
            continue
        out = zlib.crc32(host.encode()) % 5 == 0
        text = outside_code(text)
        y = weak_segment_label(text, is_title)
        if y is not None:
            short = len(text) < 400
            for s in segments(text):
                add(segment_features(s, is_title, short), y, 0, out)
        for m in SPAN.finditer(text):
            if (y := weak_span_label(text, m)) is not None:
                add(span_features(text, m), y, 1, out)
    y = np.array(labels, np.float32)
    kind = np.array(kinds)
    train = ~np.array(held)
    length = np.array([len(f) for f in feats])
    col = np.concatenate([np.array(f, np.int64) for f in feats])
    row = np.repeat(np.arange(len(feats)), length)
    val = (8.0 / length)[row].astype(np.float32)
    weight = np.where(train, 1.0, 0.0)
    for k in (0, 1):  # both classes of a kind count alike
        for c in (0, 1):
            at = train & (kind == k) & (y == c)
            weight[at] /= max(1, at.sum())
    w = np.zeros(1 << BITS)
    b = np.zeros(2)
    g2, gb2 = np.full(1 << BITS, 1e-8), np.full(2, 1e-8)
    for _ in range(steps):
        z = np.bincount(row, val * w[col], len(feats)) + b[kind]
        d = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g = np.bincount(col, val * d[row], 1 << BITS) + l2 * w
        gb = np.bincount(kind, d, 2)
        g2 += g * g
        gb2 += gb * gb
        w -= 0.5 * g / np.sqrt(g2)
        b -= 0.1 * gb / np.sqrt(gb2)
    z = np.bincount(row, val * w[col], len(feats)) + b[kind]
    figures = {}
    for k, name in enumerate(("segment", "span")):
        for c, what in ((1, "recall"), (0, "specificity")):
            at = ~train & (kind == k) & (y == c)
            figures[f"{name}_{what}"] = float(((z[at] > 0) == c).mean()) if at.any() else float("nan")
    return Model(w.astype(np.float32), float(b[0]), float(b[1])), figures


def train(md_corpus: DataFrame, front_matter: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> tuple[Model, dict[str, float]]:
    """Fit on sample_rows bodies of at most sample_bytes and their titles: those whose doc_id has the least hashes, so the same whatever the partitions."""
    host = F.coalesce(F.split(F.col("relpath"), "/")[0], F.lit(""))
    keys = sample_keys(md_corpus, sample_rows, 6)
    small = lambda c: F.col(c).isNotNull() & (F.octet_length(c) <= sample_bytes)
    bodies = md_corpus.where(small("body")).join(keys, "doc_id", "left_semi").select(F.col("body").alias("text"), F.lit(False).alias("t"), host.alias("host"))
    titles = front_matter.where(small("title")).join(keys, "doc_id", "left_semi").select(F.col("title").alias("text"), F.lit(True), F.coalesce(F.split(F.col("source"), "/")[1], F.lit("")))
    return fit(sorted(tuple(r) for r in bodies.unionAll(titles).collect()))


def find(fields: DataFrame, model: Model) -> DataFrame:
    """(doc_id, field) of the cases among (doc_id, field, text)."""
    shared = fields.sparkSession.sparkContext.broadcast((model, prototypes(fields.sparkSession)))  # 1 MB of weights and a fixed table, whatever the input

    def make():
        m, repair, plain = shared.value[0], Repairer(), Normaliser(shared.value[1])

        def run(ids, names, texts) -> Iterator[tuple]:
            for i, n, t in zip(ids, names, texts):
                if t and not t.isascii():  # look-alike characters and wrong decoding must not hide residue
                    t = plain(repair(t)[2])
                if m.case(t, n == "title"):
                    yield i, n

        return run

    return map_batches(fields.select("doc_id", "field", "text"), make, "doc_id bigint, field string")
