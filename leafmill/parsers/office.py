"""Office Open XML: text documents, presentations and workbooks, read from the zip parts alone."""

from __future__ import annotations

import datetime as dt
import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from typing import IO
from xml.etree import ElementTree as ET

from .base import Draft

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
M = "{http://schemas.openxmlformats.org/officeDocument/2006/math}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
MAX_ROWS, MAX_COLUMNS = 2000, 100


class Package:
    """Parts of a document by name, with their relationships."""

    def __init__(self, content: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        self.names = set(self.zip.namelist())

    def read(self, name: str) -> bytes | None:
        return self.zip.read(name) if name in self.names else None

    def xml(self, name: str) -> ET.Element | None:
        blob = self.read(name)
        return ET.fromstring(blob) if blob else None

    def related(self, name: str) -> dict[str, str]:
        """Relationship id -> part name."""
        folder, base = posixpath.split(name)
        root = self.xml(f"{folder}/_rels/{base}.rels")
        out = {}
        for rel in root if root is not None else ():
            if rel.get("TargetMode") != "External":
                target = rel.get("Target", "")
                out[rel.get("Id")] = target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join(folder, target))
        return out

    def core_title(self) -> str | None:
        root = self.xml("docProps/core.xml")
        found = None if root is None else root.find("{http://purl.org/dc/elements/1.1/}title")
        return None if found is None else found.text


def detect(content: bytes | IO[bytes]) -> str:
    """docx, xlsx, pptx, zip or zip-corrupt; of an open file only the directory is read."""
    try:
        names = set(zipfile.ZipFile(io.BytesIO(content) if isinstance(content, bytes) else content).namelist())
    except (zipfile.BadZipFile, ValueError, EOFError):
        return "zip-corrupt"
    if "word/document.xml" in names:
        return "docx"
    if any(n.startswith("xl/") and n.endswith("workbook.xml") for n in names):
        return "xlsx"
    return "pptx" if "ppt/presentation.xml" in names else "zip"


# ------------------------------------------------------------------------------------------------------------------ text documents


class _Word:
    def __init__(self, content: bytes, draft: Draft):
        self.draft, self.package = draft, Package(content)
        self.rels = self.package.related("word/document.xml")
        styles = self.package.xml("word/styles.xml")
        self.styles = {s.get(W + "styleId"): (s.find(W + "name").get(W + "val") or "") for s in (styles if styles is not None else ()) if s.tag == W + "style" and s.find(W + "name") is not None}
        self.formats = self._numbering()

    def _numbering(self) -> dict[tuple[str, str], str]:
        """(list id, level) -> number format."""
        root = self.package.xml("word/numbering.xml")
        if root is None:
            return {}
        levels = {a.get(W + "abstractNumId"): {x.get(W + "ilvl"): x.find(W + "numFmt").get(W + "val") for x in a.findall(W + "lvl") if x.find(W + "numFmt") is not None} for a in root.findall(W + "abstractNum")}
        out = {}
        for num in root.findall(W + "num"):
            abstract = num.find(W + "abstractNumId")
            for level, fmt in levels.get(abstract.get(W + "val") if abstract is not None else None, {}).items():
                out[num.get(W + "numId"), level] = fmt
        return out

    def pictures(self, el: ET.Element) -> list[tuple[bytes, str]]:
        out = []
        for blip in el.iter(A + "blip"):
            part = self.rels.get(blip.get(R + "embed"))
            if part and (blob := self.package.read(part)) is not None:
                out.append((blob, part.rpartition(".")[2] or "png"))
        return out

    @staticmethod
    def own_runs(p: ET.Element) -> Iterator[ET.Element]:
        for child in p:
            if child.tag == W + "r":
                yield child
            elif child.tag in (W + "hyperlink", W + "ins", W + "smartTag"):
                yield from child.iter(W + "r")

    @staticmethod
    def run_text(r: ET.Element) -> str:
        return "".join(x.text or "" if x.tag == W + "t" else "\t" if x.tag == W + "tab" else "\n" if x.tag in (W + "br", W + "cr") else "" for x in r)

    def runs(self, p: ET.Element) -> str:
        """Neighbouring runs of one emphasis are one stretch."""
        parts: list[list] = []
        on = lambda rpr, tag: (e := None if rpr is None else rpr.find(W + tag)) is not None and e.get(W + "val") not in ("0", "false", "none")
        for r in self.own_runs(p):
            if text := self.run_text(r):
                rpr = r.find(W + "rPr")
                key = ("**" if on(rpr, "b") else "") + ("*" if on(rpr, "i") else "")
                if parts and parts[-1][0] == key:
                    parts[-1][1] += text
                else:
                    parts.append([key, text])
        return "".join(f"{k}{t}{k}" for k, t in parts)

    def paragraph(self, p: ET.Element) -> None:
        text = self.runs(p)
        ppr = p.find(W + "pPr")
        style_el = None if ppr is None else ppr.find(W + "pStyle")
        style = self.styles.get(style_el.get(W + "val"), style_el.get(W + "val") or "").lower() if style_el is not None else ""
        num = None if ppr is None else ppr.find(W + "numPr")
        heading = re.match(r"heading\s*([1-9])", style)
        said = text.strip()
        if said and (heading or style == "title"):
            self.draft.say("#" * (int(heading.group(1)) if heading else 1) + " " + said)
        elif said and ("list" in style or num is not None):
            level, ordered = 0, "number" in style
            if num is not None:
                lv, nid = num.find(W + "ilvl"), num.find(W + "numId")
                level = int(lv.get(W + "val") or 0) if lv is not None else 0
                fmt = self.formats.get((nid.get(W + "val") if nid is not None else "", str(level)))
                ordered = ordered or fmt not in (None, "bullet", "none")
            self.draft.say("  " * level + ("1." if ordered else "-") + " " + said)
        elif said:
            self.draft.say(text)
        for i, (blob, ext) in enumerate(self.pictures(p), 1):  # pictures of any paragraph are kept, those in headings and lists too
            self.draft.picture(blob, ext, f"图{i}", "内嵌图未存盘")
        self.marks(p)

    def marks(self, el: ET.Element) -> None:
        if n := sum(1 for _ in el.iter(M + "oMath")):
            self.draft.leave("formula", n, "含数学公式(OMML)未提取", cls="formula", unit="para")
        bare = sum(1 for d in el.iter(W + "drawing") if next(d.iter(A + "blip"), None) is None and next(d.iter(W + "txbxContent"), None) is None)
        if bare:
            self.draft.leave("chart", bare, "图表/SmartArt等图形未提取", cls="chart")

    def table(self, tbl: ET.Element) -> None:
        rows: list[list[str]] = []
        for tr in tbl.findall(W + "tr"):
            row: list[str] = []
            for tc in tr.findall(W + "tc"):
                pr = tc.find(W + "tcPr")
                span = pr.find(W + "gridSpan") if pr is not None else None
                merge = pr.find(W + "vMerge") if pr is not None else None
                text = "\n".join("".join(self.run_text(r) for r in self.own_runs(p)) for p in tc.findall(W + "p"))
                if merge is not None and merge.get(W + "val") != "restart" and rows and len(row) < len(rows[-1]):
                    text = rows[-1][len(row)]
                row += [text] * int(span.get(W + "val") or 1 if span is not None else 1)
            rows.append(row)
        self.draft.table(rows)
        for i, (blob, ext) in enumerate(self.pictures(tbl), 1):
            self.draft.picture(blob, ext, f"表格图{i}", "表格内嵌图未存盘")
        self.marks(tbl)

    def notes(self, part: str, tag: str) -> list[tuple[str, str]]:
        """(who, text) of the notes in a part."""
        root = self.package.xml(f"word/{part}.xml")
        return [(" ".join((el.get(W + "author") or "").split()) if tag == "comment" else "", "".join(t.text or "" for t in el.iter(W + "t")).strip()) for el in (root.iter(W + tag) if root is not None else ())]

    def blocks(self, body: ET.Element) -> None:
        for el in body:
            if el.tag == W + "p":
                self.paragraph(el)
            elif el.tag == W + "tbl":
                self.table(el)
            elif el.tag == W + "sdt" and (inner := el.find(W + "sdtContent")) is not None:
                self.blocks(inner)


def parse_docx(content: bytes, draft: Draft) -> None:
    w = _Word(content, draft)
    root = w.package.xml("word/document.xml")
    draft.titles.append((w.package.core_title(), False))
    draft.if_empty = f"<!-- 空文档: {draft.source.name} -->"
    w.blocks(root.find(W + "body"))
    boxes = [("", "".join(x.text or "" for x in t.iter(W + "t")).strip()) for t in root.iter(W + "txbxContent")]
    for head, items in (("浮动文本框内容", boxes), ("脚注", w.notes("footnotes", "footnote")), ("尾注", w.notes("endnotes", "endnote")), ("批注", w.notes("comments", "comment"))):
        draft.say(head, "### ", part=head, kind="head")
        for who, text in items:
            draft.say(text, f"[{who}] " if who else "", prompt=True, part=head)


# -------------------------------------------------------------------------------------------------------------------- presentations


def _paragraphs(body: ET.Element) -> list[tuple[int, str]]:
    out = []
    for p in body.findall(A + "p"):
        text = "".join(x.text or "" if x.tag == A + "t" else "\x0b" if x.tag == A + "br" else "" for r in p for x in ([r] if r.tag == A + "br" else r)).strip()
        if text:
            pr = p.find(A + "pPr")
            out.append((int(pr.get("lvl") or 0) if pr is not None else 0, text))
    return out


def _shapes(tree: ET.Element) -> Iterator[ET.Element]:
    for el in tree:
        if el.tag == P + "grpSp":
            yield from _shapes(el)
        elif el.tag in (P + "sp", P + "pic", P + "graphicFrame", P + "cxnSp"):
            yield el


def _slide(package: Package, part: str, number: int, draft: Draft) -> str | None:
    """Blocks of one slide; gives its title."""
    root, rels = package.xml(part), package.related(part)
    shapes = list(_shapes(root.find(f"{P}cSld/{P}spTree")))
    text_of = lambda sh: _paragraphs(b) if (b := sh.find(P + "txBody")) is not None else []

    def role(sh: ET.Element) -> str | None:
        ph = sh.find(f"{P}nvSpPr/{P}nvPr/{P}ph")
        return None if ph is None else ph.get("type") or "body"

    head = next((s for s in shapes if role(s) in ("title", "ctrTitle") and text_of(s)), None)
    if head is None:
        head = next((s for s in shapes if s.tag == P + "sp" and role(s) is None and len(text_of(s)) == 1 and "\x0b" not in text_of(s)[0][1]), None)
    title = " ".join(t for _, t in text_of(head)) if head is not None else None
    draft.say(title, f"## Slide {number}", kind="slide")
    pictures, left = 0, 0
    for sh in shapes:
        if sh is head:
            continue
        if sh.tag == P + "sp":
            if sh.find(P + "txBody") is None:
                left += sh.find(f"{P}spPr/{A}custGeom") is None
            else:
                draft.say("\n".join("  " * lv + "- " + t if lv else t for lv, t in text_of(sh)), prompt=True)
        elif sh.tag == P + "pic":
            blip = next(sh.iter(A + "blip"), None)
            part_name = rels.get(blip.get(R + "embed")) if blip is not None else None
            blob = package.read(part_name) if part_name else None
            if blob is not None:
                pictures += 1
                draft.picture(blob, part_name.rpartition(".")[2], f"图{pictures}", "图片未存盘")
            else:
                left += 1
        elif sh.tag == P + "graphicFrame":
            table = next(sh.iter(A + "tbl"), None)
            if table is not None:
                draft.table([["\n".join(t for _, t in _paragraphs(tc.find(A + "txBody"))) for tc in tr.findall(A + "tc")] for tr in table.findall(A + "tr")])
            else:
                left += 1
    if left:
        draft.leave("chart", left, "图表/SmartArt等未提取", loc=f"slide:{number}", cls="chart", unit="slide")
    for name in rels.values():
        if "/notesSlides/" in name and (notes := package.xml(name)) is not None:
            draft.say("\n".join(t for sh in notes.iter(P + "sp") if role(sh) == "body" for _, t in text_of(sh)).strip(), "> 备注: ", prompt=True)
    return title


def parse_pptx(content: bytes, draft: Draft) -> None:
    package = Package(content)
    rels = package.related("ppt/presentation.xml")
    root = package.xml("ppt/presentation.xml")
    parts = [rels[s.get(R + "id")] for s in root.iter(P + "sldId") if s.get(R + "id") in rels]
    titles = [_slide(package, p, i, draft) for i, p in enumerate(parts, 1)]
    draft.titles += [(titles[0] if titles else None, True), (package.core_title(), False)]
    draft.if_empty = f"<!-- 空 presentation: {draft.source.name} -->"


# ------------------------------------------------------------------------------------------------------------------------ workbooks

_DATE_IDS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def column_number(letters: str) -> int:
    n = 0
    for c in letters.upper():
        n = n * 26 + ord(c) - 64
    return n


def cell_position(ref: str) -> tuple[int, int]:
    m = re.fullmatch(r"\$?([A-Za-z]+)\$?(\d+)", ref)
    return int(m.group(2)), column_number(m.group(1))


class _Book:
    def __init__(self, content: bytes):
        self.package = Package(content)
        self.part = next(n for n in sorted(self.package.names) if n.startswith("xl/") and n.endswith("workbook.xml"))
        strings = self.package.xml("xl/sharedStrings.xml")
        self.strings = ["".join(t.text or "" for t in si.iter(S + "t")) for si in (strings.findall(S + "si") if strings is not None else ())]
        styles = self.package.xml("xl/styles.xml")
        self.dates: set[int] = set()
        if styles is not None:
            own = {f.get("numFmtId"): re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode") or "") for f in styles.iter(S + "numFmt")}
            xfs = styles.find(S + "cellXfs")
            for i, xf in enumerate(xfs if xfs is not None else ()):
                fmt = xf.get("numFmtId") or "0"
                if int(fmt) in _DATE_IDS or re.search("[ymdhs]", own.get(fmt, ""), re.I):
                    self.dates.add(i)

    def sheets(self) -> Iterator[tuple[str, str]]:
        rels = self.package.related(self.part)
        for s in self.package.xml(self.part).iter(S + "sheet"):
            if s.get(R + "id") in rels:
                yield s.get("name") or "", rels[s.get(R + "id")]

    def value(self, c: ET.Element) -> str | None:
        kind, v = c.get("t") or "n", c.find(S + "v")
        if kind == "inlineStr":
            return "".join(t.text or "" for t in c.iter(S + "t"))
        if v is None or v.text is None:
            return None
        if kind == "s":
            return self.strings[int(v.text)]
        if kind == "b":
            return str(v.text == "1")
        if kind != "n":
            return v.text
        try:
            x = float(v.text)
        except ValueError:
            return v.text
        if int(c.get("s") or 0) in self.dates:
            when = dt.datetime(1899, 12, 30) + dt.timedelta(days=x)
            return str(when.replace(microsecond=0) if when.microsecond < 500_000 else when.replace(microsecond=0) + dt.timedelta(seconds=1))
        return str(int(x)) if re.fullmatch(r"-?\d+", v.text) else str(x)


def parse_xlsx(content: bytes, draft: Draft) -> None:
    book = _Book(content)
    draft.titles.append((book.package.core_title(), False))
    draft.if_empty = "<!-- 空工作簿 -->"
    for name, part in book.sheets():
        root = book.package.xml(part)
        first: dict[tuple[int, int], tuple[int, int]] = {}
        for mc in root.iter(S + "mergeCell"):
            (r0, c0), (r1, c1) = map(cell_position, (mc.get("ref") + ":" + mc.get("ref")).split(":")[:2])
            for r in range(r0, min(r1, MAX_ROWS) + 1):
                for c in range(c0, min(c1, MAX_COLUMNS + 1) + 1):  # a column beyond only says that the sheet is wide
                    if (r, c) != (r0, c0):
                        first[r, c] = r0, c0
        grid: dict[int, dict[int, str]] = {}
        formulas, cut, at_row = 0, False, 0
        for row in root.iter(S + "row"):
            at_row = int(row.get("r") or at_row + 1)
            if at_row > MAX_ROWS:
                cut = True
                break
            at_col = 0
            for c in row.findall(S + "c"):
                at_col = cell_position(c.get("r"))[1] if c.get("r") else at_col + 1
                v, f = book.value(c), c.find(S + "f")
                if v is None and f is not None and f.text:
                    v, formulas = "=" + f.text, formulas + 1
                if v is not None:
                    grid.setdefault(at_row, {})[at_col] = v
        for (r, c), top in first.items():
            if c not in grid.get(r, {}) and (v := grid.get(top[0], {}).get(top[1])) is not None:
                grid.setdefault(r, {})[c] = v
        rows = []
        for r in sorted(grid):
            cells = [grid[r].get(c, "") for c in range(1, max(grid[r], default=0) + 1)]
            while cells and cells[-1] == "":
                cells.pop()
            if cells:
                rows.append(cells)
        if not rows:
            continue
        width = max(map(len, rows))
        wide = width > MAX_COLUMNS
        if wide:
            rows = [r[:MAX_COLUMNS] + ["…"] for r in rows]
        draft.say(f"### Sheet: {name}")
        draft.table(rows)
        if cut or wide:
            why = " 且".join(x for x, on in ((f"行数超 {MAX_ROWS}", cut), (f"列数超 {MAX_COLUMNS}", wide)) if on)
            draft.leave("truncated", 1, f"sheet '{name}' {why}, 已截断", loc=f"sheet:{name}")
        if formulas:
            draft.leave("formula-cell", formulas, "无缓存值, 已回退显示公式文本, 见原文件复核", loc=f"sheet:{name}")
