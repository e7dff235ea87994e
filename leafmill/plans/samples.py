"""Small documents of every format, put together from their parts in memory: what the parser queries and the tests read."""

from __future__ import annotations

import io
import zipfile
import zlib

WORD = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:m="http://schemas.openxmlformats.org/officeDocument/2006/math" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
SHEET = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
SLIDE = 'xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
PNG = b"\x89PNG\r\n\x1a\n" + bytes(16)


def zipped(parts: dict[str, str | bytes]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def rels(**targets: str) -> str:
    return '<Relationships xmlns="x">' + "".join(f'<Relationship Id="{k}" Target="{v}"/>' for k, v in targets.items()) + "</Relationships>"


def core(title: str) -> str:
    return f'<cp xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>{title}</dc:title></cp>'


# ---- text documents
def run(text: str, mark: str = "") -> str:
    pr = "".join(f"<w:{m}/>" for m in mark)
    return f'<w:r>{f"<w:rPr>{pr}</w:rPr>" if pr else ""}<w:t xml:space="preserve">{text}</w:t></w:r>'


def p(*runs: str, style: str = "", extra: str = "", numbered: tuple[int, int] | None = None) -> str:
    pr = (f'<w:pStyle w:val="{style}"/>' if style else "") + (f'<w:numPr><w:ilvl w:val="{numbered[1]}"/><w:numId w:val="{numbered[0]}"/></w:numPr>' if numbered else "")
    return f"<w:p>{f'<w:pPr>{pr}</w:pPr>' if pr else ''}{''.join(r if r.startswith('<') else run(r) for r in runs)}{extra}</w:p>"


def docx(body: str, **parts: str | bytes) -> bytes:
    """parts: other parts by name, with __ for / and _dot_ for a dot."""
    return zipped({"word/document.xml": f"<w:document {WORD}><w:body>{body}</w:body></w:document>"} | {k.replace("__", "/").replace("_dot_", "."): v for k, v in parts.items()})


def picture(rel: str) -> str:
    return f'<w:r><w:drawing><a:blip r:embed="{rel}"/></w:drawing></w:r>'


RICH_DOCX = docx(
    p("Survey", style="Heading1") + p(run("plain "), run("bold", "b"), run(" and "), run("both", "bi")) + p("first", style="ListNumber") + p("inner", numbered=(1, 1)) + p("bullet", numbered=(2, 0))
    + p("eq", extra="<m:oMath/><m:oMath/>") + p("fig", extra=picture("r1")) + p("sketch", extra="<w:r><w:drawing/></w:r>")
    + "<w:tbl><w:tr><w:tc><w:tcPr><w:vMerge w:val='restart'/></w:tcPr>" + p("a|b") + "</w:tc><w:tc>" + p("x") + "</w:tc></w:tr><w:tr><w:tc><w:tcPr><w:vMerge/></w:tcPr>" + p("") + "</w:tc><w:tc>" + p("y") + "</w:tc></w:tr></w:tbl>"
    + "<w:p><w:r><w:txbxContent>" + p("in a box") + "</w:txbxContent></w:r></w:p>",
    word__numbering_dot_xml=f"<w:numbering {WORD}><w:abstractNum w:abstractNumId='7'><w:lvl w:ilvl='1'><w:numFmt w:val='decimal'/></w:lvl></w:abstractNum><w:abstractNum w:abstractNumId='8'><w:lvl w:ilvl='0'><w:numFmt w:val='bullet'/></w:lvl></w:abstractNum><w:num w:numId='1'><w:abstractNumId w:val='7'/></w:num><w:num w:numId='2'><w:abstractNumId w:val='8'/></w:num></w:numbering>",
    word___rels__document_dot_xml_dot_rels=rels(r1="media/i.png"), word__media__i_dot_png=PNG,
    word__footnotes_dot_xml=f"<w:footnotes {WORD}><w:footnote>{p('')}</w:footnote><w:footnote>{p('see below')}</w:footnote></w:footnotes>",
    word__comments_dot_xml=f"<w:comments {WORD}><w:comment w:author='Re  Viewer'>{p('look')}</w:comment></w:comments>",
    docProps__core_dot_xml=core("Annual survey"),
)


# ---- workbooks
def xlsx(cells: str, merges: str = "", name: str = "T", strings: str = "", styles: str = "") -> bytes:
    parts = {"xl/workbook.xml": f'<workbook {SHEET}><sheets><sheet name="{name}" r:id="r1"/></sheets></workbook>', "xl/_rels/workbook.xml.rels": rels(r1="worksheets/s1.xml"), "xl/worksheets/s1.xml": f"<worksheet {SHEET}><sheetData>{cells}</sheetData>{merges}</worksheet>"}
    if strings:
        parts["xl/sharedStrings.xml"] = f"<sst {SHEET}>{strings}</sst>"
    if styles:
        parts["xl/styles.xml"] = f"<styleSheet {SHEET}>{styles}</styleSheet>"
    return zipped(parts)


RICH_XLSX = xlsx(
    '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>n</t></is></c><c r="C1" t="b"><v>1</v></c></row><row r="2"><c r="B2"><v>2.5</v></c><c r="C2" s="1"><v>45292</v></c><c r="D2" t="inlineStr"><is><t></t></is></c></row>'
    '<row r="3"/><row r="4"><c r="B4"><f>B2*2</f></c></row>',
    '<mergeCells><mergeCell ref="A1:A4"/></mergeCells>', "Sales", "<si><t>kind</t></si>", '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs>',
)
LONG_XLSX = xlsx("".join(f'<row r="{i}"><c r="A{i}"><v>{i}</v></c></row>' for i in range(1, 2102)), name="Long")


# ---- presentations
def shape(text: str, kind: str = "", level: int = 0) -> str:
    ph = f'<p:nvPr><p:ph type="{kind}"/></p:nvPr>' if kind else "<p:nvPr/>"
    lv = f'<a:pPr lvl="{level}"/>' if level else ""
    paragraphs = "".join(f"<a:p>{lv}<a:r><a:t>{t}</a:t></a:r></a:p>" for t in text.split("\n"))
    return f"<p:sp><p:nvSpPr>{ph}</p:nvSpPr><p:txBody>{paragraphs}</p:txBody></p:sp>"


def pptx(*slides: str, **parts: str | bytes) -> bytes:
    """Slides by the content of their shape trees."""
    out = {
        "ppt/presentation.xml": f'<p:presentation {SLIDE}><p:sldIdLst>{"".join(f"""<p:sldId r:id="r{i}"/>""" for i in range(1, len(slides) + 1))}</p:sldIdLst></p:presentation>',
        "ppt/_rels/presentation.xml.rels": rels(**{f"r{i}": f"slides/slide{i}.xml" for i in range(1, len(slides) + 1)}),
    }
    for i, s in enumerate(slides, 1):
        out[f"ppt/slides/slide{i}.xml"] = f"<p:sld {SLIDE}><p:cSld><p:spTree>{s}</p:spTree></p:cSld></p:sld>"
    return zipped(out | {k.replace("__", "/").replace("_dot_", "."): v for k, v in parts.items()})


_CELL = "<a:tc><a:txBody><a:p><a:r><a:t>{}</a:t></a:r></a:p></a:txBody></a:tc>"
RICH_PPTX = pptx(
    shape("Topic", "title") + "<p:grpSp>" + shape("inner\nmore", level=1) + "</p:grpSp>" + f"<p:graphicFrame><a:tbl><a:tr>{_CELL.format('a')}{_CELL.format('b')}</a:tr><a:tr>{_CELL.format('1')}{_CELL.format('2')}</a:tr></a:tbl></p:graphicFrame>"
    + '<p:pic><a:blip r:embed="i1"/></p:pic><p:graphicFrame/><p:cxnSp/>' + shape("Click to add text", "body"),
    shape("only line") + shape("below\nit"),
    ppt__slides___rels__slide1_dot_xml_dot_rels=rels(i1="../media/i.png", n1="../notesSlides/n1.xml"), ppt__media__i_dot_png=PNG,
    ppt__notesSlides__n1_dot_xml=f"<p:notes {SLIDE}><p:cSld><p:spTree>{shape('say this', 'body')}</p:spTree></p:cSld></p:notes>",
)


# ---- page documents
def pdf(pages: list[bytes], fonts: str = "/F1 5 0 R", extra: bytes = b"", catalog: str = "", images: dict[int, str] | None = None, pack: bool = False) -> bytes:
    """Pages by their content streams; page i is object 10 + 2i, its content 11 + 2i. images: page number -> XObject entries."""
    kids = " ".join(f"{10 + 2 * i} 0 R" for i in range(len(pages)))
    out = [b"%PDF-1.4\n", f"1 0 obj<</Type/Catalog/Pages 2 0 R{catalog}>>endobj\n2 0 obj<</Type/Pages/Kids[{kids}]/Count {len(pages)}>>endobj\n5 0 obj<</Type/Font/Subtype/Type1>>endobj\n".encode()]
    for i, content in enumerate(pages):
        body, how = (zlib.compress(content), "/Filter/FlateDecode") if pack else (content, "")
        pictures = f"/XObject<<{(images or {}).get(i, '')}>>"
        out.append(f"{10 + 2 * i} 0 obj<</Type/Page/Parent 2 0 R/MediaBox[0 0 612 792]/Contents {11 + 2 * i} 0 R/Resources<</Font<<{fonts}>>{pictures}>>>>endobj\n{11 + 2 * i} 0 obj<</Length {len(body)}{how}>>stream\n".encode())
        out += [body, b"\nendstream\nendobj\n"]
    return b"".join([*out, extra])


def line(text: str, x: int, y: int, size: int = 12) -> bytes:
    return f"BT /F1 {size} Tf {x} {y} Td ({text}) Tj ET\n".encode()


#: A grid of two rows and two columns, its words, and a tall word across it; a line above.
GRID = b"1 w 100 600 m 300 600 l S 100 570 m 300 570 l S 100 540 m 300 540 l S 100 540 m 100 600 l S 200 540 m 200 600 l S 300 540 m 300 600 l S\n"
TABLE_PDF = pdf([GRID + line("A1", 110, 580) + line("B1", 210, 580) + line("A2", 110, 550) + line("B2", 210, 550) + line("Above", 72, 700)])
_MARK = line("WATERMARK", 72, 40)
FIVE_PAGES = pdf([_MARK + line(f"Text of page {i}", 72, 700) for i in range(1, 6)], pack=True)
OUTLINE_PDF = pdf(
    [line("Body", 72, 600)], catalog="/Outlines 6 0 R",
    extra=b"6 0 obj<</First 7 0 R>>endobj\n7 0 obj<</Title(One)/Dest[10 0 R/Fit]/First 8 0 R>>endobj\n8 0 obj<</Title(Two)/Dest[10 0 R/Fit]>>endobj\n9 0 obj<</Title(Body)/Producer(x)>>endobj\n",
)
SCAN_PDF = pdf([b""], images={0: "/I 30 0 R"}, extra=b"30 0 obj<</Subtype/Image/Width 2/Height 2/BitsPerComponent 8/ColorSpace/DeviceGray/Length 4>>stream\n\x00\xff\xff\x00\nendstream\nendobj\n")
LOCKED_PDF = pdf([line("x", 72, 700)], extra=b"trailer<</Encrypt 9 0 R>>\nstartxref\n0\n")

#: name -> (content, handler, encoding, language) of the parser queries.
DOCUMENTS: dict[str, tuple[bytes, str, str | None, str | None]] = {
    "rich.docx": (RICH_DOCX, "docx", None, None), "empty.docx": (docx(""), "docx", None, None), "broken.docx": (b"PK\3\4" + bytes(200), "docx", None, None),
    "rich.xlsx": (RICH_XLSX, "xlsx", None, None), "long.xlsx": (LONG_XLSX, "xlsx", None, None),
    "deck.pptx": (RICH_PPTX, "pptx", None, None),
    "table.pdf": (TABLE_PDF, "pdf", None, None), "five.pdf": (FIVE_PAGES, "pdf", None, None), "outline.pdf": (OUTLINE_PDF, "pdf", None, None), "scan.pdf": (SCAN_PDF, "pdf", None, None), "locked.pdf": (LOCKED_PDF, "pdf", None, None),
    "note.txt": ("中文GBK编码的纯文本。".encode("gbk"), "text", "gbk", None), "a.py": (b"x = 1\n\n", "text", "utf-8", "python"), "page.md": (b"text\n# Head\nmore", "md", "utf-8", None), "pic.png": (PNG, "image", None, None), "photo.jpg": (b"\xff\xd8\xff\xe0", "image", None, None),
}
#: name -> content of the detection query.
ZIPS: dict[str, bytes] = {
    "a.docx": RICH_DOCX, "b.zip": RICH_XLSX, "c.bin": RICH_PPTX, "d.docx": zipped({"x.txt": "x"}), "e.xlsx": b"PK\3\4" + bytes(200), "f.xlsx": zipped({"xl/sub/workbook.xml": "x"}), "g.zip": zipped({}),
}
