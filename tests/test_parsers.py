import zlib

import pytest
from pyspark.sql import functions as F

from leafmill.parsers import base, parse, pdf, register, vector
from leafmill.parsers.office import cell_position, detect
from leafmill.parsers.plain import follow_pictures, sniff_encoding
from leafmill.plans import samples as S
from leafmill.plans.render import rendered


def drafted(handler, content, name="a.x", **more):
    return parse(handler, content, base.Source(name, **more))


@pytest.fixture
def shown(spark):
    def f(*drafts, stored=True):
        rows = spark.createDataFrame([d.row() for d in drafts], base.PARSED).withColumn("id", F.lit("doc-x"))
        return {r.relpath: r for r in rendered(rows, stored).collect()}

    return f


def test_cells_and_zips():
    assert cell_position("$AB$12") == (12, 28)
    assert detect(S.RICH_DOCX) == "docx" and detect(b"PK\3\4junk") == "zip-corrupt"


def test_wide_and_long_sheets(shown):
    wide = S.xlsx('<row r="1">' + "".join(f'<c><v>{i}</v></c>' for i in range(1, 121)) + "</row>", '<mergeCells><mergeCell ref="A2:XFD3"/></mergeCells>')
    out = shown(drafted("xlsx", wide, "w.xlsx"), drafted("xlsx", S.LONG_XLSX, "l.xlsx"))
    assert "| 100 | … |" in out["w.xlsx"].body and "列数超 100" in out["w.xlsx"].body
    assert "| 2000 |" in out["l.xlsx"].body and "| 2001 |" not in out["l.xlsx"].body and "行数超 2000" in out["l.xlsx"].body


def test_prompts_heads_and_titles(shown):
    deck = S.pptx(S.shape("Click to add title", "title") + S.shape("单击此处添加文本", "body") + S.shape("real"))
    boxed = S.docx(S.p("x") + "<w:p><w:r><w:txbxContent>" + S.p("Click to add text") + "</w:txbxContent></w:r></w:p>", docProps__core_dot_xml=S.core("Document"))
    out = shown(drafted("pptx", deck, "d/deck.pptx"), drafted("docx", boxed, "b.docx"))
    assert out["d/deck.pptx"].body == "## Slide 1\n\nreal" and out["d/deck.pptx"].title == "deck"
    assert out["b.docx"].body == "x" and out["b.docx"].title == "b"


def test_filters_and_predictors():
    text = b"BT /F1 12 Tf 72 700 Td (Hello) Tj ET"
    assert pdf._hexadecimal(text.hex().encode() + b">") == text
    import base64

    assert pdf._ascii85(base64.a85encode(text) + b"~>") == text
    assert pdf._run_length(bytes([len(text) - 1]) + text + b"\xfea" + b"\x80") == text + b"aaa"
    assert pdf._lzw(bytes([0x80, 0x0B, 0x60, 0x50, 0x22, 0x0C, 0x0C, 0x85, 0x01])) == b"-----A---B"
    assert pdf.unpredicted(b"\2\1\1\2\1\1", 12, 1, 8, 2) == b"\1\1\2\2"
    png = pdf.png(b"\0\xff\xff\0", 2, 2, 8, 1)
    assert png.startswith(vector.PNG) and zlib.decompress(dict(vector._chunks(png))[b"IDAT"]) == b"\0\0\xff\0\xff\0"


def test_pages_with_other_filters(shown):
    content = S.line("Hello", 72, 700)
    hexed = S.pdf([content]).replace(content, content.hex().encode() + b">").replace(f"/Length {len(content)}".encode(), f"/Length {2 * len(content) + 1}/Filter/ASCIIHexDecode".encode())
    unknown = S.pdf([content]).replace(f"/Length {len(content)}".encode(), f"/Length {len(content)}/Filter/Nonsense".encode())
    out = shown(drafted("pdf", hexed, "h.pdf"), drafted("pdf", unknown, "u.pdf"))
    assert out["h.pdf"].body == "<!-- page:1 -->\n\nHello"
    assert "parse-failed=1" in out["u.pdf"].body and "scan-page" not in out["u.pdf"].body


def test_deep_trees_and_long_outlines(shown):
    n = 60
    nodes = "".join(f"{100 + i} 0 obj<</Type/Pages/Kids[{101 + i} 0 R]/Count 1>>endobj\n" for i in range(n - 1)) + f"{99 + n} 0 obj<</Type/Pages/Kids[10 0 R]/Count 1>>endobj\n"
    marks = "".join(f"{1000 + i} 0 obj<</Title(M{i})/Dest[10 0 R/Fit]/Next {1001 + i} 0 R>>endobj\n" for i in range(6000))
    content = S.pdf([S.line("Deep", 72, 700)], catalog="/Outlines 6 0 R", extra=(nodes + "6 0 obj<</First 1000 0 R>>endobj\n" + marks).encode()).replace(b"/Kids[10 0 R]/Count 1>>endobj\n5 0 obj", b"/Kids[100 0 R]/Count 1>>endobj\n5 0 obj")
    body = shown(drafted("pdf", content, "t.pdf"))["t.pdf"].body
    assert body.endswith("Deep") and body.count("# M") == 6000


def test_encryption_is_read_from_the_trailer(shown):
    plain = S.pdf([S.line("The word /Encrypt is text", 72, 700)])
    out = shown(drafted("pdf", plain, "p.pdf"), drafted("pdf", S.LOCKED_PDF, "l.pdf"))
    assert "/Encrypt is text" in out["p.pdf"].body and "encrypted=1" in out["l.pdf"].body


def test_cell_text_leaves_watermarks_out():
    words = [pdf.Block(10, 10, 20, 20, "a"), pdf.Block(22, 11, 30, 21, "b"), pdf.Block(10, 30, 20, 40, "c"), pdf.Block(10, 5, 90, 95, "MARK"), pdf.Block(95, 10, 130, 20, "outside")]
    assert pdf.cell_text(words, (0, 0, 100, 100)) == "a b\nc"


def test_failures_are_drafts(shown):
    out = shown(drafted("pdf", b"%PDF nothing", "s/a.pdf"), drafted("docx", b"PK\3\4" + bytes(200), "b.docx"))
    assert all(r.error for r in out.values()) and "见 original-doc/s/a.pdf" in out["s/a.pdf"].body

    def odd(content, draft):
        raise KeyError("odd")

    register("odd", odd)
    assert drafted("odd", b"").error == "KeyError: 'odd'"


def test_markdown_follows_local_pictures():
    md = drafted("md", b"text\n# T\n![a](img/p.png) ![b](http://x/y.png)", "d/a.md")
    assert md.titles == [("T", False)] and md.beside == [("d/img/p.png", "01_p.png")]
    assert follow_pictures("![a](img/p.png) ![c](no.png)", {"d/img/p.png": "01_p.png"}, "doc-x", "d") == "![a](../../original-doc/doc-x_assets/01_p.png)\n\n<!-- ocr:img:01_p.png --> ![c](no.png)"
    assert sniff_encoding("é中".encode() * 30000) == "utf-8" and sniff_encoding(b"a\0b") is None


def test_vector_pictures(tmp_path):
    emf = b"\1\0\0\0" + bytes(36) + b" EMF"
    assert vector.kind(emf, "png") == "emf" and vector.kind(b"\xd7\xcd\xc6\x9a", "") == "wmf" and vector.kind(b"<svg/>", "") == "svg" and vector.kind(b"\x89PNG", "png") is None
    assert vector.render(emf, "emf", programs=(("no-such-program", "{src}"),)) is None
    tool = tmp_path / "draw"
    clear = pdf.struct.pack(">IIBBBBB", 1, 1, 8, 6, 0, 0, 0)
    chunk = lambda k, b: pdf.struct.pack(">I", len(b)) + k + b + pdf.struct.pack(">I", zlib.crc32(k + b))
    rgba = vector.PNG + chunk(b"IHDR", clear) + chunk(b"IDAT", zlib.compress(b"\0\xff\0\0\x80")) + chunk(b"IEND", b"")
    (tmp_path / "made.png").write_bytes(rgba)
    tool.write_text(f"#!/bin/sh\ncp {tmp_path}/made.png $2\n")
    tool.chmod(0o755)
    out = vector.render(emf, "emf", programs=((str(tool), "{src}", "{dest}"),))
    assert zlib.decompress(dict(vector._chunks(out))[b"IDAT"]) == b"\0\xff\x7f\x7f"
    assert vector.on_white(b"junk") == b"junk"
    stored = base.Draft(base.Source("a.docx", render=lambda blob, ext: b"PNG" if ext == "emf" else None))
    assert stored.store(emf, "emf") == "01_vec.png" and stored.store(b"x", "gif") == "02_img.gif"
