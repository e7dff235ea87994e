"""Plain and program text, Markdown, and pictures on their own."""

from __future__ import annotations

import codecs
import re

from .base import Block, Draft

ENCODINGS = ("utf-8", "gbk", "gb18030", "latin-1")
SAMPLE, ZERO_SAMPLE = 65536, 8192
_IMAGE = re.compile(r"!\[([^\]]*)\]\(([^)\s]+)\)")


def sniff_encoding(content: bytes) -> str | None:
    """First encoding that decodes the sample, a character cut at its end aside; null for binary content."""
    if b"\0" in content[:ZERO_SAMPLE]:
        return None
    for name in ENCODINGS:
        try:
            codecs.getincrementaldecoder(name)("strict").decode(content[:SAMPLE], False)
        except UnicodeDecodeError:
            continue
        return name
    return ENCODINGS[-1]


def decode(content: bytes, draft: Draft) -> str:
    return content.decode(draft.source.encoding or sniff_encoding(content) or "latin-1", "replace")


def parse_text(content: bytes, draft: Draft) -> None:
    text, lang = decode(content, draft), draft.source.lang
    draft.say(text if lang in (None, "text", "plain") else f"```{lang}\n{text.rstrip()}\n```")


def _beside(folder: str, ref: str) -> str:
    """Path of what a text in `folder` refers to."""
    parts: list[str] = []
    for p in (f"{folder}/{ref}" if folder else ref).split("/"):
        if p == "..":
            parts = parts[:-1]
        elif p not in ("", "."):
            parts.append(p)
    return "/".join(parts)


def parse_markdown(content: bytes, draft: Draft) -> None:
    """As it is. Local pictures are files beside the document: the plan joins them with the scan and rewrites the references that exist."""
    text = decode(content, draft)
    draft.titles.append((next((s[2:].strip() for x in text.split("\n") if (s := x.strip()).startswith("# ")), None), False))
    draft.say(text if text.endswith("\n") else text + "\n")
    folder = draft.source.relpath.rpartition("/")[0]
    for m in _IMAGE.finditer(text):
        ref = m.group(2)
        if "://" not in ref and not ref.startswith(("data:", "#")):
            draft.beside.append((_beside(folder, ref), f"{len(draft.beside) + 1:02d}_{ref.rsplit('/', 1)[-1]}"))


def follow_pictures(text: str, known: dict[str, str], doc_id: str, folder: str) -> str:
    """References to pictures that exist (known: path -> stored name) rewritten, each with a placeholder."""

    def one(m: re.Match) -> str:
        dest = known.get(_beside(folder, m.group(2)))
        return m.group() if dest is None else f"![{m.group(1)}](../../original-doc/{doc_id}_assets/{dest})\n\n<!-- ocr:img:{dest} -->"

    return _IMAGE.sub(one, text)


def parse_image(content: bytes, draft: Draft) -> None:
    """The picture itself stays an original; its stored copy is what recognition reads."""
    draft.say(f"![{draft.source.stem}](../../original-doc/{draft.source.relpath})")
    dest = draft.store(content, draft.source.name.rpartition(".")[2] or "png")
    draft.blocks.append(Block("scan", prefix="img", dest=dest, type="image-ocr", count=1, note="无引擎或纯图无文字"))
