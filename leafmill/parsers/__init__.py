"""Format parsers: bytes to a draft. register() adds or replaces one."""

from __future__ import annotations

from collections.abc import Callable

from .base import Draft, Source
from .office import parse_docx, parse_pptx, parse_xlsx
from .pdf import parse_pdf
from .plain import parse_image, parse_markdown, parse_text

Parser = Callable[[bytes, Draft], None]
_PARSERS: dict[str, Parser] = {"text": parse_text, "md": parse_markdown, "image": parse_image, "docx": parse_docx, "pptx": parse_pptx, "xlsx": parse_xlsx, "pdf": parse_pdf}


def register(handler: str, parser: Parser) -> None:
    _PARSERS[handler] = parser


def get(handler: str) -> Parser:
    return _PARSERS[handler]


def failed(source: Source, why: BaseException) -> Draft:
    """The draft of a document that could not be parsed: work for a later stage, and the error."""
    draft = Draft(source, error=f"{type(why).__name__}: {why}")
    draft.leave("parse-failed", 1, f"{why}; 见 original-doc/{source.relpath}")
    return draft


def parse(handler: str, content: bytes, source: Source) -> Draft:
    """Never raises: a failure becomes a draft of its own."""
    draft = Draft(source)
    try:
        get(handler)(content, draft)
    except Exception as ex:  # noqa: BLE001
        return failed(source, ex)
    return draft
