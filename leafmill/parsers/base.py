"""What parsers take and give. A parser knows formats only: it turns bytes into a draft, a list of blocks as data (text, cells of tables, pictures,
work that is left). How blocks become Markdown, which title is taken and what class a picture has is decided by the plan (plans/render.py), in Column
expressions over all documents."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, fields

#: A block in Spark's terms; the fields of Block.
BLOCK = "struct<kind:string,text:string,prefix:string,prompt:boolean,part:string,rows:array<array<string>>,dest:string,type:string,count:bigint,note:string,loc:string,cls:string,unit:string>"
ASSET = "struct<dest:string,kind:string,ext:string,blob:binary>"
TITLE = "struct<text:string,prompt:boolean>"


@dataclass
class Block:
    """One block. kind:

    text     prefix and text as they are
    slide    prefix, and the text behind a colon where there is one
    head     prefix and text, only if another block of the same part is left
    table    rows of cells
    picture  text is the label; dest the stored name; the item fields say what is left to do if it is not stored
    scan     dest is the picture of a whole page
    work     the item fields: type, count, note, loc, cls, unit

    prompt: the block is left out where its text is nothing but the prompt of an empty field.
    """

    kind: str
    text: str | None = None
    prefix: str = ""
    prompt: bool = False
    part: str | None = None
    rows: list[list[str]] | None = None
    dest: str | None = None
    type: str | None = None
    count: int | None = None
    note: str | None = None
    loc: str | None = None
    cls: str | None = None
    unit: str | None = None


@dataclass
class Asset:
    dest: str
    kind: str
    ext: str
    blob: bytes


@dataclass
class Source:
    """Path, key and detected properties of a document. render turns a vector picture into PNG bytes or gives None."""

    relpath: str
    doc_id: str = "doc"
    encoding: str | None = None
    lang: str | None = None
    render: Callable[[bytes, str], bytes | None] | None = None

    @property
    def name(self) -> str:
        return self.relpath.rsplit("/", 1)[-1]

    @property
    def stem(self) -> str:
        head, dot, _ = self.name.rpartition(".")
        return head if dot and head.strip(".") else self.name


@dataclass
class Draft:
    """A document under way. titles: candidates in order; the first that is fit is taken, else the stem. title_in_body: a title has to stand in the body."""

    source: Source
    titles: list[tuple[str | None, bool]] = field(default_factory=list)
    title_in_body: bool = False
    blocks: list[Block] = field(default_factory=list)
    assets: list[Asset] = field(default_factory=list)
    #: Files beside this one that its text refers to: path, name to store it under.
    beside: list[tuple[str, str]] = field(default_factory=list)
    #: The body of a document without any block.
    if_empty: str = ""
    error: str | None = None

    def say(self, text: str | None, prefix: str = "", prompt: bool = False, part: str | None = None, kind: str = "text") -> None:
        self.blocks.append(Block(kind, text, prefix, prompt, part))

    def table(self, rows: list[list[str]]) -> None:
        if rows:
            self.blocks.append(Block("table", rows=rows))

    def leave(self, type_: str, count: int = 1, note: str = "", loc: str | None = None, cls: str | None = None, unit: str | None = None) -> None:
        """Work for a later stage, in this place of the text."""
        self.blocks.append(Block("work", type=type_, count=count, note=note, loc=loc, cls=cls, unit=unit))

    def store(self, blob: bytes, ext: str, kind: str = "img") -> str:
        """Keep a picture; gives its name, NN_kind.ext. A vector picture that can be rendered is kept as PNG."""
        ext = (ext or "png").lstrip(".").lower()
        if kind == "img" and self.source.render and (png := self.source.render(blob, ext)):
            blob, ext, kind = png, "png", "vec"
        self.assets.append(Asset(f"{len(self.assets) + 1:02d}_{kind}.{ext}", "scan" if kind == "scan" else "img", ext, blob))
        return self.assets[-1].dest

    def picture(self, blob: bytes, ext: str, label: str, lost: str) -> None:
        self.blocks.append(Block("picture", label, dest=self.store(blob, ext), type="image-ocr", count=1, note=lost))

    def row(self) -> dict:
        """As a row of the parsed table."""
        plain = lambda x: {f.name: getattr(x, f.name) for f in fields(x)}
        return {
            "relpath": self.source.relpath,
            "titles": [{"text": t, "prompt": p} for t, p in self.titles],
            "title_in_body": self.title_in_body,
            "blocks": [plain(b) for b in self.blocks],
            "assets": [plain(a) for a in self.assets],
            "if_empty": self.if_empty,
            "error": self.error,
        }


PARSED = f"relpath string, titles array<{TITLE}>, title_in_body boolean, blocks array<{BLOCK}>, assets array<{ASSET}>, if_empty string, error string"
