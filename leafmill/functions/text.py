"""Text functions as Column expressions: everything stays in the JVM, nothing is shuffled.

White space and line ends are spelt out, because Java, RE2 and Python disagree on them: WS is every white-space character of Unicode and the
separators U+001C..U+001F, without the line feed; LINE_END is everything that ends a line for a text tool.
Null texts give null (or the stated neutral value); empty ones are ordinary.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes.
WS = r"\t\x0b\x0c\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WSN = WS + r"\n"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
# Page numbers, headings, list lines.
#: A line that holds nothing but a page number; only counts below PAGE_LINE_LENGTH characters.
PAGE_LINE = rf"(?i)\A[{WSN}]*(?:第[{WSN}]*[0-9零一二三四五六七八九十百]+[{WSN}]*页(?:[/／][{WSN}]*共[{WSN}]*[0-9]+[{WSN}]*页)?|page[{WSN}]*\p{{Nd}}+|-[{WSN}]*\p{{Nd}}+[{WSN}]*-)[{WSN}]*\z"
PAGE_LINE_LENGTH = 24
HEADING = rf"(?s)\A[{WS}]{{0,3}}(#{{1,6}})[{WS}]+(.+?)[{WS}]*\z"
LIST_LINE = rf"\A[{WSN}]*(?:[-*+][{WSN}]|\p{{Nd}}+\.[{WSN}])"
SUMMARY_LENGTH, MAX_SECTIONS, TOC_SHOWN, TOC_FROM = 200, 500, 30, 6
TABLE_RULE = rf"\A\|?[{WS}]*:?-{{2,}}:?[{WS}]*(?:\|[{WS}]*:?-{{2,}}:?[{WS}]*)*\|?\z"
# Signs of Markdown and of program text, one line at a time.
MARKDOWN_SIGNS = [
    rf"\A[{WS}]{{0,3}}#{{1,6}}[{WS}]+[^{WSN}]",
    rf"\A[{WS}]{{0,3}}[-*+][{WS}]+[^{WSN}]",
    rf"\A[{WS}]{{0,3}}\p{{Nd}}+\.[{WS}]+[^{WSN}]",
    "```",
    r"!\[[^\]]*\]\(",
    r"\[[^\]]+\]\([^)]+\)",
    rf"\A\|.*\|[{WS}]*\z",
    rf"\A[{WS}]{{0,3}}>[{WS}]+[^{WSN}]",
]
CODE_WORDS = "if|for|while|return|else|elif|endif|endforeach|function|endfunction|def|class|func|fn|import|from|package|include|using|namespace|public|private|var|let|const|val|struct|enum"
_NOT_WORD = r"(?:[^\p{L}\p{N}_]|\z)"
CODE_SIGNS = [
    rf"\A[{WS}]*(?:{CODE_WORDS}){_NOT_WORD}",
    rf"\A[{WS}]*#include{_NOT_WORD}",
    rf"\A[{WS}]*cmake_minimum_required{_NOT_WORD}",
    rf"\A[{WS}]*[\p{{L}}\p{{N}}_.]+[{WS}]*\(.*\)[{WS}]*\z",
    rf";[{WS}]*\z",
    rf"\A[{WS}]*[{{}}][{WS}]*\z",
]
SNIFFED_LINES = 200
CODE_EXTENSIONS = {
    ".c": "c", ".h": "c", ".cpp": "cpp", ".cc": "cpp", ".cxx": "cpp", ".hpp": "cpp", ".py": "python", ".sh": "bash", ".bash": "bash", ".zsh": "bash",
    ".cmake": "cmake", ".java": "java", ".go": "go", ".rs": "rust", ".js": "javascript", ".ts": "typescript", ".jsx": "javascript", ".tsx": "typescript",
    ".json": "json", ".xml": "xml", ".yaml": "yaml", ".yml": "yaml", ".ini": "ini", ".cfg": "ini", ".conf": "ini", ".toml": "toml", ".sql": "sql",
    ".rb": "ruby", ".php": "php", ".kt": "kotlin", ".swift": "swift", ".scala": "scala", ".clj": "clojure", ".lua": "lua", ".pl": "perl", ".r": "r",
    ".m": "objc", ".mm": "objc", ".cs": "csharp", ".vb": "vb",
}
CODE_STEMS = {"cmakelists": "cmake", "makefile": "make", "gnumakefile": "make", "dockerfile": "docker", "rakefile": "ruby", "gemfile": "ruby", "brewfile": "ruby", "podfile": "ruby"}
MARKDOWN_EXTENSIONS = (".md", ".markdown", ".mdown", ".markdn")
# Titles that say nothing, prompts of empty fields, signs that do not count when titles are compared.
GENERIC_TITLES = ("", "powerpoint 演示文稿", "演示文稿", "microsoft office powerpoint", "presentation", "document", "microsoft office word", "doc", "untitled", "powerpoint", "word", "excel", "新文档", "新建文档")
PLACEHOLDER = (
    rf"(?i)\A(?:(?:单击此处添加|点击此处添加|单击添加|占位符)(?:标题|文本|内容|副标题|图片)?"
    rf"|click[{WSN}]+to[{WSN}]+(?:add|edit)[{WSN}]+(?:text|title|subtitle|content|picture|image)|placeholder[{WSN}]*text[{WSN}]*\p{{Nd}}*|title[{WSN}]*\p{{Nd}}*)\z"
)
TITLE_NOISE = rf"[{WSN}“”\"'\\\[\]（）()《》【】,，。.、:：;；-]"


def _sub(c: Column, pattern: str, to: str) -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(to))


def let(value: Column, f) -> Column:
    """f(value) with the value worked out once, however often f uses it: an expression named in several places is evaluated in each."""
    return F.element_at(F.transform(F.array(value), f), 1)


def strip(c: Column) -> Column:
    return _sub(c, rf"\A[{WSN}]+|[{WSN}]+\z", "")


def lines(c: Column) -> Column:
    """Lines as a text tool sees them; a final line end opens no further line."""
    return let(F.split(c, LINE_END, -1), lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, F.lit(1), F.size(p) - 1)).otherwise(p))


def clean_text(c: Column) -> Column:
    """No white space before line ends, one blank line at most in a row, no line feeds around the text."""
    trimmed = _sub(c, rf"[{WS}]+(\n|\z)", "$1")
    return _sub(_sub(trimmed, r"\n{3,}", "\n\n"), r"\A\n+|\n+\z", "")


def strip_boilerplate(c: Column) -> Column:
    """Lines without those that hold only a page number."""

    def keep(x: Column) -> Column:
        # a long line cannot be one by its length alone, and needs no pattern
        return ~((F.length(x) < 10 * PAGE_LINE_LENGTH) & x.rlike(PAGE_LINE) & (F.length(strip(x)) < PAGE_LINE_LENGTH))

    return F.array_join(F.filter(lines(c), keep), "\n")


def is_fence(line: Column) -> Column:
    return line.rlike(rf"\A[{WSN}]*(?:```|~~~)")


def summary(c: Column, length: int = SUMMARY_LENGTH) -> Column:
    """First paragraph that is prose: outside fences, no heading, image, comment, quote or table line, not only list items."""
    one = lambda f, p, n, k, o: F.struct(f.alias("fence"), p.alias("para"), n.alias("n"), k.alias("items"), o.alias("out"))
    zero, none, blank = F.lit(0), F.lit(None).cast("string"), F.lit("")

    def emitted(a: Column) -> Column:
        flat = let(_sub(a["para"], rf"[{WSN}]+", " "), lambda f: F.when(F.length(f) > length, F.concat(F.substring(f, 1, length), F.lit("…"))).when(f != "", f))
        return F.when((a["n"] > 0) & (a["items"] < a["n"]), flat)

    def with_line(a: Column, s: Column) -> Column:
        fence = s.rlike(r"\A(?:```|~~~)")
        closes = fence | (s == "") | s.rlike(r"\A(?:#|!\[|<!--|>|\|)")
        broken = one(F.when(fence, ~a["fence"]).otherwise(a["fence"]), blank, zero, zero, emitted(a))
        joined = F.when(a["n"] > 0, F.concat(a["para"], F.lit(" "), s)).otherwise(s)
        longer = one(a["fence"], joined, a["n"] + 1, a["items"] + s.rlike(LIST_LINE).cast("int"), none)
        return F.when(a["fence"] & ~fence, a).when(closes, broken).otherwise(longer)

    def step(a: Column, x: Column) -> Column:
        return F.when(a["out"].isNotNull(), a).otherwise(let(strip(x), lambda s: with_line(a, s)))

    start = one(F.lit(False), blank, zero, zero, none)
    return F.aggregate(lines(F.coalesce(c, F.lit(""))), start, step, lambda a: F.coalesce(a["out"], emitted(a), F.lit("")))


def sections(c: Column, most: int = MAX_SECTIONS) -> Column:
    """array<struct<level int, title string>> of the headings outside fences, in order."""
    start = F.struct(F.lit(False).alias("fence"), F.array().cast("array<struct<level:int,title:string>>").alias("found"))

    def step(a: Column, x: Column) -> Column:
        head = F.struct(F.length(F.regexp_extract(x, HEADING, 1)).cast("int").alias("level"), F.regexp_extract(x, HEADING, 2).alias("title"))
        more = F.when(~a["fence"] & F.contains(x, F.lit("#")) & x.rlike(HEADING) & (F.size(a["found"]) < most), F.struct(a["fence"].alias("fence"), F.concat(a["found"], F.array(head)).alias("found"))).otherwise(a)
        return F.when(is_fence(x), F.struct((~a["fence"]).alias("fence"), a["found"].alias("found"))).otherwise(more)

    return F.aggregate(lines(F.coalesce(c, F.lit(""))), start, step, lambda a: a["found"])


def first_titles(c: Column, n: int = 10) -> Column:
    """Titles of the first n headings."""
    return F.transform(sections(c, n), lambda s: s["title"])


def slug(title: Column) -> Column:
    """Anchor of a heading: punctuation gone, white space as hyphens, small letters; never empty."""
    s = _sub(strip(_sub(title, rf"[^\p{{L}}\p{{N}}_{WSN}-]", "")), rf"[{WSN}]+", "-")
    return F.when(F.lower(s) == "", F.lit("section")).otherwise(F.lower(s))


def slugs(titles: Column) -> Column:
    """Anchors of all headings; the second of equal ones gets -1, the third -2. Quadratic in the array: for what a table of contents shows."""
    before = lambda bases, b, i: F.size(F.filter(F.slice(bases, F.lit(1), i), lambda y: y == b))
    numbered = lambda bases: F.transform(bases, lambda b, i: let(before(bases, b, i), lambda n: F.when(n > 0, F.concat(b, F.lit("-"), n.cast("string"))).otherwise(b)))
    return let(F.transform(titles, slug), numbered)


def table_of_contents(found: Column, shown: int = TOC_SHOWN) -> Column:
    """Rendered contents for at least TOC_FROM sections, else an empty string."""
    titles = F.slice(F.transform(found, lambda s: s["title"]), 1, shown)
    rows = F.zip_with(titles, slugs(titles), lambda t, s: F.concat(F.lit("- ["), t, F.lit("](#"), s, F.lit(")")))
    return F.when(F.size(found) >= TOC_FROM, F.concat(F.lit("## 目录\n\n"), F.array_join(rows, "\n"), F.lit("\n\n"))).otherwise(F.lit(""))


def table_summary(c: Column) -> Column:
    """Stand-in summary of a text of tables: data rows are pipe lines less a rule and a header for each table."""
    rows = F.filter(F.split(c, "\n", -1), lambda x: x.rlike(rf"\A[{WSN}]*\|"))
    rules = F.size(F.filter(rows, lambda x: strip(x).rlike(TABLE_RULE)))
    n = F.greatest(F.lit(0), F.size(rows) - 2 * rules)
    return F.when(F.size(rows) > 0, F.concat(F.lit("（表格文档：约 "), n.cast("string"), F.lit(" 行数据，详见正文表格）"))).otherwise(F.lit(""))


def _hits(rows: Column, signs: list[str]) -> Column:
    pattern = "(?s)" + "|".join(f"(?:{p})" for p in signs)
    return F.size(F.filter(rows, lambda x: x.rlike(pattern)))


def _sniffed(c: Column) -> Column:
    return F.slice(lines(c), 1, SNIFFED_LINES)


def looks_like_markdown(c: Column) -> Column:
    return _hits(_sniffed(c), MARKDOWN_SIGNS) >= 2


def looks_like_code(c: Column) -> Column:
    return let(_sniffed(c), lambda r: (_hits(r, CODE_SIGNS) >= 3) & ~(_hits(r, MARKDOWN_SIGNS) >= 2))


def guess_language(c: Column) -> Column:
    """Language of program text by content; line anchors hold at the start of the text only."""
    w, b, e = r"[\p{L}\p{N}_]", r"(?:\A|[^\p{L}\p{N}_])", _NOT_WORD
    return (
        F.when(c.contains("cmake_minimum_required") | c.rlike(rf"{b}add_executable{e}"), "cmake")
        .when(c.rlike(rf"\A[{WSN}]*def[{WSN}]+{w}") | c.rlike(rf"{b}import[{WSN}]+{w}"), "python")
        .when(c.rlike(rf"\A[{WSN}]*#include{e}"), "c")
        .when(c.rlike(rf"{b}fn[{WSN}]+{w}") | c.rlike(rf"{b}let[{WSN}]+mut{e}"), "rust")
        .when(c.rlike(rf"{b}func[{WSN}]+{w}"), "go")
        .otherwise("text")
    )


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)\z", 1)


def extension(path: Column) -> Column:
    """Lower-case extension with its dot; a name that begins with its only dot has none."""
    return F.lower(F.regexp_extract(base_name(path), r"(?s)\A\.*[^.].*?(\.[^.]*)\z", 1))


def stem(path: Column) -> Column:
    name = base_name(path)
    return F.when(extension(path) == "", name).otherwise(F.substring(name, F.lit(1), F.length(name) - F.length(extension(path))))


def _lookup(c: Column, table: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c)


def code_language(path: Column) -> Column:
    """Language by extension, else by the name's stem, else null."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in CODE_EXTENSIONS.items() for x in kv]), extension(path)), F.try_element_at(F.create_map(*[F.lit(x) for kv in CODE_STEMS.items() for x in kv]), F.lower(stem(path))))


def sniff_format(path: Column, sample: Column) -> Column:
    """code, md or txt: by extension or stem of program text, by content, by the extension of Markdown, else plain text."""
    by_text = let(_sniffed(sample), lambda r: let(_hits(r, MARKDOWN_SIGNS) >= 2, lambda md: F.when(md, "md").when(_hits(r, CODE_SIGNS) >= 3, "code")))
    return F.when(code_language(path).isNotNull(), "code").otherwise(F.coalesce(by_text, F.when(extension(path).isin(*MARKDOWN_EXTENSIONS), "md"), F.lit("txt")))


def is_generic_title(t: Column) -> Column:
    s = strip(F.coalesce(t, F.lit("")))
    return F.lower(s).isin(*GENERIC_TITLES) | s.rlike(r"\A[xX]{2,}\z")


def is_placeholder(t: Column) -> Column:
    s = strip(F.coalesce(t, F.lit("")))
    return (s == "") | s.rlike(PLACEHOLDER)


def match_form(c: Column) -> Column:
    """Without white space and punctuation, small letters: what titles and bodies are compared by."""
    return F.lower(_sub(F.coalesce(c, F.lit("")), TITLE_NOISE, ""))


def title_in_body(title: Column, body: Column) -> Column:
    """A title that is too short to tell counts as present."""
    t = match_form(title)
    return (F.length(t) < 2) | F.contains(match_form(body), t)


def pick_title(candidates: list[Column], fallback: Column, body: Column | None = None) -> Column:
    """First candidate that is no generic title (and stands in the body), stripped; else the fallback."""
    out = []
    for c in candidates:
        ok = ~is_generic_title(c)
        out.append(F.when(ok if body is None else ok & title_in_body(strip(c), body), strip(c)))
    return F.coalesce(*out, fallback)


def table_cell(c: Column) -> Column:
    """A cell of a Markdown table: breaks as spaces, backslash and pipe escaped, stripped."""
    s = _sub(F.coalesce(c, F.lit("")), r"[\n\x0b\x0c\r]", " ")
    return strip(F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")))


def table_row(cells: Column, width: Column | int) -> Column:
    """One rendered row, padded or cut to the width."""
    n = F.lit(width) if isinstance(width, int) else width
    padded = F.slice(F.concat(F.transform(cells, table_cell), F.array_repeat(F.lit(""), n)), F.lit(1), n)
    return F.concat(F.lit("| "), F.array_join(padded, " | "), F.lit(" |"))


def markdown_table(rows: Column) -> Column:
    """array<array<string>> to a Markdown table whose first row is the header; an empty array gives an empty string."""
    width = F.array_max(F.transform(rows, F.size))
    rule = F.concat(F.lit("|"), F.array_join(F.array_repeat(F.lit("---"), width), "|"), F.lit("|"))
    body = F.transform(rows, lambda r: table_row(r, width))
    out = F.concat_ws("\n", F.element_at(body, 1), rule, F.array_join(F.slice(body, F.lit(2), F.size(body) - 1), "\n"))
    return F.when(F.coalesce(width, F.lit(0)) < 1, F.lit("")).otherwise(F.when(F.size(rows) == 1, F.concat_ws("\n", F.element_at(body, 1), rule)).otherwise(out))


def document_key(path: Column, digits: int = 8) -> Column:
    """Short name of a document: by its path, not its content. 32 bits may collide, so it is no key of a join, and the pipeline lengthens it where two paths share it."""
    return F.concat(F.lit("doc-"), F.substring(F.sha2(path, 256), 1, digits))


def column_number(letters: Column) -> Column:
    """A -> 1, Z -> 26, AA -> 27."""
    return F.aggregate(F.split(F.upper(letters), ""), F.lit(0), lambda a, x: F.when(x == "", a).otherwise(a * 26 + F.ascii(x) - 64))
