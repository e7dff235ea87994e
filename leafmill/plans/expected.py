"""What the rules are, said once more for the SQL that queries are compared with: literal patterns in the syntax of RE2, which share nothing with the
Column expressions. A change to one side alone shows as a difference."""

# White space, with and without the line feed, and line ends.
WS = r"\t\x0b\x0c\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WSN = WS + r"\n"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
# Limits.
PAGE_LINE_LENGTH, SUMMARY_LENGTH, MAX_SECTIONS, TOC_SHOWN, TOC_FROM, SNIFFED_LINES, TEXT_LENGTH = 24, 200, 500, 30, 6, 200, 4000
# Lines that hold a page number; headings; list items; rules of tables.
PAGE_LINE = "(?i)^[" + WSN + "]*(?:第[" + WSN + "]*[0123456789零一二三四五六七八九十百]+[" + WSN + "]*页([/／][" + WSN + "]*共[" + WSN + "]*[0123456789]+[" + WSN + r"]*页)?|page[" + WSN + r"]*\p{Nd}+|-[" + WSN + r"]*\p{Nd}+[" + WSN + "]*-)[" + WSN + "]*$"
HEADING = r"(?s)^[" + WS + "]{0,3}(#{1,6})[" + WS + "]+(.+?)[" + WS + "]*$"
LIST_LINE = "^[" + WSN + "]*(?:[*+-][" + WSN + r"]|\p{Nd}+\.[" + WSN + "])"
TABLE_RULE = r"^\|?[" + WS + "]*:?--+:?[" + WS + r"]*(\|[" + WS + "]*:?--+:?[" + WS + r"]*)*\|?$"
# Signs of Markdown and of program text in a line.
MARKDOWN_SIGNS = [
    "^[" + WS + "]{0,3}#{1,6}[" + WS + "]+[^" + WSN + "]", "^[" + WS + "]{0,3}[*+-][" + WS + "]+[^" + WSN + "]", "^[" + WS + r"]{0,3}\p{Nd}+\.[" + WS + "]+[^" + WSN + "]",
    "[`][`][`]", r"!\[[^\]]*\]\(", r"\[[^\]]+\]\([^)]+\)", r"^\|.*\|[" + WS + "]*$", "^[" + WS + "]{0,3}>[" + WS + "]+[^" + WSN + "]",
]
_NOT_WORD = r"(?:[^\p{L}\p{N}_]|$)"
CODE_SIGNS = [
    "^[" + WS + "]*(?:class|const|def|elif|else|endforeach|endfunction|endif|enum|fn|for|from|func|function|if|import|include|let|namespace|package|private|public|return|struct|using|val|var|while)" + _NOT_WORD,
    "^[" + WS + "]*#include" + _NOT_WORD, "^[" + WS + "]*cmake_minimum_required" + _NOT_WORD, "^[" + WS + r"]*[\p{L}\p{N}_.]+[" + WS + r"]*\(.*\)[" + WS + "]*$", ";[" + WS + "]*$", "^[" + WS + "]*[{}][" + WS + "]*$",
]
# Languages of program text by extension, and by stem.
CODE_EXTENSIONS = {f".{e}": lang for lang, es in {
    "bash": "sh bash zsh", "c": "c h", "clojure": "clj", "cmake": "cmake", "cpp": "cpp cc cxx hpp", "csharp": "cs", "go": "go", "ini": "ini cfg conf", "java": "java", "javascript": "js jsx", "json": "json", "kotlin": "kt", "lua": "lua", "objc": "m mm",
    "perl": "pl", "php": "php", "python": "py", "r": "r", "ruby": "rb", "rust": "rs", "scala": "scala", "sql": "sql", "swift": "swift", "toml": "toml", "typescript": "ts tsx", "vb": "vb", "xml": "xml", "yaml": "yaml yml",
}.items() for e in es.split()}
CODE_STEMS = {"brewfile": "ruby", "cmakelists": "cmake", "dockerfile": "docker", "gemfile": "ruby", "gnumakefile": "make", "makefile": "make", "podfile": "ruby", "rakefile": "ruby"}
# Titles that say nothing, prompts, and what does not count when titles are compared.
GENERIC_TITLES = ["", "doc", "document", "excel", "microsoft office powerpoint", "microsoft office word", "powerpoint", "powerpoint 演示文稿", "presentation", "untitled", "word", "新建文档", "新文档", "演示文稿"]
PLACEHOLDER = (
    "(?i)^(?:(?:单击此处添加|点击此处添加|单击添加|占位符)(?:标题|文本|内容|副标题|图片)?|click[" + WSN + "]+to[" + WSN + "]+(?:add|edit)[" + WSN + "]+(?:text|title|subtitle|content|picture|image)"
    "|placeholder[" + WSN + "]*text[" + WSN + r"]*\p{Nd}*|title[" + WSN + r"]*\p{Nd}*)$"
)
TITLE_NOISE = "[" + WSN + r"“”\"'\\\[\]（）()《》【】,，。.、:：;；-]"
# Markers of work that is left, and its types.
MARKER = r"<!-- stage2:([\p{L}\p{N}_-]+)=(\p{Nd}+)((?:[" + WSN + r"]+[\p{L}\p{N}_]+=[\p{L}\p{N}_-]+)*)(?:[" + WSN + r"]+(.*?))? -->"
TYPES = ["chart", "encrypted", "formula", "formula-cell", "image-ocr", "inline-image", "parse-failed", "scan-page", "truncated", "unsupported"]
# Files and folders of the search for an input directory.
DOCUMENT_EXTENSIONS = [".c", ".cmake", ".doc", ".docx", ".h", ".jpeg", ".jpg", ".md", ".pdf", ".png", ".ppt", ".pptx", ".py", ".sh", ".txt", ".xls", ".xlsx", ".yaml", ".yml"]
EXCLUDED_DIRECTORIES = [".git", ".venv", "__pycache__", "build", "dist", "knowledge", "node_modules", "out", "output", "venv"]
