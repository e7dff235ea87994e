import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leafmill.functions import text as T

BREAKS = ["\n", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x85", " "]


def column(spark, values, f, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(f(F.col("v"))).collect()]


def test_clean_text(spark):
    got = column(spark, ["a  \nb　\n\n\n\nc\n", "", None, "\n\n x\t\n", "a\x0b\nb"], T.clean_text)
    assert got == ["a\nb\n\nc", "", None, " x", "a\nb"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=["a", " ", "\n", "\t", "　", "\x1c", "#", "`"], max_size=30), min_size=20, max_size=20))
def test_clean_text_property(spark, texts):
    def plain(t):
        out = "\n".join(x.rstrip() for x in t.split("\n"))
        return re.sub(r"\n{3,}", "\n\n", out).strip("\n")

    assert column(spark, texts, T.clean_text) == [plain(t) for t in texts]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "bc", " ", *BREAKS]), max_size=12).map("".join), min_size=10, max_size=10))
def test_lines_property(spark, texts):
    got = column(spark, texts, T.lines)
    assert [x if t else [] for x, t in zip(got, texts)] == [t.splitlines() for t in texts]


def test_strip_boilerplate(spark):
    got = column(spark, ["a\n第 3 页/共 9 页\nb\nPage 4\n- 5 -\n42\npage 4 of things", None], T.strip_boilerplate)
    assert got == ["a\nb\n42\npage 4 of things", None]


def test_summary(spark):
    texts = ["# h\n\n- a\n- b\n\n```\ncode\n\nmore\n```\n\nReal  text\nhere.\n\nnext", "x" * 250, "", None, "> q\n| a |\n<!-- c -->", "```\nnever closed\n\ntext"]
    assert column(spark, texts, T.summary) == ["Real text here.", "x" * 200 + "…", "", "", "", ""]


def test_sections_and_contents(spark):
    body = "# A\n```\n# no\n```\n" + "".join(f"## Part {i % 2}\n" for i in range(6)) + "####### seven"
    found = column(spark, [body], T.sections)[0]
    assert [(s.level, s.title) for s in found] == [(1, "A")] + [(2, f"Part {i % 2}") for i in range(6)]
    toc = column(spark, [body], lambda c: T.table_of_contents(T.sections(c)))[0]
    assert "- [Part 0](#part-0)\n- [Part 1](#part-1)\n- [Part 0](#part-0-1)" in toc
    assert column(spark, ["# only one"], lambda c: T.table_of_contents(T.sections(c))) == [""]


def test_slug(spark):
    assert column(spark, ["Hello, World!", "中文 标题", "a-b", "!!!", "É x"], T.slug) == ["hello-world", "中文-标题", "a-b", "section", "é-x"]


def test_titles(spark):
    assert column(spark, ["XXX", "Report XXX-2024", None, " Untitled ", "演示文稿"], T.is_generic_title) == [True, False, True, True, True]
    assert column(spark, ["Click to add title", "Click here to add a note", "Title 1", ""], T.is_placeholder) == [True, False, True, True]
    got = column(spark, ["My Title", "Other"], lambda c: T.pick_title([c], F.lit("stem"), F.lit("... my, title ...")))
    assert got == ["My Title", "stem"]


def test_formats(spark):
    assert column(spark, ["a/b.PY", "Makefile", ".bashrc", "x.tar.gz", "noext"], T.extension) == [".py", "", "", ".gz", ""]
    assert column(spark, ["a/CMakeLists.txt", "x.md"], T.code_language) == ["cmake", None]
    assert column(spark, ["# a\n\n- b", "plain", "x = 1;\ny = 2;\nreturn z;"], lambda c: T.sniff_format(F.lit("f"), c)) == ["md", "txt", "code"]


def test_table(spark):
    frame = spark.createDataFrame([([["a|b", "c\nd"], ["e"]],), ([],), ([["h"]],)], "v array<array<string>>")
    assert sorted(r[0] for r in frame.select(T.markdown_table(F.col("v"))).collect()) == sorted(["| a\\|b | c d |\n|---|---|\n| e |  |", "", "| h |\n|---|"])


def test_column_number(spark):
    assert column(spark, ["A", "Z", "AA", "AZ"], T.column_number) == [1, 26, 27, 52]


def test_rules_are_said_twice_alike():
    """The fixed values of the Column expressions are those that the SQL is written with."""
    from leafmill.functions import text as T
    from leafmill.operators import defer
    from leafmill.plans import expected as E

    for name in ("CODE_EXTENSIONS", "CODE_STEMS", "PAGE_LINE_LENGTH", "SUMMARY_LENGTH", "MAX_SECTIONS", "TOC_SHOWN", "TOC_FROM", "SNIFFED_LINES"):
        assert getattr(T, name) == getattr(E, name), name
    assert sorted(T.GENERIC_TITLES) == sorted(E.GENERIC_TITLES) and sorted(defer.TYPES) == sorted(E.TYPES)
