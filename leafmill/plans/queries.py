"""Registered queries over the driver's tables, and the SQL that gives the same rows.

Every query runs over whole tables, but for those of the parsers, which read the documents of samples.py. Derived inputs (picture signatures, page blocks, sheet cells) are written once as SQL that both
engines read alike; {name} stands for a table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leafmill.functions import text as T
from leafmill.operators import assets as A
from leafmill.operators import catalog as K
from leafmill.operators import classify as C
from leafmill.operators import defer as D
from leafmill.operators import geometry as G
from leafmill.operators import incremental as I
from leafmill.operators import sheets as S
from leafmill.plans import expected as E
from leafmill.plans import samples as SAMPLES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


class _Paths(dict):
    def __init__(self, sf: str | None):
        super().__init__()
        self.sf = sf

    def __missing__(self, name: str) -> str:
        return f"parquet.`{self.sf}/{name}.parquet`" if self.sf else name


def fixture(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    return spark.sql(sql.format_map(_Paths(sf)))


def duck(sql: str) -> str:
    return sql.format_map(_Paths(None))


def q(s: str) -> str:
    """A string literal for DuckDB."""
    return "'" + s.replace("'", "''") + "'"


# ------------------------------------------------------------------------------------------------------------ SQL of the text functions


def _strip(x: str) -> str:
    return f"regexp_replace({x}, {q(rf'\A[{E.WSN}]+|[{E.WSN}]+\z')}, '', 'g')"


def _lines(x: str) -> str:
    a = f"regexp_split_to_array({x}, {q(E.LINE_END)})"
    return f"(CASE WHEN ({a})[-1] = '' THEN ({a})[1:len({a}) - 1] ELSE {a} END)"


def _like(x: str, p: str) -> str:
    return f"regexp_matches({x}, {q(p)})"


def _clean(x: str) -> str:
    a = f"regexp_replace({x}, {q(rf'[{E.WS}]+(\n|\z)').replace(chr(10), chr(92) + 'n')}, '\\1', 'g')"
    return f"regexp_replace(regexp_replace({a}, '\\n{{3,}}', chr(10) || chr(10), 'g'), '\\A\\n+|\\n+\\z', '', 'g')"


def _boilerplate(x: str) -> str:
    return f"array_to_string(list_filter({_lines(x)}, lambda l: NOT ({_like(_strip('l'), E.PAGE_LINE)} AND length({_strip('l')}) < {E.PAGE_LINE_LENGTH})), chr(10))"


def _hits(x: str, signs: list[str]) -> str:
    p = "(?s)" + "|".join(f"(?:{s})" for s in signs)
    return f"len(list_filter(({_lines(x)})[1:{E.SNIFFED_LINES}], lambda l: {_like('l', p)}))"


_MD = lambda x: f"({_hits(x, E.MARKDOWN_SIGNS)} >= 2)"
_CODE = lambda x: f"({_hits(x, E.CODE_SIGNS)} >= 3 AND NOT {_MD(x)})"
_FENCE = rf"\A(?:```|~~~)"
_BASE = lambda x: f"regexp_extract({x}, '([^/]*)\\z', 1)"
_EXT = lambda x: f"lower(regexp_extract({_BASE(x)}, '(?s)\\A\\.*[^.].*?(\\.[^.]*)\\z', 1))"
_STEM = lambda x: f"(CASE WHEN {_EXT(x)} = '' THEN {_BASE(x)} ELSE substr({_BASE(x)}, 1, length({_BASE(x)}) - length({_EXT(x)})) END)"
_CASE = lambda x, t: f"(CASE {x} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in t.items()) + " END)"
_LANG = lambda x: f"coalesce({_CASE(_EXT(x), E.CODE_EXTENSIONS)}, {_CASE(f'lower({_STEM(x)})', E.CODE_STEMS)})"
_SLUG = lambda x: f"(CASE WHEN lower({(s := f'''regexp_replace({_strip(f'''regexp_replace({x}, {q(rf'[^\p{{L}}\p{{N}}_{E.WSN}-]')}, '', 'g')''')}, {q(rf'[{E.WSN}]+')}, '-', 'g')''')}) = '' THEN 'section' ELSE lower({s}) END)"
_LINED = f"""lines AS (SELECT doc_id, unnest(l) AS ln, generate_subscripts(l, 1) AS pos FROM (SELECT doc_id, {_lines('body')} AS l FROM md_corpus)),
marked AS (SELECT *, {_strip('ln')} AS s, {_like(_strip('ln'), _FENCE)} AS fence FROM lines),
walked AS (SELECT *, coalesce(sum(fence::int) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 = 1 AS inside FROM marked)"""


# ------------------------------------------------------------------------------------------------------------------- keys and texts


@query("SELECT doc_id, 'doc-' || substr(sha256(relpath), 1, 8) AS kb_id, sha256(body) AS content_sha FROM md_corpus")
def doc_ids(spark, sf):
    return table(spark, sf, "md_corpus").select("doc_id", T.document_key(F.col("relpath")).alias("kb_id"), F.sha2("body", 256).alias("content_sha"))


@query("SELECT kb_id, count(*) AS n FROM (SELECT 'doc-' || substr(sha256(relpath), 1, 4) AS kb_id FROM md_corpus) GROUP BY kb_id HAVING count(*) > 1")
def check_keys(spark, sf):
    """Keys that two paths share: 32 bits may collide; here 16, so that some do."""
    return table(spark, sf, "md_corpus").groupBy(T.document_key(F.col("relpath"), 4).alias("kb_id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query(f"SELECT doc_id, {_clean('body')} AS cleaned FROM md_corpus")
def clean_text(spark, sf):
    return table(spark, sf, "md_corpus").select("doc_id", T.clean_text(F.col("body")).alias("cleaned"))


@query(f"SELECT doc_id, {_boilerplate('body')} AS stripped FROM md_corpus")
def strip_boilerplate(spark, sf):
    return table(spark, sf, "md_corpus").select("doc_id", T.strip_boilerplate(F.col("body")).alias("stripped"))


@query(f"SELECT doc_id, {_boilerplate('c')} AS body FROM (SELECT doc_id, {_clean('body')} AS c FROM md_corpus)")
def normalised_body(spark, sf):
    return table(spark, sf, "md_corpus").select("doc_id", T.strip_boilerplate(T.clean_text(F.col("body"))).alias("body"))


_SUMMARY_SQL = f"""WITH {_LINED},
kinds AS (SELECT *, fence OR (NOT inside AND (s = '' OR {_like('s', r'\A(?:#|!\[|<!--|>|\|)')})) AS breaks FROM walked WHERE fence OR NOT inside),
islands AS (SELECT *, sum(breaks::int) OVER (PARTITION BY doc_id ORDER BY pos) AS part FROM kinds),
paras AS (SELECT doc_id, part, regexp_replace(string_agg(s, ' ' ORDER BY pos), {q(rf'[{E.WSN}]+')}, ' ', 'g') AS p, count(*) AS n, sum({_like('s', E.LIST_LINE)}::int) AS items FROM islands WHERE NOT breaks GROUP BY doc_id, part),
best AS (SELECT doc_id, arg_min(p, part) AS p FROM paras WHERE items < n AND p <> '' GROUP BY doc_id)
SELECT m.doc_id, CASE WHEN b.p IS NULL THEN '' WHEN length(b.p) > {E.SUMMARY_LENGTH} THEN substr(b.p, 1, {E.SUMMARY_LENGTH}) || '…' ELSE b.p END AS summary FROM md_corpus m LEFT JOIN best b USING (doc_id)"""


@query(_SUMMARY_SQL)
def summaries(spark, sf):
    return table(spark, sf, "md_corpus").select("doc_id", T.summary(F.col("body")).alias("summary"))


_SECTIONS_CTE = f"""{_LINED},
heads AS (SELECT doc_id, pos, length(regexp_extract(ln, {q(E.HEADING)}, 1)) AS level, regexp_extract(ln, {q(E.HEADING)}, 2) AS title FROM walked WHERE NOT fence AND NOT inside AND {_like('ln', E.HEADING)}),
sections AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS place FROM heads QUALIFY place <= {E.MAX_SECTIONS})"""


def _sections(spark, sf):
    found = table(spark, sf, "md_corpus").where(F.contains(F.col("body"), F.lit("#"))).select("doc_id", F.posexplode(T.sections(F.col("body"))).alias("p", "s"))
    return found.select("doc_id", (F.col("p") + 1).cast("bigint").alias("place"), F.col("s.level").cast("bigint").alias("level"), F.col("s.title").alias("title"))


@query(f"WITH {_SECTIONS_CTE} SELECT doc_id, place, level, title FROM sections")
def sections(spark, sf):
    return _sections(spark, sf)


_SLUG_CTE = f"slugged AS (SELECT doc_id, place, title, {_SLUG('title')} AS base, row_number() OVER (PARTITION BY doc_id, {_SLUG('title')} ORDER BY place) - 1 AS k FROM sections)"


@query(f"WITH {_SECTIONS_CTE} SELECT doc_id, string_agg(title, ' | ' ORDER BY place) AS titles FROM sections WHERE place <= 10 GROUP BY doc_id")
def first_titles(spark, sf):
    found = table(spark, sf, "md_corpus").select("doc_id", T.first_titles(F.col("body")).alias("t")).where(F.size("t") > 0)
    return found.select("doc_id", F.array_join("t", " | ").alias("titles"))


@query(f"WITH {_SECTIONS_CTE}, {_SLUG_CTE} SELECT doc_id, place, CASE WHEN k > 0 THEN base || '-' || k ELSE base END AS slug FROM slugged")
def slugs(spark, sf):
    base = _sections(spark, sf).withColumn("base", T.slug(F.col("title")))
    k = F.row_number().over(Window.partitionBy("doc_id", "base").orderBy("place")) - 1
    return base.withColumn("k", k).select("doc_id", "place", F.when(F.col("k") > 0, F.concat("base", F.lit("-"), F.col("k").cast("string"))).otherwise(F.col("base")).alias("slug"))


_TOC_SQL = f"""WITH {_SECTIONS_CTE}, n AS (SELECT doc_id, count(*) AS n FROM sections GROUP BY doc_id),
shown AS (SELECT doc_id, place, title FROM sections WHERE place <= {E.TOC_SHOWN}),
{_SLUG_CTE.replace('FROM sections', 'FROM shown')}
SELECT doc_id, '## 目录' || chr(10) || chr(10) || string_agg('- [' || title || '](#' || (CASE WHEN k > 0 THEN base || '-' || k ELSE base END) || ')', chr(10) ORDER BY place) || chr(10) || chr(10) AS toc
FROM slugged JOIN n USING (doc_id) WHERE n >= {E.TOC_FROM} GROUP BY doc_id"""


@query(_TOC_SQL)
def toc(spark, sf):
    found = table(spark, sf, "md_corpus").select("doc_id", T.sections(F.col("body")).alias("s"))
    return found.where(F.size("s") >= T.TOC_FROM).select("doc_id", T.table_of_contents(F.col("s")).alias("toc"))


@query(f"WITH {_SECTIONS_CTE} SELECT level, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM sections GROUP BY ROLLUP (level)")
def heading_rollup(spark, sf):
    """An extension: headings by level, with the total."""
    return _sections(spark, sf).rollup("level").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("n_docs"))


@query(f"WITH {_LINED} SELECT doc_id, count(*) FILTER (WHERE inside AND NOT fence) AS fenced, count(*) FILTER (WHERE fence) AS fences FROM walked GROUP BY doc_id")
def fence_parity(spark, sf):
    """Lines within fences, by a running state over the lines of a text."""
    one = lambda i, a, b: F.struct(i.alias("inside"), a.alias("fenced"), b.alias("fences"))
    step = lambda a, x: F.when(T.is_fence(x), one(~a["inside"], a["fenced"], a["fences"] + 1)).otherwise(one(a["inside"], a["fenced"] + a["inside"].cast("bigint"), a["fences"]))
    state = F.aggregate(T.lines(F.col("body")), one(F.lit(False), F.lit(0).cast("bigint"), F.lit(0).cast("bigint")), step)
    md = table(spark, sf, "md_corpus").where("body is not null").select("doc_id", state.alias("s"), F.size(T.lines(F.col("body"))).alias("n")).where("n > 0")
    return md.select("doc_id", F.col("s.fenced").alias("fenced"), F.col("s.fences").alias("fences"))


_RULE = q(E.TABLE_RULE)
_ROWS = f"list_filter(string_split(body, chr(10)), lambda l: {_like('l', rf'\A[{E.WSN}]*\|')})"


@query(f"""SELECT doc_id, CASE WHEN len(r) > 0 THEN '（表格文档：约 ' || greatest(0, len(r) - 2 * len(list_filter(r, lambda l: regexp_matches({_strip('l')}, {_RULE})))) || ' 行数据，详见正文表格）' ELSE '' END AS summary
FROM (SELECT doc_id, {_ROWS} AS r FROM md_corpus)""")
def table_summary(spark, sf):
    return table(spark, sf, "md_corpus").select("doc_id", T.table_summary(F.col("body")).alias("summary"))


# ------------------------------------------------------------------------------------------------------------------------ detection


@query(f"SELECT doc_id, {_MD('body')} AS is_markdown, {_CODE('body')} AS is_code FROM md_corpus")
def looks_like(spark, sf):
    return table(spark, sf, "md_corpus").select("doc_id", T.looks_like_markdown(F.col("body")).alias("is_markdown"), T.looks_like_code(F.col("body")).alias("is_code"))


@query(f"""SELECT doc_id, CASE WHEN {_LANG('relpath')} IS NOT NULL OR {_CODE('body')} THEN 'code' WHEN {_MD('body')} OR {_EXT('relpath')} IN ('.md', '.markdown', '.mdown', '.markdn') THEN 'md' ELSE 'txt' END AS format FROM md_corpus""")
def sniff_format(spark, sf):
    return table(spark, sf, "md_corpus").select("doc_id", T.sniff_format(F.col("relpath"), F.col("body")).alias("format"))


@query(f"SELECT doc_id, {_EXT('relpath')} AS ext, {_STEM('relpath')} AS stem, {_LANG('relpath')} AS lang FROM md_corpus")
def code_lang_map(spark, sf):
    p = F.col("relpath")
    return table(spark, sf, "md_corpus").select("doc_id", T.extension(p).alias("ext"), T.stem(p).alias("stem"), T.code_language(p).alias("lang"))


_W, _B = r"[\p{L}\p{N}_]", r"(?:\A|[^\p{L}\p{N}_])"


@query(f"""SELECT doc_id, CASE WHEN contains(body, 'cmake_minimum_required') OR {_like('body', rf'{_B}add_executable{E._NOT_WORD}')} THEN 'cmake'
WHEN {_like('body', rf'\A[{E.WSN}]*def[{E.WSN}]+{_W}')} OR {_like('body', rf'{_B}import[{E.WSN}]+{_W}')} THEN 'python' WHEN {_like('body', rf'\A[{E.WSN}]*#include{E._NOT_WORD}')} THEN 'c'
WHEN {_like('body', rf'{_B}fn[{E.WSN}]+{_W}')} OR {_like('body', rf'{_B}let[{E.WSN}]+mut{E._NOT_WORD}')} THEN 'rust' WHEN {_like('body', rf'{_B}func[{E.WSN}]+{_W}')} THEN 'go' ELSE 'text' END AS lang FROM md_corpus""")
def guess_language(spark, sf):
    return table(spark, sf, "md_corpus").select("doc_id", T.guess_language(F.col("body")).alias("lang"))


BLOBS = """SELECT * FROM (VALUES ('a.png', '89504E470D0A1A0A0000'), ('b.jpg', 'FFD8FFE000104A46'), ('c.gif', '474946383961'), ('d.webp', '524946460000000057454250'),
('e.wav', '524946460000000057415645'), ('f.tif', '49492A00'), ('g.tif', '4D4D002A'), ('h.bmp', '424D0000'), ('i.wmf', 'D7CDC69A0000'), ('j.pdf', '255044462D312E37'), ('k.doc', 'D0CF11E0A1B11AE1'),
('l.bin', '00010203'), ('m.txt', '68656C6C6F'), ('n.zip', '504B0304'), ('o.txt', ''), ('p.png', '255044462D312E34'), ('01_vec.png', '89504E470D0A1A0A'), ('r.svg', '3C737667'), ('s.emz', '1F8B'),
('q.emf', '0100000000000000000000000000000000000000000000000000000000000000000000000000000020454D46')) AS t(name, hexbytes)"""
_HX = lambda n, at=1: f"substr(hexbytes, {2 * at - 1}, {2 * n})"
_SIG = f"""CASE WHEN hexbytes = '' THEN 'empty' WHEN {_HX(2)} = '504B' AND {_HX(2, 3)} IN ('0304', '0506', '0708') THEN 'zip' WHEN {_HX(8)} = 'D0CF11E0A1B11AE1' THEN 'ole2' WHEN {_HX(4)} = '25504446' THEN 'pdf'
WHEN {_HX(8)} = '89504E470D0A1A0A' THEN 'png' WHEN {_HX(3)} = 'FFD8FF' THEN 'jpeg' WHEN {_HX(6)} IN ('474946383761', '474946383961') THEN 'gif' WHEN {_HX(4)} = '52494646' AND {_HX(4, 9)} = '57454250' THEN 'webp'
WHEN {_HX(4)} IN ('49492A00', '4D4D002A') THEN 'tiff' WHEN {_HX(2)} = '424D' THEN 'bmp' WHEN {_HX(4)} = 'D7CDC69A' THEN 'wmf' WHEN {_HX(4)} = '01000000' AND {_HX(4, 41)} = '20454D46' THEN 'emf' END"""


def _blobs(spark, sf):
    return fixture(spark, sf, BLOBS).withColumn("blob", F.unhex("hexbytes"))


@query(f"SELECT name, {_SIG} AS format, {_CASE(_SIG, {k: v for k, v in A.HANDLERS.items() if k not in ('docx', 'xlsx', 'pptx', 'md', 'code', 'txt')})} AS handler FROM ({BLOBS})")
def signature_detect(spark, sf):
    s = A.signature(F.col("blob"))
    return _blobs(spark, sf).select("name", s.alias("format"), A.handler(s).alias("handler"))


_XE = "lower(regexp_extract(name, '([^.]*)\\z', 1))"


@query(f"""SELECT name, CASE WHEN {_like('name', r'(?i)(?:\A|[^\p{L}\p{N}])vec(?:[^\p{L}\p{N}]|\z)')} OR {_XE} IN ('svg', 'emf', 'wmf') OR {_HX(4)} = '01000000' THEN 'diagram' WHEN {_XE} IN ('jpg', 'jpeg') OR {_HX(3)} = 'FFD8FF' THEN 'photo'
WHEN {_XE} IN ('png', 'gif', 'bmp', 'tif', 'tiff', 'webp') THEN 'screenshot' ELSE '' END AS class,
coalesce(CASE WHEN {_HX(4)} = 'D7CDC69A' THEN 'wmf' WHEN {_HX(4)} = '01000000' AND length(hexbytes) > 88 AND {_HX(4, 41)} = '20454D46' THEN 'emf' WHEN {_HX(5)} = '3C3F786D6C' OR {_HX(4)} = '3C737667' THEN 'svg' END,
CASE WHEN {_XE} IN ('emf', 'wmf', 'svg', 'emz', 'wmz', 'emfz') THEN {_XE} END) AS vector FROM ({BLOBS})""")
def image_class(spark, sf):
    b, n = F.col("blob"), F.col("name")
    return _blobs(spark, sf).select("name", A.image_class(b, n).alias("class"), A.vector_extension(b, n).alias("vector"))


# --------------------------------------------------------------------------------------------------------------------------- titles

_GENERIC = lambda x: f"(lower({_strip(x)}) IN ({', '.join(map(q, E.GENERIC_TITLES))}) OR {_like(_strip(x), r'\A[xX]{2,}\z')})"
_FORM = lambda x: f"lower(regexp_replace(coalesce({x}, ''), {q(E.TITLE_NOISE)}, '', 'g'))"
_LATEST = "latest AS (SELECT * FROM front_matter WHERE doc_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY written_at DESC NULLS LAST, id, title) = 1)"
_TITLED = f"{_LATEST}, titled AS (SELECT m.doc_id, m.relpath, m.body, coalesce(l.title, '') AS title FROM md_corpus m LEFT JOIN latest l USING (doc_id))"


def _titled(spark, sf):
    latest = K.latest_entries(table(spark, sf, "front_matter")).select("doc_id", "title")
    return table(spark, sf, "md_corpus").join(latest, "doc_id", "left").select("doc_id", "relpath", "body", F.coalesce("title", F.lit("")).alias("title"))


@query(f"WITH {_TITLED} SELECT doc_id, {_GENERIC('title')} AS generic, ({_strip('title')} = '' OR {_like(_strip('title'), E.PLACEHOLDER)}) AS placeholder FROM titled")
def generic_title(spark, sf):
    t = F.col("title")
    return _titled(spark, sf).select("doc_id", T.is_generic_title(t).alias("generic"), T.is_placeholder(t).alias("placeholder"))


@query(f"WITH {_TITLED} SELECT doc_id, (length({_FORM('title')}) < 2 OR contains({_FORM('body')}, {_FORM('title')})) AS present FROM titled")
def title_in_body(spark, sf):
    return _titled(spark, sf).select("doc_id", T.title_in_body(F.col("title"), F.col("body")).alias("present"))


_SF = _FORM(_strip("title"))


@query(f"WITH {_TITLED} SELECT doc_id, CASE WHEN NOT {_GENERIC('title')} AND (length({_SF}) < 2 OR contains({_FORM('body')}, {_SF})) THEN {_strip('title')} ELSE {_STEM('relpath')} END AS title FROM titled")
def pick_title(spark, sf):
    t = _titled(spark, sf)
    return t.select("doc_id", T.pick_title([F.col("title")], T.stem(F.col("relpath")), F.col("body")).alias("title"))


# --------------------------------------------------------------------------------------------------------------------- classification

CONFIG = C.Config(
    taxonomy=("research", "legal", "culture", "sport", "code"),
    mapping={"*.py": "code", "*-1?.*": "not-in-taxonomy"},
    keywords={"research": ("spectrometer", "microscope", "光谱仪", "reagent"), "legal": ("plaintiff", "clause", "仲裁", "Klägerin"), "culture": ("museum", "opera", "油画"), "sport": ("goalkeeper", "referee", "守门员", "Elfmeter"), "elsewhere": ("harbour", "港口")},
)
_NAME = _BASE("relpath")
_KT = f"lower({_NAME} || chr(10) || title || chr(10) || substr(body, 1, {E.TEXT_LENGTH}))"
_N = {c: " + ".join(f"contains(t, {q(k.lower())})::int" for k in ks) for c, ks in CONFIG.keywords.items()}
_MAP = r"CASE WHEN regexp_matches(lower(name), '(?s)^.*\.py$') THEN 'code' WHEN regexp_matches(name, '(?s)^.*-1.\..*$') THEN 'not-in-taxonomy' END"  # *.py, *-1?.*
_KEY = f"CASE WHEN greatest({', '.join(f'({n})' for n in _N.values())}) = 0 THEN NULL " + " ".join(f"WHEN ({n}) = greatest({', '.join(f'({m})' for m in _N.values())}) THEN {q(c)}" for c, n in _N.items()) + " END"
_CLASSED = f"{_TITLED}, classed AS (SELECT doc_id, relpath, {_MAP} AS m, {_KEY} AS k FROM (SELECT doc_id, relpath, {_NAME} AS name, {_KT} AS t FROM titled))"


def _texts(spark, sf):
    """Classification looks at the beginning of a body only, so that is all that goes through the join."""
    latest = K.latest_entries(table(spark, sf, "front_matter")).select("doc_id", "title", "category")
    short = table(spark, sf, "md_corpus").select("doc_id", "relpath", F.substring("body", 1, C.TEXT_LENGTH).alias("body"))
    t = short.join(latest.withColumn("entered", F.lit(True)), "doc_id", "left").withColumn("title", F.coalesce("title", F.lit("")))
    return t.withColumn("name", T.base_name(F.col("relpath"))).withColumn("classify_text", C.classify_text(F.col("title"), F.col("body")))


@query(f"WITH {_CLASSED} SELECT doc_id, m AS by_mapping, k AS by_keywords, coalesce(m, k, 'unclassified') AS category FROM classed")
def classify(spark, sf):
    n, t = F.col("name"), F.col("classify_text")
    return _texts(spark, sf).select("doc_id", C.by_mapping(CONFIG, n).alias("by_mapping"), C.by_keywords(CONFIG, F.concat(n, F.lit("\n"), t)).alias("by_keywords"), C.classify(CONFIG, n, t).alias("category"))


_VALID = "CASE WHEN c IN ('research', 'legal', 'culture', 'sport', 'code', 'unclassified') THEN c ELSE 'unclassified' END"


@query(f"WITH {_CLASSED} SELECT {_VALID} AS category, count(*) AS n FROM (SELECT coalesce(m, k, 'unclassified') AS c FROM classed) GROUP BY 1")
def category_counts(spark, sf):
    """Flagship: texts to categories of the taxonomy."""
    c = C.valid_category(CONFIG, C.classify(CONFIG, F.col("name"), F.col("classify_text")))
    return _texts(spark, sf).select(c.alias("category")).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_CLASSED}, o AS (SELECT c.relpath, l.category AS old_category, {_VALID.replace('c IN', 'cc IN').replace('THEN c', 'THEN cc')} AS new_category FROM (SELECT *, coalesce(m, k, 'unclassified') AS cc FROM classed) c JOIN latest l USING (doc_id)) SELECT * FROM o WHERE new_category IS DISTINCT FROM old_category")
def reclassify(spark, sf):
    return C.reclassified(CONFIG, _texts(spark, sf).where("entered"))


@query("SELECT DISTINCT 'mapping' AS kind, category FROM front_matter WHERE category IS NOT NULL AND category NOT IN ('research', 'legal', 'culture', 'sport', 'code', 'unclassified')")
def config_warnings(spark, sf):
    """Rules that name a category outside the taxonomy: here a rule for every category that was written by hand."""
    rules = {f"*.{i}": r["category"] for i, r in enumerate(table(spark, sf, "front_matter").where("category is not null").select("category").distinct().collect())}
    return spark.createDataFrame(C.Config(CONFIG.taxonomy, mapping=rules).warnings(), "kind string, category string")


# ---------------------------------------------------------------------------------------------------------------------- deferred work

_ONCE = "once AS (SELECT doc_no, pos, type, cnt, note, loc, unit, cls FROM deferred QUALIFY row_number() OVER (PARTITION BY doc_no, pos ORDER BY received_at NULLS LAST, type NULLS FIRST, cnt NULLS FIRST, note NULLS FIRST, loc NULLS FIRST, unit NULLS FIRST, cls NULLS FIRST) = 1)"
_SAFE = r"trim(regexp_replace(replace(coalesce(note, ''), '-->', ''), '[\r\n]+', ' ', 'g'))"


@query(f"WITH {_ONCE} SELECT doc_no, pos, concat_ws(' ', '<!-- stage2:' || type || '=' || cnt, CASE WHEN coalesce(unit, '') <> '' THEN 'unit=' || unit END, CASE WHEN coalesce(cls, '') <> '' THEN 'class=' || cls END, CASE WHEN {_SAFE} <> '' THEN {_SAFE} END, '-->') AS marker FROM once WHERE type IS NOT NULL AND cnt IS NOT NULL")
def defer_markers(spark, sf):
    items = D.items_once(table(spark, sf, "deferred")).where("type is not null and cnt is not null")
    return items.select("doc_no", "pos", D.marker(F.col("type"), F.col("cnt"), F.col("note"), F.col("unit"), F.col("cls")).alias("marker"))


@query(f"""SELECT doc_id, generate_subscripts(w, 1) - 1 AS pos, unnest(t) AS type, CAST(unnest(n) AS BIGINT) AS cnt, trim(unnest(m)) AS modifiers, unnest(list_transform(o, lambda x: coalesce(x, ''))) AS note FROM (
SELECT doc_id, regexp_extract_all(body, {q(E.MARKER)}, 0) AS w, regexp_extract_all(body, {q(E.MARKER)}, 1) AS t, regexp_extract_all(body, {q(E.MARKER)}, 2) AS n, regexp_extract_all(body, {q(E.MARKER)}, 3) AS m, regexp_extract_all(body, {q(E.MARKER)}, 4) AS o FROM md_corpus)""")
def extract_markers(spark, sf):
    return D.extract_markers(table(spark, sf, "md_corpus"), "doc_id", "body")


_AGG = f"""{_ONCE}, agg AS (SELECT doc_no, type, min(pos) AS first_pos, sum(cnt)::BIGINT AS cnt, arg_min(note, pos) FILTER (WHERE coalesce(note, '') <> '') AS note, arg_min(unit, pos) FILTER (WHERE coalesce(unit, '') <> '') AS unit,
arg_min(cls, pos) FILTER (WHERE coalesce(cls, '') <> '') AS cls FROM once GROUP BY doc_no, type),
places AS (SELECT doc_no, type, string_agg(loc, ',' ORDER BY p) AS locs FROM (SELECT doc_no, type, loc, min(pos) AS p FROM once WHERE coalesce(loc, '') <> '' GROUP BY doc_no, type, loc) GROUP BY doc_no, type)"""


@query(f"WITH {_AGG} SELECT a.doc_no, a.type, first_pos, cnt, note, unit, cls, coalesce(locs, '') AS locs FROM agg a LEFT JOIN places p ON a.doc_no IS NOT DISTINCT FROM p.doc_no AND a.type IS NOT DISTINCT FROM p.type")
def aggregate_deferred(spark, sf):
    return D.aggregate(D.items_once(table(spark, sf, "deferred"))).withColumn("locs", F.array_join("locs", ","))


@query(f"""WITH deferred AS (SELECT kind AS type FROM assets UNION ALL SELECT type FROM main.deferred WHERE type <> 'formula') SELECT type, CASE WHEN u THEN 'used only' ELSE 'contract only' END AS side FROM ((SELECT DISTINCT type, true AS u FROM deferred WHERE type IS NOT NULL AND type NOT IN ({', '.join(map(q, E.TYPES))})) UNION ALL (SELECT t, false FROM (VALUES {', '.join(f'({q(t)})' for t in E.TYPES)}) AS k(t) WHERE t NOT IN (SELECT type FROM deferred WHERE type IS NOT NULL)))""")
def contract_diff(spark, sf):
    """Kinds of pictures stand for types without a contract, and one type is left out, so that both sides show."""
    used = table(spark, sf, "assets").select(F.col("kind").alias("type")).unionAll(table(spark, sf, "deferred").where("type <> 'formula'").select("type"))
    return D.contract_difference(used)


@query(f"WITH {_AGG}, left_ AS (SELECT doc_no, count(*) AS n_types, sum(cnt)::BIGINT AS n_items FROM agg GROUP BY doc_no) SELECT m.doc_id, m.relpath, n_types, n_items FROM md_corpus m JOIN left_ ON m.doc_id = left_.doc_no")
def stage2_pending(spark, sf):
    docs = table(spark, sf, "md_corpus").select("doc_id", "relpath")
    return D.pending(docs, D.aggregate(D.items_once(table(spark, sf, "deferred"))))


@query("SELECT doc_id, replace(body, '<!-- stage2:chart=1 unit=page -->', 'resolved chart') AS body FROM md_corpus WHERE contains(body, '<!-- stage2:chart=1 unit=page -->')")
def resolve_markers(spark, sf):
    """Results take the place of their markers: here every chart marker that stands for one picture of a page."""
    md = table(spark, sf, "md_corpus").select("doc_id", "body").where(F.contains(F.col("body"), F.lit("<!-- stage2:chart=1 unit=page -->")))
    done = D.extract_markers(md, "doc_id", "body").where("type = 'chart' and cnt = 1 and modifiers = 'unit=page' and note = ''")
    return D.resolve(md, "doc_id", "body", done.select("doc_id", "pos", F.lit("resolved chart").alias("result")))


# ------------------------------------------------------------------------------------------------------------------ incremental state

_SNAPS = "a AS (SELECT relpath, sha256(content) AS old, ord FROM snap_a), b AS (SELECT relpath, sha256(content) AS new, content = '' AS empty FROM snap_b)"
_DIFF = f"{_SNAPS}, diff AS (SELECT coalesce(a.relpath, b.relpath) AS relpath, CASE WHEN b.new IS NULL THEN 'prune' WHEN empty THEN 'empty' WHEN a.old IS NULL THEN 'new' WHEN a.old = b.new THEN 'skip' ELSE 'changed' END AS action, ord FROM a FULL JOIN b ON a.relpath = b.relpath)"


def _snaps(spark, sf):
    a = table(spark, sf, "snap_a").select("relpath", F.sha2("content", 256).alias("sha256"), "ord")
    return a, I.keyed(table(spark, sf, "snap_b"))


@query(f"WITH {_DIFF} SELECT relpath, action, ord FROM diff")
def manifest_diff(spark, sf):
    return I.diff(*_snaps(spark, sf))


@query(f"WITH {_DIFF} SELECT action, count(*) AS n FROM diff GROUP BY action")
def action_counts(spark, sf):
    return I.counts(I.diff(*_snaps(spark, sf)))


@query(f"WITH {_SNAPS} SELECT b.relpath, b.new AS sha256 FROM b WHERE EXISTS (SELECT 1 FROM a WHERE a.relpath = b.relpath AND a.old = b.new)")
def unchanged_semi(spark, sf):
    a, b = _snaps(spark, sf)
    return I.unchanged(a, b).select("relpath", "sha256")


@query(f"WITH {_SNAPS} SELECT relpath, ord FROM a WHERE relpath NOT IN (SELECT relpath FROM b)")
def pruned_anti(spark, sf):
    return I.pruned(*_snaps(spark, sf)).select("relpath", "ord")


@query(f"WITH {_SNAPS} SELECT a.relpath, coalesce(b.new, a.old) AS sha256, a.ord FROM a LEFT JOIN b ON a.relpath = b.relpath AND NOT b.empty UNION ALL SELECT b.relpath, b.new, (SELECT max(ord) FROM a) + row_number() OVER (ORDER BY b.relpath) FROM b WHERE NOT empty AND relpath NOT IN (SELECT relpath FROM a)")
def upsert(spark, sf):
    """Known entries keep their place; new ones follow in the order of their paths. Places of new ones may have gaps, so they are shown by their rank."""
    a, b = _snaps(spark, sf)
    merged = I.upsert(a, b.where("not empty").select("relpath", "sha256"))
    last = a.agg(F.max("ord").alias("last")).first()["last"]
    new = merged.where(F.col("ord") > F.lit(last))
    rank = F.row_number().over(Window.orderBy("ord"))
    return merged.where(F.col("ord") <= F.lit(last)).select("relpath", "sha256", "ord").unionAll(new.select("relpath", "sha256", (rank + F.lit(last)).cast("bigint")))


# ----------------------------------------------------------------------------------------------------------------------------- assets

_RES = "CASE WHEN coalesce(present, false) AND coalesce(ocr_text, '') <> '' THEN '```' || chr(10) || ocr_text || chr(10) || '```' ELSE concat_ws(' ', '<!-- stage2:' || (CASE WHEN kind = 'scan' THEN 'scan-page' ELSE 'image-ocr' END) || '=1', 'class=' || (CASE WHEN kind = 'vec' THEN 'diagram' ELSE 'screenshot' END), CASE WHEN NOT coalesce(present, false) THEN '资产文件丢失' END, '-->') END"


def _resolution():
    """The class is told by the stored name here: the table has no bytes."""
    dest = A.destination(F.col("seq"), F.col("kind"))
    return A.resolution(F.col("kind"), F.col("ocr_text"), F.col("present"), A.image_class(F.lit(None).cast("binary"), dest))


@query(f"SELECT a.doc_id, m.relpath, lpad(seq::VARCHAR, 2, '0') || '_' || kind || '.png' AS dest, {_RES} AS resolved FROM assets a LEFT JOIN md_corpus m ON a.doc_id = m.doc_id")
def ocr_join(spark, sf):
    """Recognised pictures with their documents: texts and reasons by asset, joined to paths."""
    said = table(spark, sf, "assets").select("doc_id", A.destination(F.col("seq"), F.col("kind")).alias("dest"), _resolution().alias("resolved"))
    return said.join(table(spark, sf, "md_corpus").select("doc_id", "relpath"), "doc_id", "left").select("doc_id", "relpath", "dest", "resolved")


@query("SELECT kind, CASE WHEN NOT coalesce(present, false) THEN '资产文件丢失' WHEN coalesce(ocr_text, '') = '' THEN '' ELSE 'text' END AS reason, count(*) AS n FROM assets GROUP BY 1, 2")
def ocr_reasons(spark, sf):
    reason = F.when(~F.coalesce("present", F.lit(False)), "资产文件丢失").when(F.coalesce("ocr_text", F.lit("")) == "", "").otherwise("text")
    return table(spark, sf, "assets").groupBy("kind", reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, seq, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS place FROM assets")
def asset_seq(spark, sf):
    return A.numbered(table(spark, sf, "assets"), "seq").select("doc_id", "seq", "place")


@query("""WITH b AS (SELECT doc_id, 'start' || string_agg(chr(10) || '<!-- ocr:' || (CASE WHEN kind = 'scan' THEN 'scan' ELSE 'img' END) || ':' || lpad(seq::VARCHAR, 2, '0') || '_' || kind || '.png -->', '' ORDER BY seq) || ' end' AS body FROM assets GROUP BY doc_id),
r AS (SELECT doc_id, string_agg(chr(10) || (""" + _RES + """), '' ORDER BY seq) AS given FROM assets GROUP BY doc_id) SELECT doc_id, 'start' || given || ' end' AS body FROM b JOIN r USING (doc_id)""")
def resolve_placeholders(spark, sf):
    """Bodies with a placeholder for each asset, and the join that puts recognised text in their place."""
    a = table(spark, sf, "assets").withColumn("dest", A.destination(F.col("seq"), F.col("kind")))
    mark = F.concat(F.lit("\n<!-- ocr:"), F.when(F.col("kind") == "scan", "scan").otherwise("img"), F.lit(":"), F.col("dest"), F.lit(" -->"))
    bodies = a.groupBy("doc_id").agg(F.concat(F.lit("start"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", mark.alias("m")))), lambda s: s["m"]), ""), F.lit(" end")).alias("body"))
    given = a.select("doc_id", "dest", _resolution().alias("replacement"))
    return A.resolve_placeholders(bodies, given)


# --------------------------------------------------------------------------------------------------------------------------- geometry

BLOCKS = """SELECT source AS doc, doc_id AS page, CAST(72 AS DOUBLE) AS x0, CAST(12 * (doc_id % 50) AS DOUBLE) AS y0, CAST(72 + 5 * (doc_id % 30) AS DOUBLE) AS x1, CAST(12 * (doc_id % 50) + 10.5 AS DOUBLE) AS y1, text FROM {documents} WHERE text IS NOT NULL
UNION ALL SELECT source, doc_id, CAST(200.2 AS DOUBLE), CAST(300.4 AS DOUBLE), CAST(380.1 AS DOUBLE), CAST(312.3 AS DOUBLE), 'WATERMARK  confidential' FROM {documents} WHERE n_chars IS NOT NULL"""
TABLES = "SELECT source AS doc, doc_id AS page, CAST(60 AS DOUBLE) AS x0, CAST(100 AS DOUBLE) AS y0, CAST(150 AS DOUBLE) AS x1, CAST(330 AS DOUBLE) AS y1 FROM {documents} WHERE lang IS NOT NULL"
WORDS = "SELECT user_id AS cell, event_id AS wid, CAST(10 * (event_id % 7) AS DOUBLE) AS x0, CAST(value AS DOUBLE) AS y0, CAST(CASE WHEN event_id % 17 = 0 THEN value + 90 ELSE value + 10 END AS DOUBLE) AS y1, event_type AS text FROM {events}"
_BT = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"
_RB = ", ".join(f"CAST(round_even({c}, 0) AS BIGINT) AS r{c}" for c in G.BOX)


@query(duck(f"""WITH blocks AS ({BLOCKS}), keyed AS (SELECT DISTINCT doc, page, {_BT} AS text, {_RB} FROM blocks WHERE {_BT} <> ''), pages AS (SELECT doc, count(DISTINCT page) AS pages FROM blocks GROUP BY doc)
SELECT k.doc, text, rx0, ry0, rx1, ry1, count(*) AS n_pages FROM keyed k JOIN pages p ON k.doc = p.doc GROUP BY k.doc, text, rx0, ry0, rx1, ry1, pages HAVING count(*) >= 3 AND count(*) >= 0.6 * pages"""))
def cross_page_boilerplate(spark, sf):
    return G.repeated_blocks(fixture(spark, sf, BLOCKS))


@query(duck(f"""WITH blocks AS ({BLOCKS}), tabs AS ({TABLES}) SELECT doc, count(*) AS n FROM blocks b WHERE NOT EXISTS (SELECT 1 FROM tabs t WHERE t.doc = b.doc AND t.page = b.page AND b.x0 >= t.x0 - 2 AND b.y0 >= t.y0 - 2 AND b.x1 <= t.x1 + 2 AND b.y1 <= t.y1 + 2) GROUP BY doc"""))
def table_block_exclusion(spark, sf):
    return G.outside_tables(fixture(spark, sf, BLOCKS), fixture(spark, sf, TABLES)).groupBy("doc").agg(F.count(F.lit(1)).alias("n"))


@query(duck(f"""WITH words AS ({WORDS}), ranked AS (SELECT *, y1 - y0 AS h, row_number() OVER (PARTITION BY cell ORDER BY y1 - y0) AS k, count(*) OVER (PARTITION BY cell) AS n FROM words),
med AS (SELECT *, max(CASE WHEN k = n // 2 + 1 THEN h END) OVER (PARTITION BY cell) AS m FROM ranked), kept AS (SELECT * FROM med WHERE h <= least(120.0, greatest(3.5 * m, m + 1))),
starts AS (SELECT *, CASE WHEN abs(y0 - lag(y0) OVER (PARTITION BY cell ORDER BY y0, x0, wid)) <= 3 THEN 0 ELSE 1 END AS s FROM kept), lined AS (SELECT *, sum(s) OVER (PARTITION BY cell ORDER BY y0, x0, wid)::BIGINT AS line FROM starts)
SELECT cell, line, string_agg(text, ' ' ORDER BY x0, wid, text) AS text FROM lined GROUP BY cell, line"""))
def cell_lines(spark, sf):
    return G.cell_lines(fixture(spark, sf, WORDS))


# ------------------------------------------------------------------------------------------------------------------------ spreadsheets

_SHEET = "SELECT concat('D', CAST(o_custkey % 3 AS STRING)) AS doc, concat('S', CAST(o_orderkey % 4 AS STRING)) AS sheet, CAST(1 + floor(o_orderkey / 4.0) AS BIGINT) AS r, "
CELLS = " UNION ALL ".join(
    _SHEET + f"CAST({c} AS BIGINT) AS c, {cached} AS cached, {formula} AS formula FROM {{orders}}"
    for c, cached, formula in (
        (1, "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END", "CAST(NULL AS STRING)"),
        (2, "o_orderstatus", "CAST(NULL AS STRING)"),
        (3, "CAST(NULL AS STRING)", "CASE WHEN o_orderkey % 2 = 0 THEN concat('=A', CAST(o_orderkey AS STRING), '*2') ELSE NULL END"),
    )
)
MERGES = "SELECT DISTINCT concat('D', CAST(o_custkey % 3 AS STRING)) AS doc, concat('S', CAST(o_orderkey % 4 AS STRING)) AS sheet, CAST(1 + floor(o_orderkey / 40.0) * 10 AS BIGINT) AS r0, CAST(2 AS BIGINT) AS c0, CAST(4 + floor(o_orderkey / 40.0) * 10 AS BIGINT) AS r1, CAST(3 AS BIGINT) AS c1 FROM {orders}"
_DC = duck(CELLS).replace("STRING", "VARCHAR")
_DM = duck(MERGES).replace("STRING", "VARCHAR")
_SHOWN = f"shown AS (SELECT doc, sheet, r, c, coalesce(cached, formula) AS value, cached IS NULL AND formula IS NOT NULL AS from_formula FROM ({_DC}))"


@query(f"WITH {_SHOWN} SELECT doc, sheet, r, c, value, from_formula FROM shown")
def formula_fallback(spark, sf):
    return S.values(fixture(spark, sf, CELLS))


@query(f"""WITH {_SHOWN}, merges AS ({_DM}), tops AS (SELECT m.*, s.value AS top FROM merges m JOIN shown s ON s.doc = m.doc AND s.sheet = m.sheet AND s.r = m.r0 AND s.c = m.c0)
SELECT s.doc, s.sheet, s.r, s.c, coalesce(s.value, t.top) AS value FROM shown s LEFT JOIN tops t ON s.doc = t.doc AND s.sheet = t.sheet AND s.r BETWEEN t.r0 AND t.r1 AND s.c BETWEEN t.c0 AND t.c1 AND (s.r <> t.r0 OR s.c <> t.c0)""")
def merged_fill(spark, sf):
    return S.fill_merged(S.values(fixture(spark, sf, CELLS)), fixture(spark, sf, MERGES)).select("doc", "sheet", "r", "c", "value")


@query(f"WITH {_SHOWN} SELECT doc, sheet, max(r) AS rows, coalesce(max(CASE WHEN value <> '' THEN c END), 0) AS columns, max(r) > 2000 AS rows_cut, coalesce(max(CASE WHEN value <> '' THEN c END) > 100, false) AS columns_cut, sum(from_formula::int)::BIGINT AS formula_cells FROM shown GROUP BY doc, sheet")
def sheet_truncation(spark, sf):
    return S.limits(S.values(fixture(spark, sf, CELLS)))


_CELL = lambda x: _strip(f"replace(replace(regexp_replace(coalesce({x}, ''), '[\\n\\x0b\\x0c\\r]', ' ', 'g'), chr(92), chr(92) || chr(92)), '|', chr(92) || '|')")


@query(f"""WITH {_SHOWN}, rows_ AS (SELECT doc, sheet, r, max(CASE WHEN c = 1 THEN value END) AS a, max(CASE WHEN c = 2 THEN value END) AS b, max(CASE WHEN c = 3 THEN value END) AS d FROM shown WHERE r <= 2000 GROUP BY doc, sheet, r),
w AS (SELECT doc, sheet, max(c) AS width FROM shown WHERE r <= 2000 AND coalesce(value, '') <> '' GROUP BY doc, sheet)
SELECT doc, sheet, r, '| ' || {_CELL('a')} || ' | ' || {_CELL('b')} || (CASE WHEN width = 3 THEN ' | ' || {_CELL('d')} ELSE '' END) || ' |' AS line FROM rows_ JOIN w USING (doc, sheet) WHERE coalesce(a, '') <> '' OR coalesce(b, '') <> '' OR coalesce(d, '') <> ''""")
def sheet_rows(spark, sf):
    return S.rendered_rows(S.values(fixture(spark, sf, CELLS)))


@query(f"SELECT doc_id, '| ' || {_CELL('relpath')} || ' | ' || {_CELL('body')} || ' |' || chr(10) || '|---|---|' || chr(10) || '| ' || {_CELL('title')} || ' |  |' AS md FROM (WITH {_TITLED} SELECT * FROM titled)")
def md_table(spark, sf):
    rows = F.array(F.array("relpath", "body"), F.array("title"))
    return _titled(spark, sf).select("doc_id", T.markdown_table(rows).alias("md"))


@query("SELECT p_partkey, list_reduce(list_transform(string_split(upper(regexp_replace(p_brand, '[^A-Za-z]', '', 'g')), ''), lambda x: ascii(x) - 64), lambda a, x: (a * 26 + x) % 2147483647)::BIGINT AS n FROM part".replace("(a * 26 + x) % 2147483647", "a * 26 + x"))
def col_to_num(spark, sf):
    letters = F.regexp_replace("p_brand", "[^A-Za-z]", "")
    return table(spark, sf, "part").select("p_partkey", T.column_number(letters).cast("bigint").alias("n"))


# ---------------------------------------------------------------------------------------------------------------------------- catalog


@query(f"WITH {_LATEST} SELECT doc_id, id, title, category, source, source_type, array_to_string(tags, ',') AS tags, summary FROM latest")
def catalog(spark, sf):
    e = K.latest_entries(table(spark, sf, "front_matter"))
    return e.select("doc_id", "id", "title", "category", "source", "source_type", F.array_join("tags", ",").alias("tags"), "summary")


@query(f"WITH {_LATEST} SELECT category, id FROM latest")
def categories(spark, sf):
    return K.categories(K.latest_entries(table(spark, sf, "front_matter")))


@query(f"WITH {_LATEST} SELECT category, source_type, count(*) AS n FROM latest GROUP BY 1, 2")
def catalog_by_source_type(spark, sf):
    return K.by_type(K.latest_entries(table(spark, sf, "front_matter")))


@query(f"SELECT top_dir, least(count(*), 201) AS n FROM (SELECT regexp_extract(relpath, '\\A([^/]+)/', 1) AS top_dir, {_EXT('relpath')} AS e FROM md_corpus) WHERE top_dir <> '' AND lower(top_dir) NOT IN ({', '.join(map(q, E.EXCLUDED_DIRECTORIES))}) AND top_dir NOT LIKE '.%' AND e IN ({', '.join(map(q, E.DOCUMENT_EXTENSIONS))}) GROUP BY top_dir ORDER BY n DESC, top_dir LIMIT 1")
def input_dir_topk(spark, sf):
    return K.input_directories(table(spark, sf, "md_corpus"))


@query("SELECT doc_id, octet_length(encode(body)) AS bytes FROM md_corpus WHERE octet_length(encode(body)) > 16384")
def large_texts(spark, sf):
    """The large-file warning, here for bodies over 16 KiB."""
    n = F.octet_length("body").cast("bigint")
    return table(spark, sf, "md_corpus").where(n > 16384).select("doc_id", n.alias("bytes"))


# --------------------------------------------------------------------------------------------------------------------------- parsers


def _expected(rows: list[tuple]) -> str:
    """Rows of literals for DuckDB."""
    one = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else q(v)
    return ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows)


# What the sample documents have to become, written by hand.
BODIES = {
    "rich.docx": ("Annual survey", "# Survey\n\nplain **bold** and ***both***\n\n1. first\n\n  1. inner\n\n- bullet\n\neq\n\n<!-- stage2:formula=2 unit=para class=formula 含数学公式(OMML)未提取 -->\n\nfig\n\n![图1](../../original-doc/doc-x_assets/01_img.png)\n\n<!-- ocr:img:01_img.png -->\n\nsketch\n\n<!-- stage2:chart=1 class=chart 图表/SmartArt等图形未提取 -->\n\n| a\\|b | x |\n|---|---|\n| a\\|b | y |\n\n### 浮动文本框内容\n\nin a box\n\n### 脚注\n\nsee below\n\n### 批注\n\n[Re Viewer] look"),
    "empty.docx": ("empty", "<!-- 空文档: empty.docx -->"),
    "rich.xlsx": ("rich", "### Sheet: Sales\n\n| kind | n | True |\n|---|---|---|\n| kind | 2.5 | 2024-01-01 00:00:00 |\n| kind |  |  |\n| kind | =B2*2 |  |\n\n<!-- stage2:formula-cell=1 无缓存值, 已回退显示公式文本, 见原文件复核 -->"),
    "deck.pptx": ("Topic", "## Slide 1: Topic\n\n  - inner\n  - more\n\n| a | b |\n|---|---|\n| 1 | 2 |\n\n![图1](../../original-doc/doc-x_assets/01_img.png)\n\n<!-- ocr:img:01_img.png -->\n\n<!-- stage2:chart=1 unit=slide class=chart 图表/SmartArt等未提取 -->\n\n> 备注: say this\n\n## Slide 2: only line\n\nbelow\nit"),
    "table.pdf": ("table", "<!-- page:1 -->\n\nAbove\n\n| A1 | B1 |\n|---|---|\n| A2 | B2 |"),
    "five.pdf": ("five", "\n\n".join(f"<!-- page:{i} -->\n\nText of page {i}" for i in range(1, 6))),
    "outline.pdf": ("Body", "<!-- page:1 -->\n\n# One\n\n## Two\n\nBody"),
    "scan.pdf": ("scan", "<!-- page:1 -->\n\n![扫描页](../../original-doc/doc-x_assets/01_scan.png)\n\n<!-- ocr:scan:01_scan.png -->"),
    "locked.pdf": ("locked", "<!-- stage2:encrypted=1 PDF加密: locked.pdf -->"),
    "note.txt": ("note", "中文GBK编码的纯文本。"),
    "a.py": ("a", "```python\nx = 1\n```"),
    "page.md": ("Head", "text\n# Head\nmore\n"),
    "pic.png": ("pic", "![pic](../../original-doc/pic.png)\n\n<!-- ocr:img:01_img.png -->"),
    "photo.jpg": ("photo", "![photo](../../original-doc/photo.jpg)\n\n<!-- ocr:img:01_img.jpg -->"),
}
WORK = [
    ("rich.docx", "formula", 2, "formula", "para", None), ("rich.docx", "chart", 1, "chart", None, None), ("rich.xlsx", "formula-cell", 1, None, None, "sheet:Sales"), ("long.xlsx", "truncated", 1, None, None, "sheet:Long"),
    ("deck.pptx", "chart", 1, "chart", "slide", "slide:1"), ("locked.pdf", "encrypted", 1, None, None, None), ("broken.docx", "parse-failed", 1, None, None, None),
]


def _documents(spark, stored=True):
    """The sample documents, parsed in tasks and rendered."""
    from leafmill.parsers import base, parse
    from leafmill.plans.render import rendered

    blobs = spark.createDataFrame([(n, *v) for n, v in SAMPLES.DOCUMENTS.items()], "relpath string, content binary, handler string, encoding string, lang string")

    def run(batches):
        import pandas as pd

        for b in batches:
            yield pd.DataFrame([parse(r.handler, bytes(r.content), base.Source(r.relpath, "doc-x", r.encoding, r.lang)).row() for r in b.itertuples(index=False)])

    return rendered(blobs.mapInPandas(run, base.PARSED).withColumn("id", F.lit("doc-x")), stored)


@query(f"SELECT * FROM (VALUES {_expected([(n, *v) for n, v in BODIES.items()])}) AS t(name, title, body)")
def parsed_bodies(spark, sf):
    """Titles and bodies of documents of every format."""
    return _documents(spark).where(F.col("relpath").isin(*BODIES)).select(F.col("relpath").alias("name"), "title", "body")


@query(f"SELECT * FROM (VALUES {_expected(WORK)}) AS t(name, type, cnt, cls, unit, loc)")
def parsed_work(spark, sf):
    """Work that parsers leave, a failure included."""
    x = _documents(spark).select(F.col("relpath").alias("name"), F.explode("deferred").alias("d"))
    return x.select("name", "d.type", F.col("d.count").alias("cnt"), "d.cls", "d.unit", "d.loc")


@query("SELECT * FROM (VALUES ('rich.docx', 'screenshot'), ('deck.pptx', 'screenshot'), ('pic.png', 'screenshot'), ('photo.jpg', 'photo')) AS t(name, cls)")
def pictures_unstored(spark, sf):
    """Without storage pictures become work, with the class that their bytes tell."""
    x = _documents(spark, stored=False).select(F.col("relpath").alias("name"), F.explode("deferred").alias("d"))
    return x.where("d.type = 'image-ocr'").select("name", "d.cls")


@query("SELECT * FROM (VALUES ('a.docx', 'docx'), ('b.zip', 'xlsx'), ('c.bin', 'pptx'), ('d.docx', 'zip'), ('e.xlsx', 'zip-corrupt'), ('f.xlsx', 'xlsx'), ('g.zip', 'zip')) AS t(name, kind)")
def zip_detect(spark, sf):
    """Kinds of zip containers by what is in them, whatever their names."""
    from leafmill.parsers.office import detect

    def run(batches):
        import pandas as pd

        for b in batches:
            yield pd.DataFrame({"name": b["name"], "kind": [detect(bytes(x)) for x in b["content"]]})

    return spark.createDataFrame(list(SAMPLES.ZIPS.items()), "name string, content binary").mapInPandas(run, "name string, kind string")


_XML = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x{FFFE}\x{FFFF}]|\r"


@query(f"SELECT doc_id, coalesce(nullif(array_to_string(list_filter(string_split(regexp_replace(body, {q(_XML)}, '', 'g'), chr(10)), lambda x: {_strip('x')} <> ''), chr(10) || chr(10)), ''), '<!-- 空文档: ' || {_BASE('relpath')} || ' -->') AS body FROM md_corpus")
def docx_corpus(spark, sf):
    """Every body written as a text document, a paragraph a line, and parsed again."""
    from leafmill.parsers import base, parse
    from leafmill.plans.render import rendered

    md = table(spark, sf, "md_corpus").select("doc_id", "relpath", F.regexp_replace("body", _XML, "").alias("body"))

    def run(batches):
        from xml.sax.saxutils import escape

        import pandas as pd

        for b in batches:
            yield pd.DataFrame([parse("docx", SAMPLES.docx("".join(SAMPLES.p(SAMPLES.run(escape(x))) for x in body.split("\n"))), base.Source(rel)).row() | {"id": str(i)} for i, rel, body in b.itertuples(index=False)])

    drafts = md.mapInPandas(run, base.PARSED + ", id string")
    return rendered(drafts).select(F.col("id").cast("bigint").alias("doc_id"), "body")


# ------------------------------------------------------------------------------------------------------------------------- whole job


def work_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors see: in the cluster's shared one; of this machine only where all tasks run on it."""
    import atexit
    import os
    import shutil
    import tempfile

    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        path = given.removeprefix("file://")
        os.makedirs(path, exist_ok=True)
        folder = tempfile.mkdtemp(prefix="leafmill-", dir=path)
    elif spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="leafmill-")
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _built(spark: SparkSession, sf: str, again: bool = False):
    """(output folder, summary) of a knowledge base of all bodies, each a file NUMBER.md; again: of a second run, after a seventh of the files has gone and
    another seventh was rewritten."""
    import os

    from leafmill.plans.pipeline import run

    root = work_folder(spark)
    files = table(spark, sf, "md_corpus").select("doc_id", "body")

    def write(batches):
        import pandas as pd

        for b in batches:
            for i, body in b.itertuples(index=False):
                with open(os.path.join(root, "in", f"{i}.md"), "wb") as f:
                    f.write(body.encode())
            yield pd.DataFrame({"n": [len(b)]})

    os.makedirs(os.path.join(root, "in"))
    files.mapInPandas(write, "n bigint").agg(F.sum("n")).collect()
    out = os.path.join(root, "out")
    summary = run(spark, os.path.join(root, "in"), out, CONFIG)
    if again:
        for i in [r[0] for r in files.where("doc_id % 7 = 0").select("doc_id").toLocalIterator()]:
            os.remove(os.path.join(root, "in", f"{i}.md"))
        files.where("doc_id % 7 = 1").select("doc_id", F.concat("body", F.lit("\n\nChanged.")).alias("body")).mapInPandas(write, "n bigint").agg(F.sum("n")).collect()
        summary = run(spark, os.path.join(root, "in"), out, CONFIG)
    return out, summary


_GUESS = ORACLES["guess_language"].removeprefix("SELECT doc_id, ").removesuffix(" AS lang FROM md_corpus")
_RSTRIP = lambda x: f"regexp_replace({x}, {q(rf'[{E.WSN}]+' + chr(92) + 'z')}, '')"
_FILES = f"""files AS (SELECT doc_id, body AS content, {_CODE('body')} AS code, {_GUESS} AS lang FROM md_corpus),
drafts AS (SELECT doc_id, code, content, CASE WHEN code AND lang <> 'text' THEN '```' || lang || chr(10) || {_RSTRIP('content')} || chr(10) || '```' WHEN code OR ends_with(content, chr(10)) THEN content ELSE content || chr(10) END AS raw FROM files),
named AS (SELECT doc_id, raw, CASE WHEN NOT code THEN {_strip("substr(list_filter(list_transform(string_split(content, chr(10)), lambda x: " + _strip('x') + "), lambda x: starts_with(x, '# '))[1], 3)")} END AS said FROM drafts),
made AS (SELECT doc_id, CASE WHEN said IS NOT NULL AND NOT {_GENERIC('said')} THEN said ELSE doc_id::VARCHAR END AS title, {_boilerplate(_clean('raw'))} AS body FROM named)"""
_KB_CLASSED = f"""kb_classed AS (SELECT doc_id, title, body, coalesce(m, k, 'unclassified') AS c FROM (SELECT doc_id, title, body, {_MAP} AS m, {_KEY} AS k FROM (SELECT doc_id, title, body, doc_id || '.md' AS name, lower(doc_id || '.md' || chr(10) || title || chr(10) || substr(body, 1, {E.TEXT_LENGTH})) AS t FROM made)))"""
_KB_SUMMARY = _SUMMARY_SQL.removeprefix("WITH ").replace("md_corpus", "made")
_KB = f"""WITH {_FILES}, {_KB_CLASSED}, said AS (WITH {_KB_SUMMARY}),
kb AS (SELECT c.doc_id || '.md' AS relpath, c.title, {_VALID} AS category, CASE WHEN s.summary <> '' THEN s.summary WHEN len({_ROWS}) > 0 THEN '（表格文档：约 ' || greatest(0, len({_ROWS}) - 2 * len(list_filter({_ROWS}, lambda l: regexp_matches({_strip('l')}, {_RULE})))) || ' 行数据，详见正文表格）' ELSE '' END AS summary FROM kb_classed c JOIN said s USING (doc_id))"""


@query(f"{_KB} SELECT relpath, 'doc-' || substr(sha256(relpath), 1, 8) AS id, title, category, summary, 'docs/' || category || '/doc-' || substr(sha256(relpath), 1, 8) || '.md' AS doc_path FROM kb")
def knowledge_base(spark, sf):
    """The whole job over files of all bodies: what its manifest says of each."""
    from leafmill.plans.pipeline import State

    out, _ = _built(spark, sf)
    return State(spark, out).load().select("relpath", "id", "title", "category", "summary", "doc_path")


@query(f"{_KB} SELECT relpath, title, category, 'original-doc/' || relpath AS source, 'docs/' || category || '/doc-' || substr(sha256(relpath), 1, 8) || '.md' AS path FROM kb")
def knowledge_base_files(spark, sf):
    """The documents that the job wrote, by the front matter that stands in them, with the place where each was found."""
    import os

    out, _ = _built(spark, sf)
    docs = os.path.join(out, "docs")
    found = spark.read.format("doctree").option("path", docs).load().select("relpath").where(F.col("relpath").rlike(r"\A[^/]+/[^/]+\.md\z"))

    def head(batches):
        from itertools import takewhile

        import pandas as pd
        import yaml

        for b in batches:
            rows = []
            for path in b["relpath"]:
                with open(os.path.join(docs, path), encoding="utf-8", newline="\n") as f:
                    f.readline()
                    h = yaml.load("".join(takewhile(lambda x: x != "---\n", f)), Loader=getattr(yaml, "CSafeLoader", yaml.SafeLoader))
                rows.append({"relpath": h["source"].removeprefix("original-doc/"), "title": h["title"], "category": h["category"], "source": h["source"], "path": "docs/" + path})
            if rows:
                yield pd.DataFrame(rows)

    return found.mapInPandas(head, "relpath string, title string, category string, source string, path string")


@query("SELECT count(*) FILTER (WHERE doc_id % 7 = 1) AS processed, count(*) FILTER (WHERE doc_id % 7 > 1) AS skipped, count(*) FILTER (WHERE doc_id % 7 = 0) AS purged, count(*) FILTER (WHERE doc_id % 7 > 0) AS entries, count(*) FILTER (WHERE doc_id % 7 > 0) AS files, 0 AS errors FROM md_corpus")
def knowledge_base_again(spark, sf):
    """Counters of a second run over the same folder, and what is left of entries and files."""
    import glob

    from leafmill.plans.pipeline import State

    out, s = _built(spark, sf, again=True)
    row = (s.processed, s.skipped, s.purged, State(spark, out).load().count(), len(glob.glob(f"{out}/docs/*/*.md")), s.errors)
    return spark.createDataFrame([row], "processed bigint, skipped bigint, purged bigint, entries bigint, files bigint, errors int")
