"""Pictures of documents: names, classes, signatures, and the text that recognition gave for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leafmill.operators.defer import marker

VECTOR_EXTENSIONS = ("emf", "wmf", "svg", "emz", "wmz", "emfz")
# Why a picture has no text.
MISSING, UNREADABLE, NOT_RENDERED = "资产文件丢失", "资产文件读取失败", "矢量图无法渲染(需 Windows/ LibreOffice/Inkscape)"
#: Placeholder of a picture whose text is still to come: kind, name.
PLACEHOLDER = r"<!-- ocr:(img|scan):([^\s]+) -->"


def _hex(blob: Column, at: int, n: int) -> Column:
    return F.hex(F.substring(blob, at, n))


def last_extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"([^.]*)\z", 1))


def signature(blob: Column) -> Column:
    """Format by the first bytes, null where none is known; the name plays no part."""
    h = lambda n, at=1: _hex(blob, at, n)
    return (
        F.when(F.length(blob) == 0, "empty")
        .when((h(2) == "504B") & h(2, 3).isin("0304", "0506", "0708"), "zip")
        .when(h(8) == "D0CF11E0A1B11AE1", "ole2")
        .when(h(4) == "25504446", "pdf")
        .when(h(8) == "89504E470D0A1A0A", "png")
        .when(h(3) == "FFD8FF", "jpeg")
        .when(h(6).isin("474946383761", "474946383961"), "gif")
        .when((h(4) == "52494646") & (h(4, 9) == "57454250"), "webp")
        .when(h(4).isin("49492A00", "4D4D002A"), "tiff")
        .when(h(2) == "424D", "bmp")
        .when(h(4) == "D7CDC69A", "wmf")
        .when((h(4) == "01000000") & (h(4, 41) == "20454D46"), "emf")
    )


HANDLERS = {"pdf": "pdf", "png": "image", "jpeg": "image", "gif": "image", "webp": "image", "tiff": "image", "bmp": "image", "wmf": "image", "emf": "image", "docx": "docx", "xlsx": "xlsx", "pptx": "pptx", "md": "md", "code": "text", "txt": "text"}


def handler(format_: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in HANDLERS.items() for x in kv]), format_)


def image_class(blob: Column, name: Column, filter_: Column | None = None) -> Column:
    """diagram, photo, screenshot or an empty string, by the few signals that tell."""
    e = last_extension(F.coalesce(name, F.lit("")))
    f = F.coalesce(filter_, F.lit("")) if filter_ is not None else F.lit("")
    return (
        F.when(F.coalesce(name, F.lit("")).rlike(r"(?i)(?:\A|[^\p{L}\p{N}])vec(?:[^\p{L}\p{N}]|\z)") | e.isin("svg", "emf", "wmf") | (_hex(blob, 1, 4) == "01000000"), "diagram")
        .when(e.isin("jpg", "jpeg") | (_hex(blob, 1, 3) == "FFD8FF") | f.rlike("DCT|JPX"), "photo")
        .when(e.isin("png", "gif", "bmp", "tif", "tiff", "webp"), "screenshot")
        .otherwise("")
    )


def vector_extension(blob: Column, name: Column) -> Column:
    """Real kind of a vector picture: its signature, else its extension; null if it is none."""
    e = last_extension(F.coalesce(name, F.lit("")))
    by_sign = (
        F.when(_hex(blob, 1, 4) == "D7CDC69A", "wmf").when((_hex(blob, 1, 4) == "01000000") & (F.length(blob) > 44) & (_hex(blob, 41, 4) == "20454D46"), "emf").when((_hex(blob, 1, 5) == "3C3F786D6C") | (_hex(blob, 1, 4) == "3C737667"), "svg")
    )
    return F.coalesce(by_sign, F.when(e.isin(*VECTOR_EXTENSIONS), e))


def destination(seq: Column, kind: Column, ext: Column | str = "png") -> Column:
    return F.concat(F.lpad(seq.cast("string"), 2, "0"), F.lit("_"), kind, F.lit("."), F.lit(ext) if isinstance(ext, str) else ext)


def numbered(assets: DataFrame, order: str) -> DataFrame:
    """Assets with a running number within their document."""
    return assets.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy(order)).cast("bigint"))


def resolution(kind: Column, text: Column, present: Column, cls: Column, vector: Column | None = None, readable: Column | None = None) -> Column:
    """What takes a placeholder's place: the text in a fence, or a marker that says why there is none; cls is the picture's class."""
    there, said = F.coalesce(present, F.lit(False)), F.coalesce(text, F.lit(""))
    reason = F.when(~there, MISSING)
    if readable is not None:
        reason = reason.when(~readable, UNREADABLE)
    if vector is not None:
        reason = reason.when(vector, NOT_RENDERED)
    type_ = F.when(kind == "scan", "scan-page").otherwise("image-ocr")
    return F.when(there & (said != ""), F.concat(F.lit("```\n"), said, F.lit("\n```"))).otherwise(marker(type_, F.lit(1), reason, F.lit(None).cast("string"), cls))


def resolve_placeholders(bodies: DataFrame, recognised: DataFrame, key: str = "doc_id") -> DataFrame:
    """bodies (key, body) with every placeholder replaced by recognised (key, dest, replacement); key is the document's identity.

    A placeholder without a row becomes a marker of a lost asset. Pieces between placeholders keep their order by position.
    """
    with_any = bodies.where(F.col("body").rlike(PLACEHOLDER))
    names = F.regexp_extract_all("body", F.lit(PLACEHOLDER), F.lit(2))
    kinds = F.regexp_extract_all("body", F.lit(PLACEHOLDER), F.lit(1))
    pieces = F.split("body", r"<!-- ocr:(?:img|scan):[^\s]+ -->", -1)
    jobs = with_any.select(key, F.posexplode(F.arrays_zip(names.alias("dest"), kinds.alias("kind"))).alias("pos", "job")).select(key, "pos", "job.dest", "job.kind")
    none = F.lit(None).cast("string")
    lost = marker(F.when(F.col("kind") == "scan", "scan-page").otherwise("image-ocr"), F.lit(1), F.lit(MISSING), none, none)
    done = jobs.join(recognised.select(key, "dest", "replacement"), [key, "dest"], "left").withColumn("replacement", F.coalesce("replacement", lost))
    per = done.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "replacement"))), lambda s: s["replacement"]).alias("given"))
    text = F.array_join(F.zip_with(F.col("pieces"), F.concat(F.col("given"), F.array(F.lit(""))), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return with_any.select(key, pieces.alias("pieces")).join(per, key).select(key, text.alias("body")).unionByName(bodies.where(~F.col("body").rlike(PLACEHOLDER)).select(key, "body"))
