"""Drafts to documents: which blocks stay, how they read in Markdown, which title is taken, what is left to do. All in Column expressions, one row a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import text as T
from leafmill.operators import assets as A
from leafmill.operators.defer import marker

ITEM = "struct<type:string,count:bigint,note:string,loc:string,cls:string,unit:string>"


def kept(blocks: Column) -> Column:
    """Without prompts of empty fields, and without heads that nothing follows."""
    full = F.filter(blocks, lambda b: ~(b["prompt"] & T.is_placeholder(b["text"])))
    return F.filter(full, lambda b: (b["kind"] != "head") | F.exists(full, lambda x: (x["kind"] != "head") & (x["part"] == b["part"])))


def with_class(blocks: Column, assets: Column) -> Column:
    """Pictures get the class that their stored bytes and name tell."""

    def one(b: Column) -> Column:
        mine = F.get(F.filter(assets, lambda a: a["dest"] == b["dest"]), F.lit(0))
        cls = A.image_class(mine["blob"], b["dest"])
        return F.when(b["kind"].isin("picture", "scan") & (b["type"] == "image-ocr"), b.withField("cls", F.when(cls != "", cls))).otherwise(b)

    return F.transform(blocks, one)


def markdown(b: Column, doc_id: Column, stored: bool) -> Column:
    """One block. Without storage a picture is work for a later stage."""
    said = F.coalesce(b["text"], F.lit(""))
    work = marker(b["type"], b["count"], b["note"], b["unit"], b["cls"])
    path = F.concat(F.lit("](../../original-doc/"), doc_id, F.lit("_assets/"), b["dest"], F.lit(")\n\n"))
    spot = lambda kind: F.concat(F.lit("<!-- ocr:"), kind, F.lit(":"), b["dest"], F.lit(" -->"))
    out = F.when(b["kind"] == "table", T.markdown_table(b["rows"])).when(b["kind"] == "work", work).when(b["kind"] == "slide", F.concat(b["prefix"], F.when(T.is_placeholder(b["text"]), F.lit("")).otherwise(F.concat(F.lit(": "), said))))
    if stored:
        scan = F.concat(F.when(b["prefix"] == "scan", F.concat(F.lit("![扫描页"), path)).otherwise(F.lit("")), spot(b["prefix"]))
        out = out.when(b["kind"] == "picture", F.concat(F.lit("!["), said, path, spot(F.lit("img")))).when(b["kind"] == "scan", scan)
    else:
        out = out.when(b["kind"].isin("picture", "scan"), work)
    return out.otherwise(F.concat(b["prefix"], said))


def title_of(titles: Column, in_body: Column, stem: Column, body: Column) -> Column:
    """The first candidate that is no prompt, no generic title and, where that is asked for, stands in the body; else the stem."""
    fit = F.filter(titles, lambda t: ~(t["prompt"] & T.is_placeholder(t["text"])) & ~T.is_generic_title(t["text"]) & (~in_body | T.title_in_body(T.strip(t["text"]), body)))
    return F.coalesce(T.strip(F.get(fit, F.lit(0))["text"]), stem)


def left_to_do(blocks: Column, stored: bool) -> Column:
    kinds = ("work",) if stored else ("work", "picture", "scan")
    return F.transform(F.filter(blocks, lambda b: b["kind"].isin(*kinds)), lambda b: F.struct(b["type"].alias("type"), b["count"].alias("count"), F.coalesce(b["note"], F.lit("")).alias("note"), b["loc"].alias("loc"), b["cls"].alias("cls"), b["unit"].alias("unit")))


def rendered(drafts: DataFrame, stored: bool = True) -> DataFrame:
    """drafts with relpath, id and the parsed columns -> (relpath, id, title, body, tags, deferred, assets, error)."""
    d = drafts.withColumn("blocks", with_class(kept(F.col("blocks")), F.col("assets")))
    parts = F.filter(F.transform("blocks", lambda b: markdown(b, F.col("id"), stored)), lambda x: x != "")
    d = d.withColumn("joined", F.array_join(parts, "\n\n")).withColumn("body", F.when(F.col("joined") == "", F.col("if_empty")).otherwise(F.col("joined")))
    title = title_of(F.col("titles"), F.col("title_in_body"), T.stem(F.col("relpath")), F.col("body"))
    assets = F.col("assets") if stored else F.slice("assets", F.lit(1), F.lit(0))
    return d.select("relpath", "id", title.alias("title"), "body", F.array().cast("array<string>").alias("tags"), left_to_do(F.col("blocks"), stored).cast(f"array<{ITEM}>").alias("deferred"), assets.alias("assets"), "error")
