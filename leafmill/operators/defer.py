"""Algebra of deferred work: markers in texts, aggregation by document and type, the contract, the pending list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import WSN

# The types that parsers may defer.
TYPES = ("image-ocr", "inline-image", "scan-page", "formula", "chart", "formula-cell", "truncated", "encrypted", "unsupported", "parse-failed")
#: type, count, modifiers, note of a marker.
MARKER = rf"<!-- stage2:([\p{{L}}\p{{N}}_-]+)=(\p{{Nd}}+)((?:[{WSN}]+[\p{{L}}\p{{N}}_]+=[\p{{L}}\p{{N}}_-]+)*)(?:[{WSN}]+(.*?))? -->"


def marker(type_: Column, count: Column, note: Column, unit: Column, cls: Column) -> Column:
    """The marker that stands in the text; empty and null parts are left out, the note cannot close the comment."""
    full = lambda c, p: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(p), c))
    safe = F.trim(F.regexp_replace(F.replace(F.coalesce(note, F.lit("")), F.lit("-->"), F.lit("")), r"[\r\n]+", " "))
    return F.concat_ws(" ", F.concat(F.lit("<!-- stage2:"), type_, F.lit("="), count.cast("string")), full(unit, "unit="), full(cls, "class="), full(safe, ""), F.lit("-->"))


def items_once(deferred: DataFrame) -> DataFrame:
    """Items without repeated deliveries: pos is unique but for them. The delivery received first stands as a whole; equal times go by its content."""
    what = ("type", "cnt", "note", "loc", "unit", "cls")
    first = deferred.groupBy("doc_no", "pos").agg(F.min(F.struct(F.col("received_at").isNull().alias("late"), "received_at", *what)).alias("d"))
    return first.select("doc_no", "pos", *[F.col(f"d.{c}").alias(c) for c in what])


def aggregate(items: DataFrame) -> DataFrame:
    """(doc_no, type, first_pos, cnt, note, unit, cls, locs): one row for each document and type.

    cnt sums; note, unit and cls are the first that is not empty by pos; locs are distinct, in order of their first pos.
    Two steps keep a hot document whole and spread: first by place, with partial aggregation, then over the few distinct places.
    """
    say = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    first = lambda c: F.min_by(F.struct(F.col(c).alias("v"), F.col("pos").alias("p")), F.when(say(c), F.col("pos")))
    by_place = items.groupBy("doc_no", "type", "loc").agg(F.sum("cnt").alias("cnt"), F.min("pos").alias("pos"), *[first(c).alias(c) for c in ("note", "unit", "cls")])
    pick = lambda c: F.min_by(F.col(f"{c}.v"), F.when(F.coalesce(F.col(f"{c}.v"), F.lit("")) != "", F.col(f"{c}.p"))).alias(c)
    places = F.array_sort(F.collect_list(F.when(say("loc"), F.struct(F.col("pos").alias("p"), F.col("loc").alias("l")))))
    return by_place.groupBy("doc_no", "type").agg(F.min("pos").alias("first_pos"), F.sum("cnt").alias("cnt"), pick("note"), pick("unit"), pick("cls"), F.transform(places, lambda s: s["l"]).alias("locs"))


def extract_markers(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, type, cnt, modifiers, note) of every marker in a text, in order."""
    part = lambda g: F.regexp_extract_all(text, F.lit(MARKER), F.lit(g))
    found = texts.where(F.contains(F.col(text), F.lit("<!-- stage2:"))).select(key, F.posexplode(F.arrays_zip(part(1).alias("t"), part(2).alias("n"), part(3).alias("m"), part(4).alias("o"))).alias("pos", "x"))
    return found.select(key, F.col("pos").cast("bigint"), F.col("x.t").alias("type"), F.col("x.n").cast("bigint").alias("cnt"), F.trim(F.col("x.m")).alias("modifiers"), F.coalesce("x.o", F.lit("")).alias("note"))


def contract_difference(types: DataFrame) -> DataFrame:
    """(type, side): types used without a contract, and contracts without use."""
    known = types.sparkSession.createDataFrame([(t,) for t in TYPES], "type string")
    used = types.select("type").where("type is not null").distinct()
    return used.subtract(known).withColumn("side", F.lit("used only")).unionAll(known.subtract(used).withColumn("side", F.lit("contract only")))


def pending(documents: DataFrame, aggregated: DataFrame) -> DataFrame:
    """Documents with deferred work, with the number of types and items left."""
    left = aggregated.groupBy("doc_no").agg(F.count(F.lit(1)).alias("n_types"), F.sum("cnt").alias("n_items"))
    return documents.join(left, documents["doc_id"] == left["doc_no"]).drop("doc_no")


def resolve(texts: DataFrame, key: str, text: str, results: DataFrame) -> DataFrame:
    """Texts whose markers are replaced by results (key, pos, result), pos counting the markers of a text; others stay."""
    given = results.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(F.col("pos").cast("int"), "result"))).alias("given"))
    whole = F.regexp_extract_all(text, F.lit(MARKER), F.lit(0))
    joined = texts.join(given, key, "left").withColumn("found", whole)

    def step(a: Column, m: Column) -> Column:
        before = F.substring(a["rest"], F.lit(1), F.position(m, a["rest"]) - 1)
        mine = F.coalesce(F.try_element_at(F.col("given"), a["i"]), m)
        rest = F.substring(a["rest"], F.length(before) + F.length(m) + 1, F.length(a["rest"]))
        return F.struct(F.concat(a["done"], before, mine).alias("done"), rest.alias("rest"), (a["i"] + 1).alias("i"))

    start = F.struct(F.lit("").alias("done"), F.col(text).alias("rest"), F.lit(0).alias("i"))
    out = F.aggregate(F.col("found"), start, step, lambda a: F.concat(a["done"], a["rest"]))
    return joined.withColumn(text, F.when(F.col("given").isNull() | (F.size("found") == 0), F.col(text)).otherwise(out)).drop("given", "found")

