"""Page geometry: repeated blocks across pages, blocks within tables, cells put together from words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BOX = ("x0", "y0", "x1", "y1")


def repeated_blocks(blocks: DataFrame, share: float = 0.6, least: int = 3) -> DataFrame:
    """(doc, text, rx0..ry1, n_pages): text and rounded box on at least max(least, share of the pages) pages of the document.

    Pages are counted before the shuffle, once for each key and page; boxes are rounded half to even.
    """
    norm = F.trim(F.regexp_replace("text", r"\s+", " "))
    keyed = blocks.select("doc", "page", norm.alias("text"), *[F.bround(c, 0).cast("bigint").alias("r" + c) for c in BOX]).where("text <> ''")
    pages = blocks.select("doc", "page").distinct().groupBy("doc").agg(F.count(F.lit(1)).alias("pages"))
    key = ["doc", "text", *("r" + c for c in BOX)]
    seen = keyed.distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("n_pages"))
    return seen.join(pages, "doc").where((F.col("n_pages") >= least) & (F.col("n_pages") >= share * F.col("pages"))).drop("pages")


def without_repeated(blocks: DataFrame, repeated: DataFrame) -> DataFrame:
    norm = F.trim(F.regexp_replace("text", r"\s+", " "))
    b = blocks.withColumn("_t", norm)
    on = [b["doc"] == repeated["doc"], b["_t"] == repeated["text"], *[F.bround(b[c], 0).cast("bigint") == repeated["r" + c] for c in BOX]]
    return b.join(repeated, on, "left_anti").drop("_t")


def outside_tables(blocks: DataFrame, tables: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """Blocks that lie in no table of their page: an anti join on document and page with a containment condition."""
    t = tables.select(F.col("doc").alias("tdoc"), F.col("page").alias("tpage"), *[F.col(c).alias("t" + c) for c in BOX])
    inside = (blocks["x0"] >= F.col("tx0") - tolerance) & (blocks["y0"] >= F.col("ty0") - tolerance) & (blocks["x1"] <= F.col("tx1") + tolerance) & (blocks["y1"] <= F.col("ty1") + tolerance)
    return blocks.join(t, (blocks["doc"] == F.col("tdoc")) & (blocks["page"] == F.col("tpage")) & inside, "left_anti")


def cell_lines(words: DataFrame, gap: float = 3.0) -> DataFrame:
    """(cell, line, text): words of a cell as lines. Words far taller than the cell's median are dropped as watermarks; a line ends where the
    step to the previous word exceeds the gap; words of a line go by x.

    words: cell, wid, x0, y0, y1, text. The median is the upper one, an aggregate with partial counts that is joined back. The lines take one sort of the words of
    a cell, on disk if need be; ties go by wid.
    """
    ordered = Window.partitionBy("cell").orderBy("y0", "x0", "wid")
    high = words.withColumn("h", F.col("y1") - F.col("y0"))
    middle = high.groupBy("cell").agg(F.expr("percentile_disc(0.500000000001) WITHIN GROUP (ORDER BY h)").alias("m"))  # just beyond a half: the upper of two
    kept = high.join(middle, "cell").where(F.col("h") <= F.least(F.lit(120.0), F.greatest(3.5 * F.col("m"), F.col("m") + 1)))
    starts = F.when(F.abs(F.col("y0") - F.lag("y0").over(ordered)) <= gap, 0).otherwise(1)
    lined = kept.withColumn("s", starts).withColumn("line", F.sum("s").over(ordered).cast("bigint"))
    in_line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "wid", "text"))), lambda w: w["text"]), " ")
    return lined.groupBy("cell", "line").agg(in_line.alias("text"))
