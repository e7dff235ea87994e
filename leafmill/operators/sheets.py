"""Spreadsheet cells as rows: formulas where no value is cached, merged spans, limits, rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import table_cell

# What a rendered sheet shows.
MAX_ROWS, MAX_COLUMNS = 2000, 100
#: A sheet is a part of a document; its name alone says little.
SHEET = ("doc", "sheet")
#: Rows of a band by which cells meet the spans that may cover them.
BAND = 256


def values(cells: DataFrame) -> DataFrame:
    """(doc, sheet, r, c, value, from_formula): the cached value, else the formula's own text."""
    shown = F.coalesce("cached", "formula")
    return cells.select(*SHEET, "r", "c", shown.alias("value"), (F.col("cached").isNull() & F.col("formula").isNotNull()).alias("from_formula"))


def fill_merged(shown: DataFrame, merges: DataFrame) -> DataFrame:
    """Empty cells of a merged span take the span's first value, however far the span reaches.

    merges: doc, sheet, r0, c0, r1, c1. An interval join by bands: a span is there once for each band of BAND rows that it touches, a cell in its own, so
    that the join is on equal keys and looks at the spans of a band only. Spans of a sheet do not overlap.
    """
    first = shown.select(*SHEET, F.col("r").alias("r0"), F.col("c").alias("c0"), F.col("value").alias("top")).where("top is not null")
    spans = merges.select(*SHEET, "r0", "c0", "r1", "c1").join(first, [*SHEET, "r0", "c0"])
    band = lambda c: F.floor(F.col(c) / BAND).cast("bigint")
    spread = spans.withColumn("band", F.explode(F.sequence(band("r0"), band("r1"))))
    bare = shown.where("value is null").withColumn("band", band("r"))
    s, t = bare.alias("s"), spread.alias("t")
    same = [F.col(f"s.{k}") == F.col(f"t.{k}") for k in (*SHEET, "band")]
    covered = s.join(t, [*same, F.col("s.r").between(F.col("t.r0"), F.col("t.r1")), F.col("s.c").between(F.col("t.c0"), F.col("t.c1"))], "left")
    filled = covered.select(*[F.coalesce("s.value", "t.top").alias(c) if c == "value" else F.col(f"s.{c}") for c in shown.columns])
    return shown.where("value is not null").unionByName(filled)


def limits(shown: DataFrame, max_rows: int = MAX_ROWS, max_columns: int = MAX_COLUMNS) -> DataFrame:
    """(doc, sheet, rows, columns, rows_cut, columns_cut, formula_cells): size of each sheet against the limits."""
    some = F.col("value").isNotNull() & (F.col("value") != "")
    return shown.groupBy(*SHEET).agg(
        F.coalesce(F.max("r"), F.lit(0)).alias("rows"),
        F.coalesce(F.max(F.when(some, F.col("c"))), F.lit(0)).alias("columns"),
        F.coalesce(F.max("r") > max_rows, F.lit(False)).alias("rows_cut"),
        F.coalesce(F.max(F.when(some, F.col("c"))) > max_columns, F.lit(False)).alias("columns_cut"),
        F.sum(F.col("from_formula").cast("bigint")).alias("formula_cells"),
    )


def rendered_rows(shown: DataFrame, max_rows: int = MAX_ROWS, max_columns: int = MAX_COLUMNS) -> DataFrame:
    """(doc, sheet, r, line): rows as Markdown lines, without trailing empty cells and empty rows, within the limits."""
    within = shown.where((F.col("r") <= max_rows) & (F.col("c") <= max_columns))
    some = F.coalesce("value", F.lit("")) != ""
    width = within.where(some).groupBy(*SHEET).agg(F.max("c").alias("width"))
    cell = F.map_from_entries(F.collect_list(F.struct(F.col("c").cast("int"), table_cell(F.coalesce("value", F.lit("")))))).alias("cells")
    rows = within.groupBy(*SHEET, "r").agg(cell, F.max(some.cast("int")).alias("any")).where("any = 1")
    line = F.concat(F.lit("| "), F.array_join(F.transform(F.sequence(F.lit(1), F.col("width").cast("int")), lambda i: F.coalesce(F.try_element_at(F.col("cells"), i), F.lit(""))), " | "), F.lit(" |"))
    return rows.join(width, list(SHEET)).select(*SHEET, "r", line.alias("line"))

