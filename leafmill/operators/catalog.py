"""Navigation over a knowledge base: entries, categories, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# What a search for the input directory counts and leaves out.
DOCUMENT_EXTENSIONS = (".pptx", ".docx", ".xlsx", ".pdf", ".png", ".jpg", ".jpeg", ".md", ".txt", ".ppt", ".doc", ".xls", ".c", ".h", ".py", ".sh", ".cmake", ".yaml", ".yml")
EXCLUDED_DIRECTORIES = ("knowledge", "output", "out", "build", "dist", "__pycache__", ".git", "node_modules", ".venv", "venv")
MOST_COUNTED = 201


def latest_entries(front_matter: DataFrame) -> DataFrame:
    """One entry for each document: the one written last; equal times go by id and title."""
    w = Window.partitionBy("doc_id").orderBy(F.col("written_at").desc_nulls_last(), "id", "title")
    return front_matter.where("doc_id is not null").withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def categories(entries: DataFrame) -> DataFrame:
    """(category, id): the ids of each category, one row each, so that a category of any size is no one row. Equal ids keep a row each."""
    return entries.select("category", "id")


def by_type(entries: DataFrame) -> DataFrame:
    return entries.groupBy("category", "source_type").agg(F.count(F.lit(1)).alias("n"))


def input_directories(files: DataFrame, top: int = 1) -> DataFrame:
    """(top_dir, n): first-level directories by documents they hold, counts end at MOST_COUNTED; the most, then the name, decides."""
    from leafmill.functions.text import extension

    first = F.regexp_extract("relpath", r"\A([^/]+)/", 1)
    wanted = files.select(first.alias("top_dir"), extension(F.col("relpath")).alias("e")).where((F.col("top_dir") != "") & ~F.lower("top_dir").isin(*EXCLUDED_DIRECTORIES) & ~F.col("top_dir").startswith(".") & F.col("e").isin(*DOCUMENT_EXTENSIONS))
    n = wanted.groupBy("top_dir").agg(F.least(F.count(F.lit(1)), F.lit(MOST_COUNTED)).cast("bigint").alias("n"))
    return n.orderBy(F.desc("n"), "top_dir").limit(top)
