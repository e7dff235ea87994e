"""Incremental state: the diff of a scan against the manifest, and the manifest that follows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed(scan: DataFrame, content: str = "content") -> DataFrame:
    """(relpath, sha256, empty): what the diff needs of a scan; contents go no further."""
    return scan.select("relpath", F.sha2(F.col(content), 256).alias("sha256"), (F.length(content) == 0).alias("empty"))


def diff(previous: DataFrame, current: DataFrame) -> DataFrame:
    """(relpath, action, ord): new, changed, skip, empty or prune, by one full outer join on the path.

    previous: relpath, sha256, ord; current: relpath, sha256, empty. An empty file is never indexed, known or not.
    """
    p = previous.select("relpath", F.col("sha256").alias("old"), "ord")
    c = current.select("relpath", F.col("sha256").alias("new"), "empty")
    action = (
        F.when(F.col("new").isNull(), "prune").when(F.col("empty"), "empty").when(F.col("old").isNull(), "new").when(F.col("old") == F.col("new"), "skip").otherwise("changed")
    )
    return p.join(c, "relpath", "full_outer").select("relpath", action.alias("action"), "ord")


def unchanged(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Files of the scan that need no work: path and content known. Goes before every parser."""
    return current.join(previous.select("relpath", "sha256"), ["relpath", "sha256"], "left_semi")


def pruned(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Entries whose file is gone."""
    return previous.join(current.select("relpath"), "relpath", "left_anti")


def upsert(previous: DataFrame, entries: DataFrame) -> DataFrame:
    """The manifest with entries replaced or added by path; a replaced entry keeps its place, new ones follow in path order.

    entries carries no ord. Places of new entries come after the last one and rise with the path; ranges of paths are numbered apart, so no task sorts
    them all.
    """
    old = previous.select("relpath", "ord")
    merged = entries.join(old, "relpath", "left")
    known = merged.where("ord is not null")
    last = previous.agg(F.coalesce(F.max("ord"), F.lit(-1)).alias("last")).first()["last"]
    fresh = merged.where("ord is null").drop("ord")
    # places rise with the path over the range partitions; they need not be dense
    ranged = fresh.repartitionByRange("relpath").sortWithinPartitions("relpath").withColumn("k", F.monotonically_increasing_id())
    new = ranged.withColumn("ord", F.lit(last + 1) + F.col("k")).drop("k")
    kept = previous.join(entries.select("relpath"), "relpath", "left_anti")
    return kept.unionByName(known).unionByName(new)


def counts(actions: DataFrame) -> DataFrame:
    return actions.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def moved(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Old rendered paths that a new category leaves behind."""
    c = current.select("relpath", F.col("doc_path").alias("new_path"))
    return previous.select("relpath", "doc_path").join(c, "relpath").where("doc_path <> new_path").select("relpath", "doc_path")
