"""Queries of the training-data problems; each runs over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import p01_scans, p02_markup, p03_subjects, p04_near_copies, p05_lookalikes, p06_residue, p07_encoding, p08_tokens, p09_leaks, p10_personal
from .common import fields, table

Query = Callable[[SparkSession, str], DataFrame]


def _fields(spark: SparkSession, sf: str, null_texts: bool = False) -> DataFrame:
    return fields(table(spark, sf, "md_corpus"), table(spark, sf, "front_matter"), null_texts)


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return p01_scans.scan(table(spark, sf, "md_corpus")).select("doc_id", F.explode("defects").alias("defect")).distinct()


def p1_text(spark: SparkSession, sf: str) -> DataFrame:
    """Every record, repaired where it is from scanned pages."""
    return p01_scans.scan(table(spark, sf, "md_corpus"), every=True).select("doc_id", "repaired")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return p02_markup.decode(table(spark, sf, "md_corpus")).select("doc_id", F.explode("markup").alias("markup")).distinct()


def p2_text(spark: SparkSession, sf: str) -> DataFrame:
    """Every record, in clean text where it uses markup."""
    return p02_markup.decode(table(spark, sf, "md_corpus"), text=True).select("doc_id", "cleaned")


_FITTED: dict[tuple[str, str], tuple[p06_residue.Model, dict[str, float]]] = {}


def _residue(spark: SparkSession, sf: str) -> tuple[p06_residue.Model, dict[str, float]]:
    """The model of problem 6 and its figures on unseen hosts, fitted once for an application and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        _FITTED.clear()
        _FITTED[key] = p06_residue.train(table(spark, sf, "md_corpus"), table(spark, sf, "front_matter"))
    return _FITTED[key]


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return p03_subjects.subjects_of(
        table(spark, sf, "md_corpus"), table(spark, sf, "front_matter"), table(spark, sf, "subject_samples"), table(spark, sf, "subjects"), _residue(spark, sf)[0]
    )


def p3_share(spark: SparkSession, sf: str) -> DataFrame:
    return p03_subjects.composition(p3_found(spark, sf), table(spark, sf, "md_corpus"), table(spark, sf, "subjects"))


def p3_categories(spark: SparkSession, sf: str) -> DataFrame:
    return p03_subjects.category_subjects(p3_found(spark, sf), table(spark, sf, "front_matter"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return p04_near_copies.pairs(table(spark, sf, "md_corpus"))


def p4_groups(spark: SparkSession, sf: str) -> DataFrame:
    return p04_near_copies.groups(table(spark, sf, "md_corpus"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return p05_lookalikes.find(_fields(spark, sf)).distinct()


def p5_forms(spark: SparkSession, sf: str) -> DataFrame:
    return p05_lookalikes.groups(p05_lookalikes.normalise(_fields(spark, sf)))


def p5_text(spark: SparkSession, sf: str) -> DataFrame:
    """Every body and title in its one form."""
    return p05_lookalikes.normalise(_fields(spark, sf, True)).select("doc_id", "field", "normal")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return p06_residue.find(_fields(spark, sf), _residue(spark, sf)[0]).distinct()


def p6_unseen(spark: SparkSession, sf: str) -> DataFrame:
    """Figures of the classifier on hosts that it has not seen: (figure, value)."""
    return spark.createDataFrame(sorted(_residue(spark, sf)[1].items()), "figure string, value double")


def p6_kept(spark: SparkSession, sf: str) -> DataFrame:
    """What the exclusion leaves: records whose body is no case, and whether a title of theirs is kept (all of a residue title is left out)."""
    found = p6_found(spark, sf)
    cases = lambda field: found.where(F.col("field") == field).select("doc_id")
    titles = cases("title").withColumn("residue", F.lit(True))
    left = table(spark, sf, "md_corpus").select("doc_id").join(cases("body"), "doc_id", "left_anti")
    return left.join(titles, "doc_id", "left").select("doc_id", F.col("residue").isNull().alias("title_kept"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return p07_encoding.repair(_fields(spark, sf)).select("doc_id", "field").distinct()


def p7_text(spark: SparkSession, sf: str) -> DataFrame:
    """Every body and title, restored where it was wrongly decoded."""
    return p07_encoding.repair(_fields(spark, sf, True), every=True)


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    return p08_tokens.encode(table(spark, sf, "documents"))


def p8_empty(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose list of ids is empty: null and empty texts, and no others."""
    ids = p8_ids(spark, sf)
    return ids.where(F.size("ids") == 0).select("doc_id", F.size("ids").cast("bigint").alias("n"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return p09_leaks.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def p9_items(spark: SparkSession, sf: str) -> DataFrame:
    """Test items by the number of documents that hold a passage of them."""
    return p9_found(spark, sf).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return p10_personal.find(table(spark, sf, "documents")).distinct()


def p10_text(spark: SparkSession, sf: str) -> DataFrame:
    return p10_personal.redact(table(spark, sf, "documents"))


_ALL = (
    p1_found, p1_text, p2_found, p2_text, p3_found, p3_share, p3_categories, p4_found, p4_groups, p5_found, p5_forms, p5_text,
    p6_found, p6_kept, p6_unseen, p7_found, p7_text, p8_ids, p8_empty, p9_found, p9_items, p10_found, p10_text,
)
QUERIES: dict[str, Query] = {f.__name__: f for f in _ALL}

# SQL by brute force, where the results can be said in it at all.
_REDUCED = r"replace(lower(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')), 'ß', 'ss')"
_LEAKS = rf"""items AS (SELECT item_id, r, CASE WHEN length(regexp_replace(r, '[^\x{{4e00}}-\x{{9fff}}]', '', 'g')) * 3 > length(r) THEN 20 ELSE 60 END AS run FROM (SELECT item_id, {_REDUCED} AS r FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL)),
passages AS (SELECT DISTINCT item_id, substr(r, i, run) AS g FROM items, unnest(range(1, length(r) - run + 2)) AS t(i)),
docs AS (SELECT doc_id, {_REDUCED} AS r FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
held AS (SELECT DISTINCT doc_id, substr(r, i, n) AS g FROM docs, (VALUES (20), (60)) AS k(n), unnest(range(1, length(r) - n + 2)) AS t(i)),
leaks AS (SELECT DISTINCT doc_id, item_id FROM held JOIN passages USING (g))"""
_SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_PAIRS = f"""texts AS (SELECT doc_id, r FROM (SELECT doc_id, regexp_replace(lower(body), '{_SPACES}', '', 'g') AS r FROM md_corpus) WHERE length(r) >= 400),
parts AS (SELECT DISTINCT doc_id, hash(substr(r, i, 10)) AS g FROM texts, unnest(range(1, length(r) - 8)) AS t(i)), sizes AS (SELECT doc_id, count(*) AS n FROM parts GROUP BY doc_id),
common AS (SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b, count(*) AS n FROM parts a JOIN parts b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
pairs AS (SELECT doc_id_a, doc_id_b FROM common c JOIN sizes x ON x.doc_id = doc_id_a JOIN sizes y ON y.doc_id = doc_id_b WHERE c.n / (x.n + y.n - c.n) >= 0.6)"""
ORACLES: dict[str, str] = {
    "p4_found": f"WITH {_PAIRS} SELECT * FROM pairs",
    "p8_empty": "SELECT doc_id, 0::BIGINT AS n FROM documents WHERE text IS NULL OR text = ''",
    "p9_found": f"WITH {_LEAKS} SELECT * FROM leaks",
    "p9_items": f"WITH {_LEAKS} SELECT item_id, count(*) AS n_docs FROM leaks GROUP BY item_id",
}
