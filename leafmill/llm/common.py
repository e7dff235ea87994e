"""Shared plumbing: tables, Arrow batch mapping, cluster-safe checkpoints."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

#: Rows handed to one call of a batch function; texts may be long, so a batch of Arrow rows is worked off in slices.
SLICE_ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, make: Callable[[], Callable[..., Iterator[tuple]]], schema: str, rows: int = SLICE_ROWS) -> DataFrame:
    """Map df batch by batch in Python workers over Arrow.

    make() runs once a task and returns f(*columns) that yields output tuples; columns are Python lists of at most `rows` values.
    """
    struct = _parse_datatype_string(schema)
    assert isinstance(struct, StructType)
    names = struct.fieldNames()
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = f(*(c.to_pylist() for c in part.columns))
                while chunk := list(islice(out, 20_000)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*chunk), arrow.types, strict=True)], names=names)

    return df.mapInArrow(run, struct)


def fields(md_corpus: DataFrame, front_matter: DataFrame, null_texts: bool = False) -> DataFrame:
    """(doc_id, field, text): bodies and titles, one row each; repeated rows stay. Without null_texts, rows without a text or a key are left out."""
    body = md_corpus.select(F.col("doc_id"), F.lit("body").alias("field"), F.col("body").alias("text"))
    title = front_matter.select(F.col("doc_id"), F.lit("title").alias("field"), F.col("title").alias("text"))
    both = body.unionAll(title)
    return both if null_texts else both.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull())


def sample_keys(df: DataFrame, rows: int, salt: int, key: str = "doc_id") -> DataFrame:
    """The `rows` keys of least hash, as a frame small enough for any broadcast: a sample that does not depend on partitions; only the key column is read."""
    spark = df.sparkSession
    least = df.where(F.col(key).isNotNull()).select(key, F.xxhash64(F.col(key), F.lit(salt)).alias("h")).orderBy("h", key).limit(rows).select(key)
    return F.broadcast(spark.createDataFrame([tuple(r) for r in least.collect()], least.schema))


def shared_dir(spark: SparkSession) -> None:
    """Make sure checkpoint() has a folder; the cluster's own setting always wins."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        set_by_cluster = spark.conf.get("spark.checkpoint.dir", None)
        if set_by_cluster is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            import tempfile

            set_by_cluster = tempfile.mkdtemp(prefix="leafmill-checkpoint-")
        sc.setCheckpointDir(set_by_cluster)
