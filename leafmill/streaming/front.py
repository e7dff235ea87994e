"""Structured Streaming front end (an extension): new texts are cleaned and summarised as they arrive.

A file source sees new files only, never changed or deleted ones; the manifest diff stays the authority for those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafmill.functions import text as T


def arrivals(spark: SparkSession, folder: str, schema: str, late: str = "2 days") -> DataFrame:
    """Deferred items as a stream, each delivery once: repeated deliveries within `late` are dropped by (doc_no, pos)."""
    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.withColumn("received_at", F.col("received_at").cast("timestamp")).withWatermark("received_at", late).dropDuplicatesWithinWatermark(["doc_no", "pos"])


def backlog(items: DataFrame, every: str = "1 hour") -> DataFrame:
    """Items by type and hour of arrival; an hour is final once the watermark has passed it."""
    return items.groupBy(F.window("received_at", every).alias("w"), "type").agg(F.sum("cnt").alias("n")).select(F.col("w.start").alias("hour"), "type", "n")


def summarise(texts: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """(doc_id, body) to (doc_id, summary) files, all that is there, then stop."""
    out = texts.select("doc_id", T.summary(T.strip_boilerplate(T.clean_text(F.col("body")))).alias("summary"))
    return out.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
