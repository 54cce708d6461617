"""Incremental landing of record files (ST1).

``readStream`` over a folder of JSON-lines record files; every micro-batch
is stamped with a batch id built from the micro-batch number (zero padded,
so ids sort) and appended to the raw table partitioned by ``batch_id``.
Lines that are no record, and records without metric, entity or readable
period, go to ``<raw path>_rejects`` with the reason.  Writes use dynamic
partition overwrite: if a micro-batch is replayed after a failure it replaces
its own partitions and nothing is counted twice.
The checkpoint folder must be shared storage (``spark.checkpoint.dir``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import params as P
from tidemark.functions.exprs import nan_to_null, parse_period
from tidemark.sources.landing import row_fault
from tidemark.sources.raw import append_batch

STREAM_RECORD_SCHEMA = "metric string, economy string, time string, value double, bad_line string"


def stream_batch_id(source: str, epoch: int) -> str:
    return f"{source.lower()}_{epoch:012d}"


def _writer(out_path: str, source: str):
    def write(batch: DataFrame, epoch: int) -> None:
        rows = batch.select(
            F.lit(source).alias("source"), F.col("metric"),
            F.col("economy").alias("entity"), parse_period("time").alias("period"),
            nan_to_null("value").alias("value"), F.current_timestamp().alias("ingested_at"),
            F.lit(stream_batch_id(source, epoch)).alias("batch_id"),
            F.coalesce("bad_line", F.to_json(F.struct("metric", "economy", "time", "value"))).alias("doc"),
            F.when(F.col("bad_line").isNotNull(), "unreadable line").alias("reject_reason"))
        rows = rows.withColumn("reject_reason", F.coalesce("reject_reason", row_fault()))
        append_batch(rows.filter(F.col("reject_reason").isNull()).select(*P.RAW_SCHEMA.names), out_path)
        (rows.filter(F.col("reject_reason").isNotNull())
         .select("source", "doc", "reject_reason", "ingested_at", "batch_id")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(rejects_path(out_path)))
    return write


def rejects_path(out_path: str) -> str:
    return out_path.rstrip("/") + "_rejects"


def land_stream(spark: SparkSession, in_dir: str, out_path: str, checkpoint: str,
                source: str = "STREAM", max_files_per_trigger: int | None = None):
    """Land every file present in ``in_dir`` (trigger availableNow) and
    return the finished query."""
    reader = (spark.readStream.schema(STREAM_RECORD_SCHEMA)
              .option("columnNameOfCorruptRecord", "bad_line"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.json(in_dir).writeStream
         .foreachBatch(_writer(out_path, source))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return q
