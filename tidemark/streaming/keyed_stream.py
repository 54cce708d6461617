"""The newest row per key, kept by the stream itself (ST1).

``land_stream`` lands files append-only, and the newest row per key is then an
aggregate over everything landed so far.  Here the stream keeps one row per
key in its state store: a micro-batch reads its own files and the keys they
touch, nothing else.  The keyed table is the state, read back with Spark's
state data source; a downstream job can take the changed keys of every
micro-batch instead.

What is newest is decided by (time of the micro-batch, modification time of
the file, its path).  The time of a micro-batch is in the stream's offset log,
so a micro-batch that is run again after a failure decides the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import nan_to_null, parse_period
from tidemark.sources.landing import row_fault
from tidemark.streaming.landing_stream import STREAM_RECORD_SCHEMA

KEY = ("metric", "entity", "period")
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def newest_rows(records: DataFrame) -> DataFrame:
    """(metric, entity, period, newest): the newest record per key.  Records
    that are no row of the raw table are left out, and counted by the
    observation ``landing``."""
    rows = records.select(
        "metric", F.col("economy").alias("entity"), parse_period("time").alias("period"),
        F.struct(F.current_timestamp().alias("landed_at"),
                 F.col("_metadata.file_modification_time").alias("modified_at"),
                 F.col("_metadata.file_path").alias("file"), nan_to_null("value").alias("value")).alias("row"),
        F.col("bad_line").isNotNull().alias("unreadable"))
    bad = F.col("unreadable") | row_fault().isNotNull()
    return (rows.observe("landing", F.count(F.lit(1)).alias("n_records"), F.count_if(bad).alias("n_rejected"))
            .filter(~bad).groupBy(*KEY).agg(F.max("row").alias("newest")))


def keep_newest(spark: SparkSession, in_dir: str, checkpoint: str, max_files_per_trigger: int | None = None,
                changed: Callable[[DataFrame, int], None] | None = None):
    """Take every new file in ``in_dir`` into the state kept in ``checkpoint``
    (a folder on shared storage) and return the finished query.

    ``changed`` gets the keys each micro-batch touched, as rows of
    ``newest_rows``, and the micro-batch's number; it may get one again after
    a failure.  State lies in RocksDB on the executors' disks, with its
    checkpoints in the shared folder, so it is not bounded by memory.
    """
    reader = (spark.readStream.schema(STREAM_RECORD_SCHEMA).option("columnNameOfCorruptRecord", "bad_line"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = newest_rows(reader.json(in_dir)).writeStream.outputMode("update")
    out = out.foreachBatch(changed) if changed else out.format("noop")
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        q = out.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(PROVIDER, before)
    q.awaitTermination()
    return q


def keyed_table(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(metric, entity, period, value, landed_at): the newest row per key
    after the last finished micro-batch."""
    newest = F.col("value.max")
    return (spark.read.format("statestore").load(checkpoint)
            .select(*[F.col("key")[k].alias(k) for k in KEY], newest["value"].alias("value"),
                    newest["landed_at"].alias("landed_at")))
