"""Append-only raw landing and staging (S1, S2, S6, S7, S13, S14, S16,
A1, J5, latest-per-key).

Raw lives as Parquet partitioned by ``batch_id`` (a string that sorts by
time).  Beside it lies a ledger with one row per source and batch, written
when the batch has landed, from what the writing job itself observed.  The
newest batch of each source comes from the ledger with an uncorrelated
scalar subquery; on the partition column the comparison becomes a partition
filter, so only the newest partitions' files are read, and no other.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import params as P

BATCH_TS_FORMAT = "yyyyMMdd'T'HHmmss'Z'"


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw table with its fixed schema; an absent path is an empty table.
    Spark's own reader decides what is absent, on whatever file system."""
    try:
        raw = spark.read.schema(P.RAW_SCHEMA).parquet(path)
        return raw.select(*P.RAW_SCHEMA.names)  # partition columns back in their places
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], P.RAW_SCHEMA)


def read_dim(spark: SparkSession, path: str, schema) -> DataFrame:
    """Seed dimension from CSV, read by the names of its header.  Columns of
    ``schema`` get its types, further attributes pass through as strings, and
    those the file lacks are left out; only the key (the first) must be there."""
    seed = spark.read.option("header", True).option("inferSchema", False).csv(path)
    key = schema.fields[0].name
    if key not in seed.columns:
        raise ValueError(f"seed {path} has no column {key}: {seed.columns}")
    known = [F.col(f.name).cast(f.dataType) for f in schema.fields if f.name in seed.columns]
    return seed.select(*known, *[c for c in seed.columns if c not in schema.names])


def batch_id_expr(source: str, ts=None):
    """``<source>_YYYYMMDDTHHMMSSZ`` of one UTC instant."""
    t = ts if ts is not None else F.current_timestamp()
    return F.concat(F.lit(f"{source.lower()}_"), F.date_format(t, BATCH_TS_FORMAT))


def stamp_batch(df: DataFrame, source: str, batch_id: str | None = None) -> DataFrame:
    """Add source, ingestion time and batch stamp.  ``current_timestamp``
    is one value per query, so every row of a write gets the same stamp."""
    bid = F.lit(batch_id) if batch_id else batch_id_expr(source)
    return (df.withColumn("source", F.lit(source))
            .withColumn("ingested_at", F.current_timestamp())
            .withColumn("batch_id", bid)
            .select(*[f.name for f in P.RAW_SCHEMA.fields]))


def append_batch(df: DataFrame, path: str) -> None:
    """Append-only landing, one partition per batch and metric.  A batch may
    land metric by metric; with dynamic partition overwrite a replay replaces
    only the metrics it brings again.  An empty DataFrame adds no partition.
    Rows are sorted by (entity, period) inside each partition so entity
    filters skip row groups; the sort leads with the partition columns, so
    the writer needs no sort of its own."""
    landed = Observation()
    (df.observe(landed, F.collect_set(F.struct("source", "batch_id")).alias("batches"))  # few batches a write
     .sortWithinPartitions("batch_id", "metric", "entity", "period")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id", "metric").parquet(path))
    if batches := landed.get["batches"]:
        (df.sparkSession.createDataFrame([tuple(b) for b in batches], LEDGER_SCHEMA).coalesce(1)
         .withColumn("landed_at", F.current_timestamp())
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("source", "batch_id").parquet(ledger_path(path)))


LEDGER_SCHEMA = "source string, batch_id string"


def ledger_path(path: str) -> str:
    return path.rstrip("/") + "_ledger"


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """(source, batch_id) of all batches landed in the raw table at ``path``,
    or None for a table landed without a ledger.  The two are partition
    columns; only file names are listed."""
    try:
        return (spark.read.schema("landed_at timestamp, " + LEDGER_SCHEMA).parquet(ledger_path(path))
                .select("source", "batch_id"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _newest(raw: DataFrame):
    """Map from source to its largest batch id, as a scalar subquery; its size
    is the number of sources.  ``raw``: the ledger, or a raw table without one."""
    return (raw.groupBy(_source(raw).alias("s")).agg(F.max("batch_id").alias("newest"))
            .agg(F.map_from_entries(F.collect_list(F.struct("s", "newest")))).scalar())


def _source(raw: DataFrame):
    """A table without the column has one source."""
    return F.coalesce(F.col("source"), F.lit("")) if "source" in raw.columns else F.lit("")


def latest_batch(raw: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Rows of the newest batch (max batch_id) of each source, staging columns
    only.  Without a ledger the batch ids are read from the table itself."""
    newest = _newest(raw if ledger is None else ledger)
    return (raw.filter(F.array_contains(F.map_values(newest), F.col("batch_id"))
                       & (newest[_source(raw)] == F.col("batch_id")))
            .select("metric", "entity", "period", "value"))


def latest_per_key(raw: DataFrame, key=("metric", "entity", "period")) -> DataFrame:
    """Newest row per key across batches (right for incremental batches,
    where the newest batch holds only changed keys).  One mergeable
    aggregate; a NULL value in the newest batch is kept."""
    return raw.groupBy(*key).agg(
        F.max_by(F.col("value"), F.col("batch_id")).alias("value"),
        F.max("batch_id").alias("batch_id"))


def superseded_keys(raw: DataFrame, key=("metric", "entity", "period"),
                    ledger: DataFrame | None = None) -> DataFrame:
    """Keys of older batches missing from the newest ones (a source's newest
    batch is not a superset)."""
    newest = latest_batch(raw, ledger).select(*key)
    older = (raw.filter(_newest(raw if ledger is None else ledger)[_source(raw)] != F.col("batch_id"))
             .select(*key).distinct())
    return older.join(newest, list(key), "left_anti")


def publish_if_complete(batch: DataFrame, raw_path: str, staging_path: str,
                        expected_keys: DataFrame | None = None,
                        expected_rows: int | None = None,
                        key=("metric", "entity", "period")) -> DataFrame:
    """Land a stamped batch in two steps: write it to a staging folder,
    check completeness there, and only then add it to the raw table.

    A run that dies half way leaves at most a staging folder; the raw
    table never receives a partial newest batch.  Completeness is a row count,
    or the same keys as ``expected_keys`` (none missing, none further).  An
    empty batch and one that repeats a key are never published.  Returns the
    report: one row with ``n_rows``, ``n_duplicates`` (keys), ``n_missing``,
    ``n_further`` and ``published``.
    """
    spark = batch.sparkSession
    batch.write.mode("overwrite").parquet(staging_path)
    staged = spark.read.parquet(staging_path)
    n_rows = staged.count()
    n_duplicates = staged.groupBy(*key).count().filter("count > 1").count()
    n_missing = n_further = 0
    if expected_keys is not None:
        here, wanted = staged.select(*key), expected_keys.select(*key)
        n_missing = wanted.join(here, list(key), "left_anti").count()
        n_further = here.join(wanted, list(key), "left_anti").count()
    ok = (n_rows > 0 and n_duplicates == n_missing == n_further == 0
          and (expected_rows is None or n_rows == expected_rows))
    if ok:
        append_batch(staged, raw_path)
    return spark.createDataFrame([(n_rows, n_duplicates, n_missing, n_further, ok)],
                                 "n_rows long, n_duplicates long, n_missing long, n_further long, "
                                 "published boolean") \
        .withColumn("checked_at", F.current_timestamp())
