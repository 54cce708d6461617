"""Tables bucketed by the series key.

A mart that is written in buckets of (entity, metric) keeps its rows where
trends, series windows and joins of marts need them: Spark plans these over
such a table without an exchange.  The table is an external one, so another
session only has to register its folder again.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIES = ("entity", "metric")
BUCKETS = 16  # for tests and small panels; a cluster wants some hundred MB a bucket


def write_bucketed(df: DataFrame, path: str, buckets: int = BUCKETS, keys=SERIES, sort=("period",),
                   dealt: bool = False, watch=None) -> DataFrame:
    """Write ``df`` to ``path`` in ``buckets`` buckets of ``keys``, sorted by
    the keys and ``sort``, one file a bucket, and return the table.

    ``dealt``: the rows already lie in ``buckets`` partitions of the keys (the
    result of a join of bucketed tables), so they are not shuffled again.
    """
    spark, name = df.sparkSession, table_name(path)
    rows = watch.on(df) if watch else df
    if not dealt:
        rows = rows.repartition(buckets, *keys)
    (rows.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
     .sortBy(*keys, *[c for c in sort if c in df.columns]).option("path", path).saveAsTable(name))
    return spark.table(name)


def register(spark: SparkSession, path: str, schema: T.StructType, buckets: int = BUCKETS, keys=SERIES,
             sort=("period",)) -> DataFrame:
    """The bucketed table at ``path`` in a session that did not write it."""
    name = table_name(path)
    by = ", ".join(f"`{k}`" for k in keys)
    order = ", ".join(f"`{k}`" for k in (*keys, *[c for c in sort if c in schema.names]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"CLUSTERED BY ({by}) SORTED BY ({order}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def table_name(path: str) -> str:
    return "tm_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex


def read_back(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n_rows, n_columns) of stored tables; counts come from the
    files' footers."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        for name, df in tables.items()])
