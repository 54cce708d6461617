"""Records whose shape drifts (S3, F20): VARIANT columns.

A JSON text is parsed once to a VARIANT.  Known fields land with their types;
what else the records hold is reported by path and type, so a field that was
renamed, retyped or added shows up in numbers before anyone misses it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KNOWN, RETYPED, UNKNOWN, UNREADABLE = "known", "retyped", "unknown", "unreadable"


def parsed(df: DataFrame, column: str, into: str = "_v") -> DataFrame:
    """``df`` with the VARIANT of a JSON column; NULL where it is no JSON."""
    return df.withColumn(into, F.try_parse_json(column))


def land_known(df: DataFrame, column: str, known: dict[str, str]) -> DataFrame:
    """``df`` with one column per known path (``{path: type}``, named after
    the path's last part) and ``readable``.  A field that is absent or does
    not fit its type is NULL; nothing fails."""
    v = parsed(df, column)
    return (v.withColumns({path.rsplit(".", 1)[-1]: F.try_variant_get("_v", path, kind) for path, kind in known.items()})
            .withColumn("readable", F.col("_v").isNotNull()).drop("_v"))


def _fields(rows: DataFrame) -> DataFrame:
    """(path, v) of every field of the objects in (path, v)."""
    spark = rows.sparkSession
    inner = spark.tvf.variant_explode(F.col("v").outer())
    return (rows.lateralJoin(inner).where(F.col("key").isNotNull())
            .select(F.concat("path", F.lit("."), "key").alias("path"), F.col("value").alias("v")))


def drift_report(df: DataFrame, column: str, known: dict[str, str], depth: int = 2) -> DataFrame:
    """(path, type, n_rows, verdict) of all fields down to ``depth`` levels.

    ``verdict`` is ``known`` (a known path with its type; an integer also
    counts where a wider number is known), ``retyped`` (a known path with
    another type), ``unknown`` or, with path and type NULL, ``unreadable``
    (texts that are no JSON; a NULL text is not counted).  The arrays' and
    deeper objects' shapes are in ``type``.  One aggregate with map-side
    combine; its rows are the shapes, not the records.
    """
    texts = df.where(F.col(column).isNotNull())
    base = parsed(texts, column).select(F.lit("$").alias("path"), F.col("_v").alias("v"))
    levels, rows = [], base.where(F.col("v").isNotNull())
    for _ in range(depth):
        rows = _fields(rows.where(F.schema_of_variant("v").startswith("OBJECT")))
        levels.append(rows)
    found = (reduce(DataFrame.unionByName, levels).select("path", F.schema_of_variant("v").alias("type"))
             .groupBy("path", "type").agg(F.count(F.lit(1)).alias("n_rows")))
    verdict = F.lit(UNKNOWN)
    for path, kind in known.items():
        fits = F.col("type").isin(*_fitting(kind))
        verdict = F.when(F.col("path") == path, F.when(fits, KNOWN).otherwise(RETYPED)).otherwise(verdict)
    broken = base.agg(F.count_if(F.col("v").isNull()).alias("n_rows")).where("n_rows > 0").select(
        F.lit(None).cast("string").alias("path"), F.lit(None).cast("string").alias("type"), "n_rows",
        F.lit(UNREADABLE).alias("verdict"))
    return found.select("path", "type", "n_rows", verdict.alias("verdict")).unionByName(broken)


# Which types of a VARIANT fit a known type.
_FITTING = {
    "bigint": ("BIGINT", "VOID"),
    "int": ("BIGINT", "VOID"),
    "double": ("BIGINT", "DOUBLE", "DECIMAL(18,9)", "VOID"),
    "string": ("STRING", "VOID"),
    "boolean": ("BOOLEAN", "VOID"),
}


def _fitting(kind: str) -> tuple[str, ...]:
    return _FITTING[kind.lower()]
