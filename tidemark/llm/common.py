"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

# A word is a maximal run of letters and digits, lower-cased.
NON_WORD = r"[^\p{L}\p{N}]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words(text: Column) -> Column:
    """Lower-cased words of a text; NULL counts as empty."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NON_WORD), "")


def word_hashes(text: Column) -> Column:
    """64-bit hash of every word, in text order."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that no column of ``df`` has (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage
    and lets several consumers read one computed table."""
    path = shared_dir(df.sparkSession, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Jobs inside remove their shuffle files when they end, not when the
    driver happens to collect its garbage.  For jobs that write a table and
    are not run a second time."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did,
    if that folder is not on their path already."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
