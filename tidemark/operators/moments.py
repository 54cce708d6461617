"""Trends kept up batch by batch (F3, A6, A7 without reading history).

The state has one row per series: the moments of its fit (n and the sums of
x, y, xx and xy, as exact integers) and the cells they were made from, a map
from period to value.  A batch brings new and revised cells; each takes its
old value out of the moments and puts its new one in.  Sums of integers do
not depend on the order of the updates, so the state after any sequence of
batches equals that of the newest cells read at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.bucketed import BUCKETS, SERIES, write_bucketed

BIG = "decimal(38,0)"
CELLS = "map<int,bigint>"
STATE_SCHEMA = f"entity string, metric string, cells {CELLS}, n bigint, sx bigint, sxx bigint, sy {BIG}, sxy {BIG}"


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


def units(value: str | Column, scale: int) -> Column:
    """A value in units of 10^-scale; one too large for a long is no value."""
    v = F.col(value) if isinstance(value, str) else value
    return F.round(v * (10 ** scale)).try_cast("long")


def batch_cells(batch: DataFrame, start: int, end: int, scale: int, value: str = "value") -> DataFrame:
    """(entity, metric, changed): the batch's cells inside the window, one
    row per series.  A cell the batch repeats counts once, with the largest
    value."""
    cells = (batch.where(F.col("period").between(start, end) & F.col("entity").isNotNull() & F.col("metric").isNotNull())
             .groupBy(*SERIES, "period").agg(F.max(units(value, scale)).alias("y")))
    return cells.groupBy(*SERIES).agg(
        F.map_from_entries(F.collect_list(F.struct("period", "y"))).cast(CELLS).alias("changed"))


def _sum(entries: Column, term, kind: str) -> Column:
    return F.aggregate(entries, F.lit(0).cast(kind), lambda a, e: (a + term(e)).cast(kind))


def advance(state: DataFrame, batch: DataFrame, start: int, end: int, scale: int, value: str = "value") -> DataFrame:
    """The state after one batch.  Reads the state and the batch only; the
    state's side of the join needs no exchange if it is stored in buckets.  A
    NULL value in the batch takes the cell's old value out."""
    new = batch_cells(batch, start, end, scale, value)
    old = state.select(*SERIES, "cells", "n", "sx", "sxx", "sy", "sxy")
    none = F.expr(f"cast(map() as {CELLS})")
    joined = (old.join(new, list(SERIES), "full_outer")
              .withColumns({"cells": F.coalesce("cells", none), "changed": F.coalesce("changed", none)}))
    entries = F.transform(F.map_entries("changed"), lambda e: F.struct(
        (e["key"] - start).cast("long").alias("x"), e["value"].alias("to"),
        F.try_element_at(F.col("cells"), e["key"]).alias("was")))
    e = F.col("entries")

    def more(x):  # points added less points taken out
        return F.when(x["to"].isNotNull(), 1).otherwise(0) - F.when(x["was"].isNotNull(), 1).otherwise(0)

    def rise(x):
        return F.coalesce(x["to"], F.lit(0)).cast(BIG) - F.coalesce(x["was"], F.lit(0)).cast(BIG)

    def plus(name, term, kind):
        return (F.coalesce(F.col(name), F.lit(0)).cast(kind) + _sum(e, term, kind)).cast(kind).alias(name)
    kept = F.map_filter(F.col("cells"), lambda k, v: ~F.map_contains_key(F.col("changed"), k))
    return (joined.withColumn("entries", entries)
            .select(*SERIES, F.map_concat(kept, F.col("changed")).alias("cells"),
                    plus("n", more, "bigint"), plus("sx", lambda x: x["x"] * more(x), "bigint"),
                    plus("sxx", lambda x: x["x"] * x["x"] * more(x), "bigint"), plus("sy", rise, BIG),
                    plus("sxy", lambda x: x["x"].cast("decimal(10,0)") * rise(x), BIG)))


def store(state: DataFrame, path: str, buckets: int = BUCKETS, dealt: bool = False) -> DataFrame:
    """Write a version of the state in buckets of the series.  The version
    before it stays, so a job that dies leaves a whole state behind."""
    return write_bucketed(state, path, buckets, sort=(), dealt=dealt)


def trend_of(state: DataFrame, start: int, end: int, scale: int) -> DataFrame:
    """The columns of ``trend``, without ``ref``, from the state alone."""
    n, sx, sxx, sy, sxy = (F.col(c).cast(BIG) for c in ("n", "sx", "sxx", "sy", "sxy"))
    unit = float(10 ** scale)

    def at(p):
        return F.try_element_at(F.col("cells"), F.lit(p)) / F.lit(unit)
    fit = (state.withColumns({"num": F.try_subtract(F.try_multiply(n, sxy), F.try_multiply(sx, sy)),
                              "den": n * sxx - sx * sx})
           .withColumn("slope", F.when(F.col("den") > 0, F.col("num").cast("double") / F.col("den").cast("double") / unit)))
    return fit.select(
        *SERIES, "slope",
        ((F.col("sy").cast("double") / unit - F.col("slope") * F.col("sx")) / F.col("n")
         - F.col("slope") * start).alias("intercept"),
        F.col("n").alias("n_points"), at(start).alias("gap_start"), at(end).alias("gap_end"),
        (at(end) - at(start)).alias("gap_change"), F.col("num").alias("slope_num"), F.col("den").alias("slope_den"))
