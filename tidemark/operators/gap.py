"""Benchmark-relative gap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import gap_expr
from tidemark.operators.common import bounded, enrich, entity_cols, metric_cols


def benchmark_rows(df: DataFrame, benchmark: str) -> DataFrame:
    """(metric, period, bench_value) of the benchmark entity."""
    return (df.filter(F.col("entity") == benchmark)
            .select("metric", "period", F.col("value").alias("bench_value")))


def with_benchmark(df: DataFrame, benchmark: str, bench_bound: int | None = None) -> DataFrame:
    """Left join of the panel with its own benchmark rows on (metric,
    period).  The benchmark slice has at most metrics x periods rows
    whatever the number of entities, so with a proven bound it is broadcast
    and the panel is never shuffled for this join."""
    return df.join(bounded(benchmark_rows(df, benchmark), bench_bound),
                   ["metric", "period"], "left")


def gap_to_benchmark(df: DataFrame, benchmark: str, bench_bound: int | None = None) -> DataFrame:
    """entity, metric, period, value, bench_value, gap (value as percent of
    the benchmark, 2 decimals; NULL if the benchmark is NULL or 0).  Rows
    without a benchmark value are kept."""
    return (with_benchmark(df, benchmark, bench_bound)
            .select("entity", "metric", "period", "value", "bench_value",
                    gap_expr("value", "bench_value").alias("gap")))


def gap_mart(df: DataFrame, benchmark: str, entity_dim=None, metric_dim=None,
             bench_bound=None, entity_bound=None) -> DataFrame:
    """The gap fact enriched with both dimensions (left joins: unmatched
    rows keep NULL labels)."""
    g = gap_to_benchmark(df, benchmark, bench_bound)
    out = enrich(g, entity_dim, metric_dim, "left", entity_bound)
    return out.select(*entity_cols(entity_dim), *metric_cols(metric_dim),
                      "period", "value", "bench_value", "gap")


def descriptive_panel(df: DataFrame, entity_dim: DataFrame, metric_dim: DataFrame,
                      roles, start: int, end: int, entity_bound=None) -> DataFrame:
    """Window + role scope, value untouched; inner joins drop entities and
    metrics without a dimension row."""
    scoped = df.filter(F.col("period").between(start, end))
    dims = entity_dim.filter(F.col("role").isin(list(roles)))
    out = (scoped.join(bounded(dims, entity_bound), "entity", "inner")
           .join(F.broadcast(metric_dim), "metric", "inner"))
    return out.select(*entity_cols(entity_dim), *metric_cols(metric_dim), "period", "value")
