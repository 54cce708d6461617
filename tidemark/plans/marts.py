"""The five marts of a panel, built as one job graph.

The gap mart feeds three other marts; ``build_marts`` writes it once to a
shared folder (a written table cuts lineage and survives executor loss)
and the consumers read it back instead of recomputing the panel.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.dispersion import scoped_dispersion
from tidemark.operators.gap import descriptive_panel, gap_mart, gap_to_benchmark
from tidemark.operators.quality import Watch, grain_unique
from tidemark.operators.trend import stuck_matrix, years_to_close
from tidemark.session import shared_dir
from tidemark.sources.tables import Panel


def gap_of(panel: Panel) -> DataFrame:
    """The gap mart: gap fact with both dimensions."""
    return gap_mart(panel.df, panel.params.benchmark, panel.entity_dim, panel.metric_dim,
                    panel.bench_bound, panel.entity_bound)


def gap_fact(panel: Panel) -> DataFrame:
    """(entity, metric, period, value, bench_value, gap) without
    dimensions: what the aggregating marts consume, so dimension columns
    are joined after their aggregate, never onto every panel row."""
    return gap_to_benchmark(panel.df, panel.params.benchmark, panel.bench_bound)


def stuck_of(panel: Panel, gap: DataFrame | None = None) -> DataFrame:
    gap = gap if gap is not None else gap_fact(panel)
    return stuck_matrix(gap, panel.entity_dim, panel.metric_dim, panel.params,
                        panel.entity_bound)


def closing_of(panel: Panel, gap: DataFrame | None = None) -> DataFrame:
    gap = gap if gap is not None else gap_fact(panel)
    return years_to_close(gap, panel.entity_dim, panel.metric_dim, panel.params,
                          panel.entity_bound)


def dispersion_of(panel: Panel, gap: DataFrame | None = None) -> DataFrame:
    gap = gap if gap is not None else gap_fact(panel)
    return scoped_dispersion(gap, panel.entity_dim, panel.params, panel.entity_bound)


def descriptive_of(panel: Panel) -> DataFrame:
    p = panel.params
    return descriptive_panel(panel.df, panel.entity_dim, panel.metric_dim,
                             p.descriptive_roles, p.fit_start, p.fit_end,
                             panel.entity_bound)


def materialize(df: DataFrame, path: str, partition_by=None, watch: Watch | None = None) -> DataFrame:
    """Write a layer as Parquet (overwrite) and return the re-read table.  A
    ``watch`` observes its checks in the same job."""
    w = (watch.on(df) if watch else df).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


class GrainError(ValueError):
    """The panel has more than one row for some (entity, metric, period)."""


def build_marts(spark: SparkSession, panel: Panel, out_dir: str | None = None,
                check_grain: bool = True, watches: dict[str, Watch] | None = None) -> dict:
    """Write all five marts under ``out_dir`` (default: the shared folder).

    The panel is written first and its grain is checked on the written
    table: every series-partitioned window downstream relies on one row per
    (entity, metric, period), and a duplicated key would also fan out the
    benchmark join.  A violation stops the build before any mart is written.
    ``watches`` (by table, the panel too) observe their checks meanwhile.
    """
    watches = watches or {}
    out_dir = out_dir or shared_dir(spark, "marts")
    panel = replace(panel, df=materialize(
        panel.df.sortWithinPartitions("metric", "entity", "period"), f"{out_dir}/panel",
        watch=watches.get("panel")))
    if check_grain:
        dup = grain_unique(panel.df, ["entity", "metric", "period"]).limit(1).count()
        if dup:
            raise GrainError("panel grain violated: duplicate (entity, metric, period)")
    gap = materialize(gap_of(panel), f"{out_dir}/gap", watch=watches.get("gap"))
    marts = {"gap": gap}
    for name, df in (("stuck", stuck_of(panel, gap)), ("closing", closing_of(panel, gap)),
                     ("dispersion", dispersion_of(panel, gap)),
                     ("descriptive", descriptive_of(panel))):
        marts[name] = materialize(df, f"{out_dir}/{name}", watch=watches.get(name))
    return marts
