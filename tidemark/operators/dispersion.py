"""Cross-section dispersion (A3-A5, F2) and its shape.

Dispersion groups on (metric, period): few groups, but partial
aggregation reduces every map task to one buffer per group before the
shuffle, so the group count never limits parallelism.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import params as P
from tidemark.operators.common import scope_by_dim


def dispersion(gap: DataFrame, start: int, end: int, y: str = "gap",
               by=("metric", "period")) -> DataFrame:
    """n (non-NULL), mean, sample standard deviation and the guarded
    coefficient of variation of ``y`` per group."""
    v = F.col(y).cast("double")
    d = (gap.filter(F.col("period").between(start, end))
         .groupBy(*by)
         .agg(F.count(v).alias("n"), F.avg(v).alias("mean_gap"),
              F.stddev_samp(v).alias("sd_gap")))
    m = F.col("mean_gap")
    return d.withColumn(
        "cv_gap", F.when(m.isNull() | (m == 0), F.lit(None).cast("double"))
        .otherwise(F.col("sd_gap") / m))


def scoped_dispersion(gap: DataFrame, entity_dim, params: P.PanelParams,
                      entity_bound=None) -> DataFrame:
    # The benchmark's own gap is 100 by construction; it is no member of
    # the cross-section.
    g = gap.select("entity", "metric", "period", "gap").filter(
        F.col("entity") != params.benchmark)
    if params.dispersion_entities:
        g = g.filter(F.col("entity").isin(list(params.dispersion_entities)))
    if params.dispersion_roles:
        g = scope_by_dim(g, entity_dim, "entity", "role", params.dispersion_roles,
                         entity_bound)
    if params.dispersion_metrics:
        g = g.filter(F.col("metric").isin(list(params.dispersion_metrics)))
    return dispersion(g, params.fit_start, params.fit_end)


def dispersion_shape(disp: DataFrame, start: int, end: int, y: str = "cv_gap",
                     by=("metric",)) -> DataFrame:
    """Per metric: value at start and end, change in percent, peak and
    trough (value and period; ties go to the earliest period) and whether
    the path never rises.  One aggregate over the per-period table after a
    lag within each metric's short series."""
    from pyspark.sql import Window as W
    w = W.partitionBy(*by).orderBy("period")
    d = (disp.filter(F.col("period").between(start, end))
         .withColumn("_delta", F.col(y) - F.lag(y).over(w)))
    v = F.col(y)
    valid = v.isNotNull()
    out = d.groupBy(*by).agg(
        F.max(F.when(F.col("period") == start, v)).alias("cv_start"),
        F.max(F.when(F.col("period") == end, v)).alias("cv_end"),
        F.max(v).alias("cv_peak"),
        F.min(v).alias("cv_trough"),
        F.min_by(F.col("period"), F.when(valid, F.struct((-v).alias("k"), F.col("period"))))
        .alias("peak_period"),
        F.min_by(F.col("period"), F.when(valid, F.struct(v.alias("k"), F.col("period"))))
        .alias("trough_period"),
        F.coalesce(F.bool_and(F.when(F.col("_delta").isNotNull(), F.col("_delta") <= 0)),
                   F.lit(True)).alias("monotone_down"))
    s, e = F.col("cv_start"), F.col("cv_end")
    return out.withColumn(
        "change_pct",
        F.when(s.isNull() | (s == 0), F.lit(None).cast("double")).otherwise((e - s) / s * 100))


def balanced_panel(disp: DataFrame, by=("metric",)) -> DataFrame:
    """Per metric: min and max contributor count over periods and whether
    it is constant (a balanced panel)."""
    return (disp.groupBy(*by)
            .agg(F.min("n").alias("min_n"), F.max("n").alias("max_n"),
                 F.count(F.lit(1)).alias("n_periods"))
            .withColumn("balanced", F.col("min_n") == F.col("max_n")))
