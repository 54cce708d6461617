"""Comparisons between entities, tiers and metrics (J7, X8-X11, X13, X15,
X19, X22, A14).

Metric-to-metric pairing inside an entity is conditional aggregation on
the entity (one pass, no self-join); entity pairs are parameters, never all
pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import params as P
from tidemark.functions.exprs import dec_round
from tidemark.operators.common import bounded
from tidemark.operators.rank import count_below, value_rank


def dominance(df: DataFrame, a: str, b: str, y: str = "gap",
              bench_bound: int | None = None) -> DataFrame:
    """Per metric: is ``a`` above ``b`` in every period, and the first
    period where ``a`` moves from not-above to above, unknown periods between
    them passed over.  A period that is NULL or missing on one side is unknown:
    ``always_above`` is then false if some known period says so, else NULL.  Both slices have at
    most metrics x periods rows."""
    sa = df.filter(F.col("entity") == a).select("metric", "period", F.col(y).alias("y_a"))
    sb = df.filter(F.col("entity") == b).select("metric", "period", F.col(y).alias("y_b"))
    w = Window.partitionBy("metric").orderBy("period")
    j = (sa.join(bounded(sb, bench_bound), ["metric", "period"], "full_outer")
         .withColumn("_above", F.col("y_a") > F.col("y_b"))
         .withColumn("_prev", F.last("_above", ignorenulls=True)
                     .over(w.rowsBetween(Window.unboundedPreceding, -1))))
    cross = F.col("_above") & ~F.col("_prev")
    return j.groupBy("metric").agg(
        F.when(F.bool_or(~F.col("_above")), F.lit(False))
        .when(F.count("_above") == F.count(F.lit(1)), F.lit(True)).alias("always_above"),
        F.min(F.when(cross, F.col("period"))).alias("first_overtake"),
        F.count(F.lit(1)).alias("n_periods"))


def snapshot_rank(df: DataFrame, period: int, y: str = "value",
                  group_bound: int | None = None) -> DataFrame:
    """Rank (ascending) of the entities per metric at one period, with the
    next value up and the margin to it."""
    snap = df.filter((F.col("period") == period) & F.col(y).isNotNull()) \
        .select("entity", "metric", "period", y)
    r = value_rank(snap, ["metric"], y, group_bound=group_bound, next_out="next_value")
    out = r.withColumn("margin_to_next", F.col("next_value") - F.col(y))
    return out.select("entity", "metric", "period", y, "rank", "percent_rank",
                      "next_value", "margin_to_next")


def rank_reversal(df: DataFrame, period: int, metric_a: str, metric_b: str,
                  y: str = "value", group_bound: int | None = None) -> DataFrame:
    """Ranks of each entity on two metrics at one period and the shift."""
    snap = df.filter((F.col("period") == period) & F.col(y).isNotNull()
                     & F.col("metric").isin(metric_a, metric_b))
    r = value_rank(snap.select("entity", "metric", y), ["metric"], y,
                   group_bound=group_bound)
    ra = r.filter(F.col("metric") == metric_a).select("entity", F.col("rank").alias("rank_a"))
    rb = r.filter(F.col("metric") == metric_b).select("entity", F.col("rank").alias("rank_b"))
    return (ra.join(rb, "entity")
            .withColumn("rank_shift", F.col("rank_b") - F.col("rank_a")))


def tier_position(df: DataFrame, entity_dim: DataFrame, reference_roles, subject_roles,
                  y: str = "value", group_bound: int | None = None,
                  entity_bound: int | None = None) -> DataFrame:
    """Where each subject entity sits inside the reference tier's
    distribution per (metric, period): reference entities strictly below
    and the share they make of the tier."""
    roles = entity_dim.select("entity", "role")
    d = (df.filter(F.col(y).isNotNull())
         .join(bounded(roles, entity_bound), "entity")
         .filter(F.col("role").isin(*reference_roles, *subject_roles))
         .withColumn("_w", F.col("role").isin(*reference_roles).cast("long")))
    r = count_below(d, ["metric", "period"], y, weight="_w", out="ref_below",
                    n_out="ref_n", group_bound=group_bound)
    return (r.filter(F.col("role").isin(*subject_roles))
            .withColumn("ref_share_below",
                        F.when(F.col("ref_n") > 0, F.col("ref_below") / F.col("ref_n")))
            .select("entity", "role", "metric", "period", y, "ref_below", "ref_n",
                    "ref_share_below"))


def cohort_means(stuck: DataFrame, flag: str, metric: str, y: str = "gap_change") -> DataFrame:
    """Mean and count of ``y`` by a boolean cohort flag for one metric."""
    return (stuck.filter(F.col("metric") == metric)
            .groupBy(flag).agg(F.avg(F.col(y).cast("double")).alias("mean"),
                               F.count(y).alias("count")))


def tier_gap(gap: DataFrame, entity_dim: DataFrame, metric: str, tier_a: str, tier_b: str,
             start: int, end: int, entity_bound: int | None = None) -> DataFrame:
    """Per period: mean gap of two tiers and their difference, by
    conditional aggregation in one group-by."""
    d = (gap.filter((F.col("metric") == metric) & F.col("period").between(start, end))
         .select("entity", "metric", "period", "gap")
         .join(bounded(entity_dim.select("entity", "role"), entity_bound), "entity"))
    g = F.col("gap").cast("double")
    out = d.groupBy("metric", "period").agg(
        F.avg(F.when(F.col("role") == tier_a, g)).alias("mean_a"),
        F.avg(F.when(F.col("role") == tier_b, g)).alias("mean_b"))
    return out.withColumn("tier_gap", F.col("mean_b") - F.col("mean_a"))


def mean_gain(stuck: DataFrame, roles=None, metrics=None) -> DataFrame:
    d = stuck
    if roles:
        d = d.filter(F.col("role").isin(list(roles)))
    if metrics:
        d = d.filter(F.col("metric").isin(list(metrics)))
    return d.groupBy("metric").agg(F.avg(F.col("gap_change").cast("double")).alias("mean_gain"),
                                   F.count("gap_change").alias("n"))


def metric_pair(closing: DataFrame, metric_a: str, metric_b: str) -> DataFrame:
    """Per entity: gap at the reference period and years to close for two
    metrics, side by side (conditional aggregation, no self-join)."""
    def pick(m, c):
        return F.max(F.when(F.col("metric") == m, F.col(c)))
    return (closing.filter(F.col("metric").isin(metric_a, metric_b))
            .groupBy("entity").agg(pick(metric_a, "gap_ref").alias("gap_ref_a"),
                                   pick(metric_a, "years_to_close").alias("years_a"),
                                   pick(metric_b, "gap_ref").alias("gap_ref_b"),
                                   pick(metric_b, "years_to_close").alias("years_b")))


def metric_ratio(closing: DataFrame, metric_a: str, metric_b: str) -> DataFrame:
    """Closing time of metric b over metric a within each entity."""
    return metric_pair(closing, metric_a, metric_b).withColumn(
        "ratio", F.try_divide(F.col("years_b"), F.col("years_a")))


def scenario_years(closing: DataFrame, metric_a: str, metric_b: str) -> DataFrame:
    """What-if closing time of metric b at metric a's pace:
    remaining gap b x years a / remaining gap a, 1 decimal; only entities
    whose metric b row has a years figure."""
    p = metric_pair(closing, metric_a, metric_b).filter(F.col("years_b").isNotNull())
    rem_a = F.lit(P.PARITY) - F.col("gap_ref_a")
    rem_b = F.lit(P.PARITY) - F.col("gap_ref_b")
    return p.withColumn("scenario_years",
                        dec_round(F.try_divide(rem_b * F.col("years_a"), rem_a), 1))


def classifier_agreement(stuck: DataFrame, closing: DataFrame) -> DataFrame:
    """Join the two status columns on (entity, metric), map the stuck
    labels onto the trajectory labels and flag disagreements."""
    s, t = P.STUCK_LABELS, P.TRAJECTORY_LABELS
    mapped = (F.when(F.col("status_stuck") == s["down"], t["down"])
              .when(F.col("status_stuck") == s["flat"], t["flat"])
              .otherwise(F.col("status_stuck")))
    a = stuck.select("entity", "metric", F.col("status").alias("status_stuck"))
    b = closing.select("entity", "metric", F.col("status").alias("status_trajectory"))
    return (a.join(b, ["entity", "metric"])
            .withColumn("agree", mapped == F.col("status_trajectory")))
