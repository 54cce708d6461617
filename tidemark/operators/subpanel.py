"""Largest balanced sub-panels (X20, X21, J6) from presence bitmaps.

An entity's presence on a metric is one bitmap over the periods, on several
metrics the AND of these.  A window of periods is complete for an entity if it
lies inside a run of ones, so it is enough to count runs: entities are reduced
to (metric set, run) counts in one aggregate, and all windows are read off
those.  The grid of entities, metrics and periods is never built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PERIODS = 62   # bits of a long that are used
MAX_METRICS = 12   # 2^12 - 1 metric sets


def presence(df: DataFrame, metrics, start: int, end: int, y: str = "value") -> DataFrame:
    """(entity, masks): one bitmap of the periods with a value per listed
    metric."""
    n = end - start + 1
    if not 0 < n <= MAX_PERIODS or not 0 < len(metrics) <= MAX_METRICS:
        raise ValueError(f"at most {MAX_PERIODS} periods and {MAX_METRICS} metrics")
    here = F.col("period").between(start, end) & F.col(y).isNotNull()
    bit = F.expr(f"shiftleft(1L, cast(period as int) - {int(start)})")
    masks = [F.coalesce(F.bit_or(F.when(here & (F.col("metric") == m), bit)), F.lit(0).cast("long")) for m in metrics]
    return df.groupBy("entity").agg(F.array(*masks).alias("masks"))


def window_counts(df: DataFrame, metrics, start: int, end: int, y: str = "value") -> DataFrame:
    """(set, a, b, n_entities): for every set of the listed metrics (bits of
    ``set``) and window of periods ``a`` to ``b`` that any entity fills, the
    number of entities with a value in every cell of it."""
    n, m = end - start + 1, len(metrics)
    sets = F.expr(f"""transform(sequence(1, {(1 << m) - 1}), s -> struct(s AS s,
        aggregate(sequence(0, {m - 1}), -1L, (x, i) ->
            x & if((shiftright(s, i) & 1) = 1, masks[i], -1L)) AS mask))""")
    each = (presence(df, metrics, start, end, y).select(F.explode(sets).alias("s")).select("s.s", "s.mask")
            .where("mask <> 0"))
    ones = "filter(sequence(0, {n}), i -> (shiftright({mask}, i) & 1) = 1)"
    runs = F.arrays_zip(F.expr(ones.format(n=n - 1, mask="mask & ~shiftleft(mask, 1)")).alias("a"),
                        F.expr(ones.format(n=n - 1, mask="mask & ~shiftrightunsigned(mask, 1)")).alias("b"))
    run = (each.select("s", F.explode(runs).alias("r")).groupBy("s", F.col("r.a").alias("a"), F.col("r.b").alias("b"))
           .agg(F.count(F.lit(1)).alias("n")))
    # every window inside a run: first all its starts, then all its ends
    starts = (run.select("s", F.explode(F.sequence("a", "b")).alias("a"), "b", "n")
              .groupBy("s", "a", "b").agg(F.sum("n").alias("n")))
    return (starts.select("s", "a", F.explode(F.sequence("a", "b")).alias("b"), "n")
            .groupBy("s", "a", "b").agg(F.sum("n").alias("n_entities"))
            .select(F.col("s").alias("set"), (F.col("a") + start).alias("a"), (F.col("b") + start).alias("b"),
                    "n_entities"))


def names_of(set_: Column, metrics) -> Column:
    """The names of a metric set, in the listed order, joined by '+'."""
    return F.concat_ws("+", *[F.when(F.bitwise_not(set_).bitwiseAND(1 << i) == 0, F.lit(x)) for i, x in enumerate(metrics)])


def balanced_frontier(df: DataFrame, metrics, start: int, end: int, y: str = "value") -> DataFrame:
    """For every number of metrics and periods the balanced sub-panel that
    keeps the most entities: ``n_metrics``, ``n_periods``, ``metrics``,
    ``start``, ``end``, ``n_entities`` and ``n_cells``.  Ties go to the set
    that comes first in the listed order (its bits as a number), then to the
    earlier window; shapes that no entity fills have no row."""
    w = window_counts(df, metrics, start, end, y)
    best = w.groupBy(F.bit_count("set").alias("n_metrics"), (F.col("b") - F.col("a") + 1).alias("n_periods")).agg(
        F.max(F.struct("n_entities", (-F.col("set")).alias("set"), (-F.col("a")).alias("a"))).alias("w"))
    set_, a = -F.col("w.set"), -F.col("w.a")
    return best.select("n_metrics", "n_periods", names_of(set_, metrics).alias("metrics"), a.alias("start"),
                       (a + F.col("n_periods") - 1).alias("end"), F.col("w.n_entities").alias("n_entities"),
                       (F.col("w.n_entities") * F.col("n_metrics") * F.col("n_periods")).alias("n_cells"))


def largest_balanced(df: DataFrame, metrics, start: int, end: int, y: str = "value") -> DataFrame:
    """The balanced sub-panel with the most cells: one row of the frontier
    (the one with more entities, then more metrics, if several have as many)."""
    f = balanced_frontier(df, metrics, start, end, y)
    return f.orderBy(F.desc("n_cells"), F.desc("n_entities"), F.desc("n_metrics")).limit(1)
