"""Ordered operators, pivots, buckets and codes (W1-W9, A19, A20, F10-F12,
X1, X2, X12, X17, X18, S12).

Windows are partitioned by series (entity, metric): under the panel grain a
series holds at most one row per period, so a window partition is bounded
by the period count however many entities there are.  A window by metric
alone appears only over a slice bounded by metrics x periods (the benchmark
series) or behind a rank filter that Spark turns into a per-task
WindowGroupLimit (top k).  Nothing windows over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import dec_round, status_code_expr, years_bucket_expr

SERIES = ("entity", "metric")


def delta(df: DataFrame, y: str = "gap", by=SERIES, order: str = "period",
          digits: int | None = None) -> DataFrame:
    """Period-on-period change ``y(t) - y(t-1)`` within each series.  With
    ``digits`` the values are rounded first (as a display table would)."""
    w = Window.partitionBy(*by).orderBy(order)
    v = dec_round(y, digits) if digits is not None else F.col(y)
    return (df.withColumn(y, v)
            .withColumn("delta", F.col(y) - F.lag(y).over(w)))


def spikes(df: DataFrame, threshold: float, y: str = "gap", by=SERIES,
           order: str = "period") -> DataFrame:
    """Spike-and-reversal points: the change into t and the change out of
    t have opposite signs and both exceed ``threshold`` in size."""
    w = Window.partitionBy(*by).orderBy(order)
    d = (df.withColumn("delta_in", F.col(y) - F.lag(y).over(w))
         .withColumn("delta_out", F.lead(y).over(w) - F.col(y)))
    flag = ((F.signum("delta_in") * F.signum("delta_out") < 0)
            & (F.abs("delta_in") > threshold) & (F.abs("delta_out") > threshold))
    return d.filter(flag).select(*by, order, y, "delta_in", "delta_out")


def _peak_struct(y: str, order: str, sign: int):
    """Ordering key for max_by: highest (sign=1) or lowest (sign=-1) value,
    ties to the earliest period; NULL values never win."""
    v = F.col(y) * sign
    return F.when(F.col(y).isNotNull(), F.struct(v.alias("k"), (-F.col(order)).alias("t")))


def series_shape(df: DataFrame, start: int, end: int, y: str = "gap", by=SERIES,
                 order: str = "period") -> DataFrame:
    """Per series over [start, end]: peak and trough (value, period; ties
    to the earliest period), and whether it never falls / never rises."""
    w = Window.partitionBy(*by).orderBy(order)
    d = (df.filter(F.col(order).between(start, end))
         .withColumn("_d", F.col(y) - F.lag(y).over(w)))
    has_d = F.col("_d").isNotNull()
    known = lambda c: F.when(F.count(y) > 0, F.coalesce(c, F.lit(True)))  # noqa: E731  no data: unknown
    return d.groupBy(*by).agg(
        F.max(y).alias("peak"),
        F.max_by(F.col(order), _peak_struct(y, order, 1)).alias("peak_period"),
        F.min(y).alias("trough"),
        F.max_by(F.col(order), _peak_struct(y, order, -1)).alias("trough_period"),
        known(F.bool_and(F.when(has_d, F.col("_d") >= 0))).alias("never_falls"),
        known(F.bool_and(F.when(has_d, F.col("_d") <= 0))).alias("never_rises"))


def last_value(df: DataFrame, y: str = "gap", by=SERIES, order: str = "period") -> DataFrame:
    """Value at the last period of each series (a NULL there is kept);
    an aggregate, no window."""
    return df.groupBy(*by).agg(F.max(order).alias("last_period"),
                               F.max_by(F.col(y), F.col(order)).alias("last_value"))


def endpoints(df: DataFrame, a: int, b: int, y: str = "gap", by=SERIES,
              order: str = "period", digits: int = 1) -> DataFrame:
    """Values at two periods and their display text with an 'NA' fallback."""
    va = F.max(F.when(F.col(order) == a, F.col(y)))
    vb = F.max(F.when(F.col(order) == b, F.col(y)))
    out = df.groupBy(*by).agg(va.alias("value_a"), vb.alias("value_b"))
    txt = lambda c: F.coalesce(
        F.round(F.col(c).cast("decimal(28,10)"), digits).cast(f"decimal(28,{digits})")
        .cast("string"), F.lit("NA"))
    return out.withColumn("text_a", txt("value_a")).withColumn("text_b", txt("value_b"))


def slope_since_peak(df: DataFrame, start: int, end: int, y: str = "gap", by=SERIES,
                     order: str = "period") -> DataFrame:
    """Slope from each series' peak period (highest value in [start, end],
    earliest on ties) to ``end``.  The peak comes from a window over the
    series; the aggregate that follows reuses that partitioning, so the
    whole operator costs one shuffle."""
    w = Window.partitionBy(*by)
    d = (df.filter(F.col(order).between(start, end))
         .withColumn("peak_period", F.max_by(F.col(order), _peak_struct(y, order, 1)).over(w)))
    after = F.col(order) >= F.col("peak_period")
    yy, xx = F.when(after, F.col(y)), F.when(after, F.col(order))
    return d.groupBy(*by).agg(
        F.first("peak_period").alias("peak_period"),
        F.max(y).alias("peak"),
        F.regr_slope(yy, xx).alias("slope_since_peak"),
        F.count(yy).alias("n_since_peak"))


def pivot_agg(df: DataFrame, index, column: str, values, agg) -> DataFrame:
    """Long -> wide over a listed value set: ``agg(when(column == v, ...))``
    per value, named after the value; one aggregate for any number of values."""
    return df.groupBy(*index).agg(*[agg(F.col(column) == v).alias(str(v)) for v in values])


def to_wide(df: DataFrame, index, column: str, value: str, values, unique: bool = False) -> DataFrame:
    """Long -> wide with a listed value set (no discovery job, bounded
    width).  Each cell is the single value of its key.  With ``unique`` the
    same aggregate counts the rows of every cell and the job fails on a cell
    with more than one; without it the grain must have been checked
    (``grain_unique``), and of several values the largest is taken."""
    def cell(cond):
        one = F.max(F.when(cond, F.col(value)))
        if not unique:
            return one
        fault = F.concat(F.lit(f"to_wide: more than one row for {column} in "), F.to_json(F.struct(*index)))
        return F.when(F.count_if(cond) > 1, F.raise_error(fault).cast(df.schema[value].dataType)).otherwise(one)
    return pivot_agg(df, index, column, values, cell)


def complete_rows(df: DataFrame, columns) -> DataFrame:
    """Rows with a value in every one of the columns (P7); NaN counts as a
    value, as everywhere after landing."""
    keep = F.lit(True)
    for c in columns:
        keep = keep & F.col(c).isNotNull()
    return df.filter(keep)


def transpose(df: DataFrame, key: str, keys, columns, name: str = "field") -> DataFrame:
    """Wide table -> its transpose: one row per listed column (``name``), one
    column per listed value of ``key``.  Both lists are parameters, so both
    shapes are bounded; the columns must have one type."""
    long = df.filter(F.col(key).isin(list(keys))).unpivot([key], list(columns), name, "_cell")
    return to_wide(long, [name], key, "_cell", keys, unique=True)


def status_grid(stuck: DataFrame, metrics) -> DataFrame:
    """Entity x metric grid of numeric status codes."""
    coded = stuck.withColumn("code", status_code_expr("status"))
    return to_wide(coded, ["entity"], "metric", "code", metrics)


def years_bucket(closing: DataFrame) -> DataFrame:
    return closing.withColumn("years_bucket", years_bucket_expr("status", "years_to_close"))


def top_extremes(df: DataFrame, k: int, y: str = "gap", by=("metric",),
                 largest: bool = True) -> DataFrame:
    """k most extreme values per group, as ``rank`` 1..k; ties go to the
    smaller other columns, in their order.  The row_number filter becomes a
    WindowGroupLimit, which keeps only the local top k of each group in every
    map task before the shuffle."""
    key = F.col(y).desc() if largest else F.col(y).asc()
    ties = [F.col(c).asc() for c in ("entity", "period") if c in df.columns and c not in by]
    w = Window.partitionBy(*by).orderBy(key, *ties)
    return (df.filter(F.col(y).isNotNull())
            .withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k))


def last_n_periods(df: DataFrame, n: int, by=("metric",), order: str = "period") -> DataFrame:
    """Rows in the last n distinct periods of each group.  The distinct
    periods are aggregated first (partial aggregation), cut to n per group
    and joined back."""
    w = Window.partitionBy(*by).orderBy(F.col(order).desc())
    last = (df.select(*by, order).distinct().withColumn("_n", F.row_number().over(w))
            .filter(F.col("_n") <= n).drop("_n"))
    return df.join(last, [*by, order], "left_semi").select(*df.columns)


def axis_range(df: DataFrame, y: str = "gap") -> DataFrame:
    return df.agg(F.min(y).alias("axis_min"), F.max(y).alias("axis_max"))


def benchmark_breaks(df: DataFrame, benchmark: str, y: str = "value",
                     order: str = "period") -> DataFrame:
    """Dips of the benchmark series that recover within one period:
    delta(t) < 0 and y(t+1) >= y(t-1)."""
    w = Window.partitionBy("metric").orderBy(order)
    b = (df.filter(F.col("entity") == benchmark)
         .withColumn("prev", F.lag(y).over(w))
         .withColumn("next", F.lead(y).over(w)))
    flag = (F.col(y) - F.col("prev") < 0) & (F.col("next") >= F.col("prev"))
    return b.filter(flag).select("metric", order, y, "prev", "next")


def top_abs_extremes(df: DataFrame, k: int, y: str = "gap", center: float = 0.0,
                     by=("metric",)) -> DataFrame:
    """k values farthest from ``center`` per group, with the ties and the
    per-task WindowGroupLimit of ``top_extremes``."""
    d = df.withColumn("_dist", F.abs(F.col(y) - F.lit(center)))
    return top_extremes(d, k, y="_dist", by=by).drop("_dist")


def level_shift(df: DataFrame, benchmark: str, at: int, y: str = "value") -> DataFrame:
    """Per metric of the benchmark series: mean before and from ``at`` on,
    and the shift between them (one aggregate over the benchmark slice)."""
    b = df.filter(F.col("entity") == benchmark)
    before = F.avg(F.when(F.col("period") < at, F.col(y)))
    after = F.avg(F.when(F.col("period") >= at, F.col(y)))
    return (b.groupBy("metric").agg(before.alias("mean_before"), after.alias("mean_after"))
            .withColumn("shift", F.col("mean_after") - F.col("mean_before")))
