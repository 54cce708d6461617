"""Coverage audits, grids and profiles.

The expected grid (entities x metrics x periods) is generated by exploding
parameter lists onto the entity rows: a generator over bounded lists, not a
join of unbounded sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["entity", "metric", "period"]

# Fixed display format of a coverage span: first, en dash, last, count.
SPAN_FORMAT = "%d–%d (%d)"
SPAN_NONE = "NONE"


def coverage(df: DataFrame, by, y: str = "value") -> DataFrame:
    """Rows, non-NULL and NULL counts per key."""
    return (df.groupBy(*by)
            .agg(F.count(F.lit(1)).alias("total_rows"), F.count(y).alias("non_null"))
            .withColumn("nulls", F.col("total_rows") - F.col("non_null")))


def expected_grid(entities: DataFrame, metrics, start: int, end: int) -> DataFrame:
    """entity x metric x period for every listed metric and period."""
    return (entities.select("entity")
            .withColumn("metric", F.explode(F.array(*[F.lit(m) for m in metrics])))
            .withColumn("period", F.explode(F.sequence(F.lit(start), F.lit(end)))))


def complete_grid(df: DataFrame, entities: DataFrame, metrics, start: int, end: int,
                  y: str = "value") -> DataFrame:
    """Every expected cell, with an explicit NULL where the panel has no
    row (or a NULL row).  A hash join on the full key."""
    grid = expected_grid(entities, metrics, start, end)
    return grid.join(df.select(*KEYS, y), KEYS, "left")


def missing_cells(df: DataFrame, entities: DataFrame, metrics, start: int, end: int) -> DataFrame:
    """Expected cells with no row at all (a NULL row is present, not
    missing)."""
    grid = expected_grid(entities, metrics, start, end)
    return grid.join(df.select(*KEYS), KEYS, "left_anti")


def coverage_span(df: DataFrame, by=("entity", "metric"), y: str = "value",
                  order: str = "period") -> DataFrame:
    """'first–last (n)' of the periods with a value, or 'NONE'."""
    has = F.col(y).isNotNull()
    out = df.groupBy(*by).agg(
        F.min(F.when(has, F.col(order))).alias("first_period"),
        F.max(F.when(has, F.col(order))).alias("last_period"),
        F.count(y).alias("n"))
    return out.withColumn(
        "span", F.when(F.col("n") == 0, F.lit(SPAN_NONE))
        .otherwise(F.format_string(SPAN_FORMAT, "first_period", "last_period", "n")))


def coverage_matrix(df: DataFrame, metrics, index=("entity",), y: str = "value") -> DataFrame:
    """Non-NULL count per index row and listed metric (wide)."""
    from tidemark.operators.reshape import pivot_agg
    return pivot_agg(df, index, "metric", metrics,
                     lambda c: F.count(F.col(y) if c is None else F.when(c, F.col(y))))


def wide_mean(df: DataFrame, metrics, index=("entity", "period"), y: str = "value") -> DataFrame:
    """Wide table with the mean as the cell aggregate."""
    from tidemark.operators.reshape import pivot_agg
    return pivot_agg(df, index, "metric", metrics,
                     lambda c: F.avg(F.col(y) if c is None else F.when(c, F.col(y))))


def profile(df: DataFrame, by=("metric",), y: str = "gap", digits: int = 1) -> DataFrame:
    from tidemark.functions.exprs import dec_round
    out = df.groupBy(*by).agg(F.min(y).alias("min"), F.max(y).alias("max"),
                              F.avg(F.col(y).cast("double")).alias("mean"),
                              F.count(y).alias("count"))
    return out.select(*by, *[dec_round(c, digits).alias(c) for c in ("min", "max", "mean")],
                      "count")


def nulls_by(df: DataFrame, by=("metric",), y: str = "gap") -> DataFrame:
    """NULL rows per group; groups without NULLs are left out."""
    return (df.groupBy(*by).agg(F.sum(F.col(y).isNull().cast("long")).alias("nulls"))
            .filter(F.col("nulls") > 0))


def rows_per(df: DataFrame, by=("entity",)) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def batch_conflicts(raw: DataFrame, key=("metric", "entity", "period"),
                    y: str = "value") -> DataFrame:
    """Keys whose value differs between batches: two distinct numbers
    (min < max), or a NULL in one batch and a number in another.  Only
    mergeable aggregates (no DISTINCT), so a hot key is combined map-side;
    with one row per key and batch, ``n_rows`` counts the batches."""
    out = raw.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(y).alias("n_values"),
        F.min(y).alias("min_value"), F.max(y).alias("max_value"))
    conflict = ((F.col("min_value") < F.col("max_value"))
                | ((F.col("n_values") > 0) & (F.col("n_values") < F.col("n_rows"))))
    return out.filter(conflict)


def candidate_screen(df: DataFrame, y: str = "value") -> DataFrame:
    """Per metric: entities with no value at all; keep the metric only if
    every entity has at least one value."""
    per = df.groupBy("metric", "entity").agg(F.count(y).alias("nn"))
    return (per.groupBy("metric")
            .agg(F.count(F.lit(1)).alias("n_entities"),
                 F.sum((F.col("nn") == 0).cast("long")).alias("n_empty"),
                 F.min("nn").alias("min_non_null"))
            .withColumn("keep", F.col("n_empty") == 0))


def landing_report(raw: DataFrame, basket: DataFrame) -> DataFrame:
    """Rows landed per basket metric (``basket``: source, metric) and
    batch; a metric without rows in a batch shows 0 and a warning flag."""
    counts = raw.groupBy("source", "metric", "batch_id").agg(F.count(F.lit(1)).alias("rows"))
    # Batches of each source (few per source); basket rows carry their
    # source, so the expected (metric, batch) list is an equi-join on it.
    batches = raw.select("source", "batch_id").distinct()
    expected = basket.select("source", "metric").join(batches, "source")
    return (expected.join(counts, ["source", "metric", "batch_id"], "left")
            .withColumn("rows", F.coalesce("rows", F.lit(0)))
            .withColumn("warn_empty", F.col("rows") == 0))
