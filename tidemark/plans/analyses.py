"""Queries of the series analyses that need more than one pass over a series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import sql
from tidemark.operators import breaks, subpanel
from tidemark.plans import marts
from tidemark.plans.queries import METRIC_A, METRIC_B, events_cells, nation, nation_gap, part, query
from tidemark.sources import drift, tables


@query("best_breaks")
def best_breaks(spark, sf_dir):
    """The best one and two breaks of every part's series."""
    p = part(spark, sf_dir)
    return breaks.best_breaks(marts.gap_fact(p), p.params.fit_start, p.params.fit_end)


@query("best_level_breaks")
def best_level_breaks(spark, sf_dir):
    """The best level shifts of the nation series."""
    p = nation(spark, sf_dir)
    return breaks.best_breaks(marts.gap_fact(p), p.params.fit_start, p.params.fit_end, kind=breaks.LEVEL)


@query("balanced_frontier")
def balanced_frontier(spark, sf_dir):
    """Per number of event types and days, the types and window
    that keep the most users without a missing cell."""
    p = events_cells(spark, sf_dir)
    return subpanel.balanced_frontier(p.df, p.metrics, p.params.fit_start, p.params.fit_end)


@query("largest_balanced")
def largest_balanced(spark, sf_dir):
    """The balanced sub-panel of the users' events with the most cells."""
    p = events_cells(spark, sf_dir)
    return subpanel.largest_balanced(p.df, p.metrics, p.params.fit_start, p.params.fit_end)


@query("sql_years_to_close")
def sql_years_to_close(spark, sf_dir):
    """F1 F4-F7 F10 for SQL users: closing times of all parts, in Spark SQL
    over the registered functions alone."""
    p = part(spark, sf_dir)
    _sql_session(spark, p)
    return spark.sql(SQL_YEARS)


def _sql_session(spark, p) -> None:
    """Panel and metrics as views, the gap as a view over them in SQL, and
    the functions."""
    p.df.createOrReplaceTempView("tm_panel")
    p.metric_dim.createOrReplaceTempView("tm_metric_dim")
    for statement in sql.scalars():
        spark.sql(statement)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW tm_gap_fact AS {SQL_VIEW}")
    sql.register(spark)


SQL_VIEW = f"""
SELECT p.entity, p.metric, p.period, tm_gap(p.value, b.value) AS gap
FROM tm_panel p LEFT JOIN tm_panel b
  ON b.entity = '{tables.PART_BENCHMARK}' AND b.metric = p.metric AND b.period = p.period"""

SQL_YEARS = f"""
WITH t AS (
  SELECT t.*, m.bucket, t.gap_end AS gap_ref, tm_trajectory(t.num, t.den, m.bucket) AS status
  FROM tm_trend({tables.PART_START}, {tables.PART_END}) t JOIN tm_metric_dim m ON t.metric = m.metric
  WHERE m.bucket IN ('convergence', 'context_inverted'))
SELECT entity, metric, slope, status, tm_closure(bucket, gap_ref, status) AS closure_status, gap_ref,
       tm_years(bucket, gap_ref, slope, status) AS years_to_close,
       tm_years_bucket(status, tm_years(bucket, gap_ref, slope, status)) AS years_bucket
FROM t"""


@query("sql_stuck")
def sql_stuck(spark, sf_dir):
    """F4 for SQL users: stuck status of all parts."""
    p = part(spark, sf_dir)
    _sql_session(spark, p)
    return spark.sql(f"""
SELECT t.entity, t.metric, tm_status(t.num, t.den, m.bucket) AS status
FROM tm_trend({tables.PART_START}, {tables.PART_END}) t JOIN tm_metric_dim m ON t.metric = m.metric""")


# --- drifting records --------------------------------------------------------------

KNOWN_PROPS = {"$.k": "bigint"}


def drifted_props(spark, sf_dir):
    """The events' properties as a source that changed its mind would send
    them: each event type has its own shape."""
    k = F.get_json_object("props", "$.k")
    shape = (F.when(F.col("event_type") == "error", F.concat(F.lit('{"k": "'), k, F.lit('"}')))
             .when(F.col("event_type") == "purchase", F.concat(F.lit('{"k": '), k, F.lit(', "extra": {"paid": true}}')))
             .when(F.col("event_type") == "signup", F.concat(F.lit('{"kk": '), k, F.lit("}")))
             .when(F.col("event_type") == "view", F.lit('{"k": '))
             .otherwise(F.col("props")))
    return tables.read_table(spark, sf_dir, "events").select("event_id", shape.alias("props"))


@query("drift_report")
def drift_report(spark, sf_dir):
    """Fields by path and type, with what is known, retyped, unknown."""
    return drift.drift_report(drifted_props(spark, sf_dir), "props", KNOWN_PROPS)


@query("land_drifted")
def land_drifted(spark, sf_dir):
    """The known fields of drifted records, typed."""
    return drift.land_known(drifted_props(spark, sf_dir), "props", KNOWN_PROPS).drop("props")


# --- plain table operators --------------------------------------------------------

@query("complete_rows")
def complete_rows(spark, sf_dir):
    """Wide gap rows with a value in both metrics."""
    from tidemark.operators.reshape import complete_rows as op, to_wide
    p, g = nation_gap(spark, sf_dir)
    return op(to_wide(g, ["entity", "period"], "metric", "gap", (METRIC_A, METRIC_B), unique=True), (METRIC_A, METRIC_B))


@query("coverage_total")
def coverage_total(spark, sf_dir):
    """Rows, values and NULLs of the whole events grid."""
    from tidemark.operators.coverage import coverage
    from tidemark.plans.queries import events_grid
    return coverage(events_grid(spark, sf_dir)[1], [])


@query("transposed")
def transposed(spark, sf_dir):
    """Dispersion per metric and year, turned: one row per year, one
    column per metric."""
    from tidemark.operators.reshape import to_wide, transpose
    p = nation(spark, sf_dir)
    years = [str(y) for y in range(p.params.fit_start, p.params.fit_end + 1)]
    wide = to_wide(marts.dispersion_of(p), ["metric"], "period", "mean_gap", years)
    return transpose(wide, "metric", p.params.dispersion_metrics, years, "period")
