"""The panel's expressions as SQL functions (F1, F4-F7, F10) for users who
write SQL: session functions without Python, which Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark import params as P
from tidemark.functions.exprs import NUMERIC


def _band(labels: dict, bucket: str, num: str, den: str, bands: P.Bands, scale: int) -> str:
    def at(v):
        return f"cast({v!r} * {10 ** scale} as decimal(20,4)) * {den}"
    c, i = bands.convergence, bands.context_inverted
    return f"""
      WHEN {bucket} = '{P.CONVERGENCE}' THEN CASE WHEN {num} > {at(c)} THEN '{labels['up']}'
           WHEN {num} < -({at(c)}) THEN '{labels['down']}' ELSE '{labels['flat']}' END
      WHEN {bucket} = '{P.CONTEXT_INVERTED}' THEN CASE WHEN {num} < -({at(i)}) THEN '{labels['up']}'
           WHEN {num} > {at(i)} THEN '{labels['down']}' ELSE '{labels['flat']}' END
      ELSE '{labels['not_classified']}' END"""


def scalars(bands: P.Bands = P.Bands()) -> list[str]:
    """CREATE statements of the scalar functions.  The status functions take
    the slope as exact numerator (in hundredths) and denominator."""
    s, t, y = P.STUCK_LABELS, P.TRAJECTORY_LABELS, P.YEARS_BUCKET_LABELS
    b1, b2, b3 = P.YEARS_BUCKET_BOUNDS
    closed = (f"(bucket = '{P.CONVERGENCE}' AND gap >= {P.PARITY}D) OR "
              f"(bucket = '{P.CONTEXT_INVERTED}' AND gap <= {P.PARITY}D)")
    exact = "num decimal(38,0), den decimal(38,0), bucket string"
    return [
        f"""CREATE OR REPLACE TEMPORARY FUNCTION tm_gap(value double, bench double) RETURNS double
            RETURN CASE WHEN bench <> 0 THEN cast(round(try_cast(value / bench * 100 AS {NUMERIC}), 2) AS double) END""",
        f"""CREATE OR REPLACE TEMPORARY FUNCTION tm_status({exact}) RETURNS string
            RETURN CASE WHEN num IS NULL OR den = 0 THEN '{s['no_data']}'
            WHEN bucket = '{P.CONTEXT}' THEN '{s['not_classified']}'{_band(s, 'bucket', 'num', 'den', bands, 2)}""",
        f"""CREATE OR REPLACE TEMPORARY FUNCTION tm_trajectory({exact}) RETURNS string
            RETURN CASE WHEN num IS NULL OR den = 0 THEN '{t['no_data']}'{_band(t, 'bucket', 'num', 'den', bands, 2)}""",
        f"""CREATE OR REPLACE TEMPORARY FUNCTION tm_closure(bucket string, gap double, status string) RETURNS string
            RETURN CASE WHEN {closed} THEN '{P.ALREADY_CLOSED}' ELSE status END""",
        f"""CREATE OR REPLACE TEMPORARY FUNCTION tm_years(bucket string, gap double, slope double, status string)
            RETURNS double
            RETURN CASE WHEN status = '{t['no_data']}' OR gap IS NULL THEN NULL WHEN {closed} THEN 0D
            WHEN status <> '{t['up']}' THEN NULL
            WHEN bucket = '{P.CONVERGENCE}'
              THEN cast(round(try_cast(try_divide({P.PARITY}D - gap, slope) AS {NUMERIC}), 1) AS double)
            WHEN bucket = '{P.CONTEXT_INVERTED}'
              THEN cast(round(try_cast(try_divide(gap - {P.PARITY}D, abs(slope)) AS {NUMERIC}), 1) AS double) END""",
        f"""CREATE OR REPLACE TEMPORARY FUNCTION tm_years_bucket(status string, years double) RETURNS string
            RETURN CASE WHEN status IN ('{t['no_data']}', '{t['down']}', '{t['flat']}') THEN translate(status, '_', ' ')
            WHEN years IS NULL THEN '{y['unknown']}' WHEN years = 0 THEN '{y['closed']}'
            WHEN years < {b1} THEN '{y['lt20']}' WHEN years <= {b2} THEN '{y['le50']}'
            WHEN years <= {b3} THEN '{y['le100']}' ELSE '{y['over']}' END"""]


def trend_function(gap_view: str = "tm_gap_fact") -> str:
    """CREATE statement of ``tm_trend(start, end)``, a table function over
    the view ``gap_view`` (entity, metric, period, gap)."""
    return (
        f"""CREATE OR REPLACE TEMPORARY FUNCTION tm_trend(fit_start int, fit_end int)
            RETURNS TABLE (entity string, metric string, slope double, intercept double, n_points bigint,
                           gap_start double, gap_end double, num decimal(38,0), den decimal(38,0))
            RETURN SELECT entity, metric, regr_slope(gap, period), regr_intercept(gap, period), count(gap), max(at_start),
              max(at_end), CASE WHEN count(gap) > 0 THEN cast(count(gap) * sum(x * cents) - sum(x) * sum(cents)
                                                              AS decimal(38,0)) END,
              cast(count(gap) * sum(x * x) - sum(x) * sum(x) AS decimal(38,0))
            FROM (SELECT entity, metric, period, gap, CASE WHEN gap IS NOT NULL THEN period - fit_start END AS x,
                         cast(try_cast(round(gap * 100) AS bigint) AS decimal(20,0)) AS cents,
                         CASE WHEN period = fit_start THEN gap END AS at_start,
                         CASE WHEN period = fit_end THEN gap END AS at_end
                  FROM {gap_view} WHERE period BETWEEN fit_start AND fit_end)
            GROUP BY entity, metric""")


def register(spark: SparkSession, bands: P.Bands = P.Bands(), gap_view: str = "tm_gap_fact") -> None:
    """Create the functions in the session; the view must exist first."""
    for statement in (*scalars(bands), trend_function(gap_view)):
        spark.sql(statement)
