"""Parameters, fixed label sets and schemas.

The label strings, bucket names, band widths and year-bucket bounds below
are fixed values: results are only comparable when they are exactly these.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written)
# ---------------------------------------------------------------------------
# Metric classes.
CONVERGENCE = "convergence"          # higher is better
CONTEXT_INVERTED = "context_inverted"  # lower is better
CONTEXT = "context"                  # never classified
GOVERNANCE = "governance"            # descriptive only
BUCKETS = (CONVERGENCE, CONTEXT_INVERTED, CONTEXT, GOVERNANCE)

# Dead bands (points per period), strict inequalities.
CONVERGENCE_BAND = 0.2
INVERTED_BAND = 2.0

# Status labels of the stuck matrix.
STUCK_LABELS = {
    "up": "catching_up", "down": "falling_behind", "flat": "stuck",
    "no_data": "no_data", "not_classified": "not_classified",
}
# Status labels of the closing-time table.
TRAJECTORY_LABELS = {
    "up": "catching_up", "down": "diverging", "flat": "stalled",
    "no_data": "no_data", "not_classified": "not_classified",
}
ALREADY_CLOSED = "already_closed"

# Benchmark level in percent.
PARITY = 100.0

# Numeric codes of the status grid.
STATUS_CODES = {"catching_up": 0, "stuck": 1, "falling_behind": 2, "no_data": 3}

# Years buckets: labels and upper bounds (first < 20, then <= 50, <= 100).
YEARS_BUCKET_LABELS = {
    "unknown": "unknown", "closed": "already closed", "lt20": "under 20 yrs",
    "le50": "20-50 yrs", "le100": "50-100 yrs", "over": "100+ yrs",
}
YEARS_BUCKET_BOUNDS = (20, 50, 100)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Bands:
    convergence: float = CONVERGENCE_BAND
    context_inverted: float = INVERTED_BAND


@dataclass(frozen=True)
class PanelParams:
    """Everything a mart needs besides the data."""
    benchmark: str
    fit_start: int
    fit_end: int
    ref_period: int
    bands: Bands = field(default_factory=Bands)
    closure_roles: tuple[str, ...] = ()
    closure_buckets: tuple[str, ...] = (CONVERGENCE, CONTEXT_INVERTED)
    dispersion_entities: tuple[str, ...] | None = None
    dispersion_roles: tuple[str, ...] | None = None
    dispersion_metrics: tuple[str, ...] | None = None
    descriptive_roles: tuple[str, ...] = ()


# Long panel: one row per entity x metric x period.
PANEL_SCHEMA = T.StructType([
    T.StructField("entity", T.StringType(), False),
    T.StructField("metric", T.StringType(), False),
    T.StructField("period", T.IntegerType(), False),
    T.StructField("value", T.DoubleType(), True),
])

# Append-only raw landing table; batch_id is the partition column and must
# sort by time as a string.
RAW_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("metric", T.StringType(), False),
    T.StructField("entity", T.StringType(), False),
    T.StructField("period", T.IntegerType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("ingested_at", T.TimestampType(), False),
    T.StructField("batch_id", T.StringType(), False),
])

ENTITY_DIM_SCHEMA = T.StructType([
    T.StructField("entity", T.StringType(), False),
    T.StructField("entity_name", T.StringType(), True),
    T.StructField("role", T.StringType(), True),
    T.StructField("western", T.BooleanType(), True),
    T.StructField("region", T.StringType(), True),
])

METRIC_DIM_SCHEMA = T.StructType([
    T.StructField("metric", T.StringType(), False),
    T.StructField("friendly_name", T.StringType(), True),
    T.StructField("bucket", T.StringType(), True),
])

# One record of the record-style source: {economy, time: "YR2008", value}.
RECORD_SCHEMA = T.StructType([
    T.StructField("economy", T.StringType(), True),
    T.StructField("time", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
])

# One row of the envelope payload [meta, [rows]].
ENVELOPE_ROW_SCHEMA = T.StructType([
    T.StructField("indicator", T.StructType([
        T.StructField("id", T.StringType(), True)]), True),
    T.StructField("countryiso3code", T.StringType(), True),
    T.StructField("date", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
])
