"""tidemark: panel analytics on Spark.

A long panel is a DataFrame of ``(entity, metric, period, value)``.  The
operators in :mod:`tidemark.operators` compute gaps against a benchmark
entity, linear trends, dead-band status labels, closing-time extrapolation,
cross-section dispersion, coverage audits, reshapes and data-quality
reports.  Everything is plain DataFrame code; no Python UDF is used.

The most used entry points are re-exported here.
"""

from tidemark.params import Bands, PanelParams  # noqa: F401
from tidemark.operators.gap import gap_mart, gap_to_benchmark, with_benchmark  # noqa: F401
from tidemark.operators.trend import stuck_matrix, trend, years_to_close  # noqa: F401
from tidemark.operators.dispersion import dispersion, scoped_dispersion  # noqa: F401
from tidemark.operators.rank import count_below, value_rank  # noqa: F401
from tidemark.sources.raw import (append_batch, latest_batch, latest_per_key,  # noqa: F401
                                  read_raw, stamp_batch)
from tidemark.sources.tables import Panel  # noqa: F401
from tidemark.plans.marts import build_marts  # noqa: F401

__all__ = ["Bands", "PanelParams", "Panel", "gap_mart", "gap_to_benchmark", "with_benchmark",
           "trend", "stuck_matrix", "years_to_close", "dispersion", "scoped_dispersion",
           "count_below", "value_rank", "read_raw", "stamp_batch", "append_batch",
           "latest_batch", "latest_per_key", "build_marts"]
