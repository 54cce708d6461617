"""Join helpers with a size rule.

A side is broadcast only when the caller proves an upper bound on its row
count (a configuration list, a fixed-size table, metrics x periods) and
that bound is below ``MAX_BROADCAST_ROWS``.  Otherwise no hint is given:
Catalyst plans from statistics and AQE turns a sort-merge join into a
broadcast join only after measuring the shuffled side at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 2_000_000

KEYS = ("entity", "metric", "period")


def bounded(df: DataFrame, bound: int | None) -> DataFrame:
    if bound is not None and bound <= MAX_BROADCAST_ROWS:
        return F.broadcast(df)
    return df


def semi_in(df: DataFrame, column: str, values) -> DataFrame:
    """Keep rows whose ``column`` is in a parameter list.  The list is
    part of the query text, so an ``IN`` predicate (pushed to the scan
    where possible) is the right form."""
    return df.filter(F.col(column).isin(list(values)))


def scope_by_dim(df: DataFrame, dim: DataFrame | None, key: str, attr: str,
                 values, bound: int | None) -> DataFrame:
    """Keep rows whose key has a dimension attribute in ``values``:
    a left-semi join with the filtered dimension."""
    if dim is None or not values:
        return df
    keys = dim.filter(F.col(attr).isin(list(values))).select(key)
    return df.join(bounded(keys, bound), key, "left_semi")


def enrich(df: DataFrame, entity_dim: DataFrame | None = None,
           metric_dim: DataFrame | None = None, how: str = "left",
           entity_bound: int | None = None) -> DataFrame:
    """Attach dimension columns (after any aggregation, so the group key
    stays (entity, metric)).  The metric dimension is a configuration list
    and always small."""
    if entity_dim is not None:
        df = df.join(bounded(entity_dim, entity_bound), "entity", how)
    if metric_dim is not None:
        df = df.join(F.broadcast(metric_dim), "metric", how)
    return df


def entity_cols(entity_dim: DataFrame | None) -> list[str]:
    if entity_dim is None:
        return ["entity"]
    return ["entity"] + [c for c in entity_dim.columns if c != "entity"]


def metric_cols(metric_dim: DataFrame | None) -> list[str]:
    if metric_dim is None:
        return ["metric"]
    return ["metric"] + [c for c in metric_dim.columns if c != "metric"]
