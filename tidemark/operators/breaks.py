"""Best breaks of a series (X17, X1): least-squares segments.

A series is cut into two (or three) runs of points, each with its own line or
level, so that the sum of squared residuals is least.  Prefix moments give the
residuals of any run in constant time; with two breaks, the best first break
for every second one is found in one vector step per second break, so memory
stays linear in the length of a series.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import importable

LINE, LEVEL = "line", "level"
OUT = "n long, sse0 double, break1 int, sse1 double, break2a int, break2b int, sse2 double"


def _residuals(m: np.ndarray, kind: str) -> np.ndarray:
    """Squared residuals of runs with moments m[..., (n, x, y, xx, xy, yy)].
    Moments are sums of whole numbers, so only the division here rounds."""
    n, x, y, xx, xy, yy = (m[..., i] for i in range(6))
    a, b, c = n * yy - y * y, n * xy - x * y, n * xx - x * x
    with np.errstate(divide="ignore", invalid="ignore"):
        out = a / n if kind == LEVEL else np.where(c > 0, (a - b * b / np.where(c > 0, c, 1.0)) / n, a / n)
    return np.maximum(out, 0.0)


def best_splits(x: np.ndarray, y: np.ndarray, least: int, kind: str) -> tuple:
    """(sse0, break1, sse1, break2a, break2b, sse2) of series of one length:
    ``x`` and ``y`` are (series, points).  A break is the place of the first
    point of the next run; -1 where the series is too short.  Of splits that
    tie the earliest is taken, first by the first break."""
    s, n = x.shape
    terms = np.stack([np.ones_like(x), x, y, x * x, x * y, y * y], axis=-1)
    prefix = np.concatenate([np.zeros((s, 1, 6)), np.cumsum(terms, axis=1)], axis=1)
    total = prefix[:, -1:]
    none = np.full(s, -1), np.full(s, np.nan)
    sse0 = _residuals(total, kind)[:, 0]
    one = two = None
    if n >= 2 * least:
        at = np.arange(least, n - least + 1)
        cost = _residuals(prefix[:, at], kind) + _residuals(total - prefix[:, at], kind)
        i = np.argmin(cost, axis=1)
        one = at[i], cost[np.arange(s), i]
    if n >= 3 * least:
        a, b, best = np.full(s, n), np.full(s, n), np.full(s, np.inf)
        for j in range(2 * least, n - least + 1):
            at = np.arange(least, j - least + 1)
            cost = (_residuals(prefix[:, at], kind) + _residuals(prefix[:, j:j + 1] - prefix[:, at], kind)
                    + _residuals(total - prefix[:, j:j + 1], kind))
            i = np.argmin(cost, axis=1)
            first, c = at[i], cost[np.arange(s), i]
            better = (c < best) | ((c == best) & (first < a))
            a, b, best = np.where(better, first, a), np.where(better, j, b), np.where(better, c, best)
        two = a, b, best
    return sse0, *(one or none), *(two or (none[0], none[0], none[1]))


def _fit(least: int, kind: str, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points = b.column(2)
            cuts = points.offsets.to_numpy()
            x, y = (points.flatten().field(i).to_numpy() for i in range(2))
            size, base = np.diff(cuts), cuts[0]
            out = [np.zeros(b.num_rows) for _ in range(6)]
            for n in np.unique(size):
                rows = np.flatnonzero(size == n)
                at = (cuts[rows] - base)[:, None] + np.arange(n)
                px, py = x[at].astype(np.float64), y[at].astype(np.float64)
                first_x, first_y = px[:, :1], py[:, :1]
                got = best_splits(px - first_x, py - first_y, least, kind)
                for k, g in enumerate(got):
                    if k in (1, 3, 4):  # a place -> the period there
                        g = np.where(g >= 0, px[np.arange(len(rows)), np.maximum(g, 0)], np.nan)
                    out[k][rows] = g
            unit = float(10 ** (2 * scale))
            whole = [pa.array(np.nan_to_num(o).astype(np.int32), mask=np.isnan(o)) if k in (1, 3, 4)
                     else pa.array(o / unit, mask=np.isnan(o)) for k, o in enumerate(out)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(size.astype(np.int64)), *whole],
                                             names=["entity", "metric", *[c.split()[0] for c in OUT.split(", ")]])
    return run


def best_breaks(df: DataFrame, start: int, end: int, y: str = "gap", scale: int = 2, least: int = 2,
                kind: str = LINE) -> DataFrame:
    """One row per series with points in [start, end]: ``n``, ``sse0`` (no
    break), ``break1`` and ``sse1`` (the best single break: the first period
    after it), ``break2a``, ``break2b`` and ``sse2`` (the best two).

    Every run has at least ``least`` points; shorter series have NULL breaks.
    ``y`` counts in units of 10^-scale, as whole numbers up to 2^53; NULL
    values are no points.  Series hold at most one point per period (the
    panel grain), so the array of a series is bounded by the periods.  Ties
    go to the earlier first break, then the earlier second.
    """
    if least < 1 or kind not in (LINE, LEVEL):
        raise ValueError("runs have at least one point and are 'line' or 'level'")
    importable(df.sparkSession)
    unit = F.round(F.col(y) * (10 ** scale)).try_cast("long")
    points = (df.where(F.col("period").between(start, end) & unit.isNotNull())
              .groupBy("entity", "metric")
              .agg(F.sort_array(F.collect_list(F.struct(F.col("period").cast("long").alias("x"),
                                                        unit.alias("y")))).alias("points")))
    return points.mapInArrow(_fit(least, kind, scale), f"entity string, metric string, {OUT}")
