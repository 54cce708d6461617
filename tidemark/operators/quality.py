"""Data-quality operators (A9, A10, DQ1-DQ10).

Each check returns a DataFrame of violations: empty means pass.
``run_checks`` turns a list of checks into one report row per check.

Checks that a row alone decides (NULLs, accepted values, row counts, label
and closing-time invariants) need no reading of the table: a ``Watch`` rides
on the job that writes it and has the same report rows when it is done.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import params as P


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def null_counts(df: DataFrame, columns=None) -> DataFrame:
    """NULL count of every column in a single pass: (column, nulls)."""
    columns = list(columns or df.columns)
    agg = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    return agg.selectExpr(f"stack({len(columns)}, {stack}) as (`column`, nulls)")


def accepted_values(df: DataFrame, column: str, values) -> DataFrame:
    """Offending values and their counts; NULL passes."""
    c = F.col(column)
    return (df.filter(c.isNotNull() & ~c.isin(list(values)))
            .groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")))


def unique(df: DataFrame, column: str) -> DataFrame:
    return grain_unique(df.filter(F.col(column).isNotNull()), [column])


def grain_unique(df: DataFrame, keys) -> DataFrame:
    """Keys present more than once."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def row_count_is(df: DataFrame, expected: int) -> DataFrame:
    """One row (the actual count) when the count differs."""
    return (df.agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") != expected))


def null_inside(start: int, end: int, y: str = "value") -> Column:
    return F.col("period").between(start, end) & F.col(y).isNull()


def unlisted_null(start: int, end: int, allow, y: str = "value") -> Column:
    """A NULL inside the window outside the ``allow`` list of (entity, metric)
    pairs, a parameter list."""
    listed = F.lit(False)
    for entity, metric in allow:
        listed = listed | ((F.col("entity") == entity) & (F.col("metric") == metric))
    return null_inside(start, end, y) & ~listed


def only_known_nulls(df: DataFrame, start: int, end: int, allow: DataFrame,
                     y: str = "value") -> DataFrame:
    """NULL values inside the window except the allowed (entity, metric)
    pairs (a small parameter list)."""
    nulls = df.filter(null_inside(start, end, y))
    return nulls.join(allow.select("entity", "metric"), ["entity", "metric"], "left_anti")


def status_fault(context_exempt_no_data: bool = False) -> Column:
    """Four invariants of the stuck status: context is never classified;
    directed buckets get a directed label or no_data; no_data exactly when
    the slope is NULL (outside context)."""
    lab = P.STUCK_LABELS
    b, st, s = F.col("bucket"), F.col("status"), F.col("slope")
    ctx_bad = (b == P.CONTEXT) & (st != lab["not_classified"])
    if context_exempt_no_data:
        ctx_bad = ctx_bad & ~((st == lab["no_data"]) & s.isNull())
    return (ctx_bad
            | (b.isin(P.CONVERGENCE, P.CONTEXT_INVERTED)
               & ~st.isin(lab["up"], lab["down"], lab["flat"], lab["no_data"]))
            | ((st == lab["no_data"]) & s.isNotNull())
            | ((st != lab["no_data"]) & (b != P.CONTEXT) & s.isNull()))


def status_scoping(stuck: DataFrame, context_exempt_no_data: bool = False) -> DataFrame:
    return stuck.filter(status_fault(context_exempt_no_data))


def closing_time_fault() -> Column:
    """Never negative; already-closed rows show exactly 0."""
    y = F.col("years_to_close")
    return (y < 0) | ((F.col("closure_status") == P.ALREADY_CLOSED)
                      & ~y.eqNullSafe(F.lit(0.0)))


def closing_time_valid(closing: DataFrame) -> DataFrame:
    return closing.filter(closing_time_fault())


def closing_null_fault() -> Column:
    """0 only when closed; no figure for stalled/diverging/no_data that are
    not closed; a figure for every open catching_up row."""
    lab = P.TRAJECTORY_LABELS
    y, cs, st = F.col("years_to_close"), F.col("closure_status"), F.col("status")
    open_ = cs != P.ALREADY_CLOSED
    return (((y == 0) & open_)
            | (open_ & st.isin(lab["flat"], lab["down"], lab["no_data"]) & y.isNotNull())
            | (open_ & (st == lab["up"]) & y.isNull()))


def closing_time_null_scoping(closing: DataFrame) -> DataFrame:
    return closing.filter(closing_null_fault())


def run_checks(checks) -> DataFrame:
    """``checks``: iterable of (check name, table name, violations
    DataFrame) -> (check, table, n_violations), one row each.  Each count
    is a global aggregate of its own check; the union runs them in one
    job."""
    rows = [v.agg(F.count(F.lit(1)).alias("n_violations"))
            .select(F.lit(name).alias("check"), F.lit(table).alias("table"), "n_violations")
            for name, table, v in checks]
    return reduce(DataFrame.unionByName, rows)


REPORT_SCHEMA = "check string, table string, n_violations long"

# Distinct offending values are told apart by a hash of so many bits, which
# bounds what a task and the driver hold however much rubbish a column has.
VALUE_BITS = 18


class Watch:
    """Checks of one table, observed by the job that writes it.

    Add checks, pass the frame through ``on`` and run one action on it;
    ``report_rows`` then has what ``run_checks`` would count by reading the
    table, without reading it.  Every metric is an aggregate with map-side
    combine, and what reaches the driver is one row.  A job that is run twice
    reports its first run.
    """

    def __init__(self, table: str):
        self.table = table
        self._metrics: list[tuple[str, str, Column, object]] = []
        self._seen: Observation | None = None

    def _add(self, check: str, label: str | None, metric: Column, to_count) -> Watch:
        self._metrics.append((check, label or self.table, metric, to_count))
        return self

    def rows(self, check: str, bad: Column, label: str | None = None) -> Watch:
        """Rows for which ``bad`` holds."""
        return self._add(check, label, F.count_if(bad), int)

    def not_null(self, column: str, label: str | None = None) -> Watch:
        return self.rows("not_null", F.col(column).isNull(), label)

    def accepted_values(self, column: str, values, label: str | None = None) -> Watch:
        """Distinct values outside the list, as in ``accepted_values``; beyond
        some hundreds of them the number is a lower bound."""
        c = F.col(column)
        bad = c.isNotNull() & ~c.isin(list(values))
        mark = F.when(bad, F.pmod(F.xxhash64(c), F.lit(1 << VALUE_BITS)).cast("int"))
        return self._add("accepted_values", label, F.size(F.collect_set(mark)), int)

    def row_count(self, expected: int, label: str | None = None) -> Watch:
        return self._add("row_count", label, F.count(F.lit(1)), lambda n: int(n != expected))

    def on(self, df: DataFrame) -> DataFrame:
        self._seen = Observation()
        return df.observe(self._seen, F.count(F.lit(1)).alias("n_rows"),
                          *[m.alias(f"m{i}") for i, (_, _, m, _) in enumerate(self._metrics)])

    @property
    def n_rows(self) -> int:
        """Rows written."""
        return self._seen.get["n_rows"]

    def report_rows(self) -> list[tuple[str, str, int]]:
        got = self._seen.get
        return [(check, label, to_count(got[f"m{i}"])) for i, (check, label, _, to_count) in enumerate(self._metrics)]


def observed_report(spark: SparkSession, watches) -> DataFrame:
    """The report rows of watches whose jobs have run, as ``run_checks``."""
    return spark.createDataFrame([r for w in watches for r in w.report_rows()], REPORT_SCHEMA)
