"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (through a panel derived from them
by Spark) and runs over whole tables.  Floating outputs leave through
``finish`` (decimal rounding) so two engines agree on the value hash.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import params as P

from tidemark.functions.exprs import edge_round
from tidemark.plans import marts
from tidemark.session import prepare
from tidemark.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Output rounding for floating columns (digits); intercepts carry the
# cancellation of slope x mean period, so they keep 4.
EDGE_DIGITS = 6
EDGE_OVERRIDES = {"intercept": 4}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return finish(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def finish(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            cols.append(edge_round(f.name, EDGE_OVERRIDES.get(f.name, EDGE_DIGITS))
                        .alias(f.name))
        else:
            cols.append(df[f.name])
    return df.select(*cols)


def nation(spark, sf_dir) -> tables.Panel:
    """The nation panel, written once and read back (see persist_panel)."""
    return tables.persist_panel(tables.nation_panel(spark, sf_dir), "nation")


# --- core marts -------------------------------------------------------------

@query("gap_to_benchmark")
def gap_to_benchmark(spark, sf_dir):
    """Value as percent of the benchmark entity."""
    from tidemark.operators.gap import gap_to_benchmark as op
    p = nation(spark, sf_dir)
    return op(p.df, p.params.benchmark, p.bench_bound)


@query("gap_enriched")
def gap_enriched(spark, sf_dir):
    """Gap mart with entity and metric dimensions (left joins)."""
    return marts.gap_of(nation(spark, sf_dir))


@query("trend_slope")
def trend_slope(spark, sf_dir):
    """Slope, intercept, n, endpoints, change."""
    from tidemark.operators.trend import trend
    p = nation(spark, sf_dir)
    return trend(marts.gap_fact(p), p.params.fit_start, p.params.fit_end)


@query("stuck_matrix")
def stuck_matrix(spark, sf_dir):
    """stuck-matrix status per series."""
    return marts.stuck_of(nation(spark, sf_dir))


@query("years_to_close")
def years_to_close(spark, sf_dir):
    """Trajectory, closure status and closing time."""
    return marts.closing_of(nation(spark, sf_dir))


@query("dispersion")
def dispersion(spark, sf_dir):
    """F2 A4 A5: n, mean, sd, cv of the gap per metric and period."""
    return marts.dispersion_of(nation(spark, sf_dir))


@query("descriptive_panel")
def descriptive_panel(spark, sf_dir):
    """Window + role scope, inner enrichment."""
    return marts.descriptive_of(nation(spark, sf_dir))


# --- shared pieces -------------------------------------------------------------

def nation_gap(spark, sf_dir):
    p = nation(spark, sf_dir)
    return p, marts.gap_fact(p)


def events_grid(spark, sf_dir):
    """Events panel on its full expected grid (users x event types x days),
    NULL where a user had no event of a type on a day."""
    from tidemark.operators.coverage import complete_grid
    p = events_cells(spark, sf_dir)
    users = p.df.select("entity").distinct()
    return p, complete_grid(p.df, users, p.metrics, p.params.fit_start, p.params.fit_end)


def events_cells(spark, sf_dir) -> tables.Panel:
    """Events panel without benchmark rows, written once (the grid needs
    the cells and the user list; both come from this one table)."""
    return tables.persist_panel(tables.events_panel(spark, sf_dir, with_benchmark=False),
                                "events-cells")


def raw_table(spark, sf_dir):
    """The batches derived from orders, landed once as an append-only
    Parquet table partitioned by batch_id in the shared folder, then read
    back with the fixed raw schema (so batch filters prune partitions)."""
    return raw_and_ledger(spark, sf_dir)[0]


def raw_and_ledger(spark, sf_dir):
    """The raw table and its ledger of landed batches."""
    import uuid
    from tidemark.session import shared_dir
    from tidemark.sources.raw import append_batch, read_ledger, read_raw
    path = shared_dir(spark, "tidemark-raw", f"raw-{uuid.uuid4().hex}")
    append_batch(tables.raw_batches(spark, sf_dir), path)
    return read_raw(spark, path), read_ledger(spark, path)


# Fixed parameters of the analyses on the nation panel.
SPIKE_THRESHOLD = 5.0
TOP_K = 3
LAST_N = 3
PAIR = ("NATION_8", "NATION_2")          # dominance: subject vs entrant
METRIC_A, METRIC_B = "AOV", "LOW_AOV"    # income-like vs productivity-like
RANK_METRICS = ("AOV", "URGENT_SHARE")
REFERENCE_ROLES = ("core",)
LABEL_NEEDLE = "europ"
LABEL_EXTRA = ("NATION_0", "NATION_1")
RAW_EXPECTED_ROWS = 25 * 5 * 7           # nations x priorities x years


# --- display tables ----------------------------------------------------------------

@query("years_bucket")
def years_bucket(spark, sf_dir):
    """Closing-time display bucket."""
    from tidemark.operators.reshape import years_bucket as op
    c = op(marts.closing_of(nation(spark, sf_dir)))
    return c.select("entity", "metric", "status", "years_to_close", "years_bucket")


@query("status_grid")
def status_grid(spark, sf_dir):
    """Entity x metric grid of status codes."""
    from tidemark.operators.reshape import status_grid as op
    return op(marts.stuck_of(nation(spark, sf_dir)), ("AOV", "URGENT_SHARE", "LOW_AOV"))


@query("dispersion_shape")
def dispersion_shape(spark, sf_dir):
    """start/end/peak/trough of the CV path and its change."""
    from tidemark.operators.dispersion import dispersion_shape as op
    p = nation(spark, sf_dir)
    return op(marts.dispersion_of(p), p.params.fit_start, p.params.fit_end)


@query("balanced_panel")
def balanced_panel(spark, sf_dir):
    """Is the contributor count constant over the window."""
    from tidemark.operators.dispersion import balanced_panel as op
    return op(marts.dispersion_of(nation(spark, sf_dir)))


# --- raw batches -------------------------------------------------------------------

@query("latest_batch")
def latest_batch(spark, sf_dir):
    """Rows of the newest batch."""
    from tidemark.sources.raw import latest_batch as op
    return op(*raw_and_ledger(spark, sf_dir))


@query("latest_per_key")
def latest_per_key(spark, sf_dir):
    """Newest row per key across batches."""
    from tidemark.sources.raw import latest_per_key as op
    return op(raw_table(spark, sf_dir))


@query("batch_conflicts")
def batch_conflicts(spark, sf_dir):
    """Keys whose value differs between batches."""
    from tidemark.operators.coverage import batch_conflicts as op
    return op(raw_table(spark, sf_dir))


@query("landing_report")
def landing_report(spark, sf_dir):
    """Rows per basket metric and batch, zero rows shown."""
    from tidemark.operators.coverage import landing_report as op
    raw = raw_table(spark, sf_dir)
    basket = spark.createDataFrame(
        [(tables.RAW_SOURCE, m) for m in RAW_PRIORITIES], "source string, metric string")
    return op(raw, basket)


# Fixed basket of the raw table: the five order priorities.
RAW_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


# --- coverage on the sparse events grid --------------------------------------------

@query("complete_grid")
def complete_grid(spark, sf_dir):
    """Every expected cell, explicit NULLs."""
    return events_grid(spark, sf_dir)[1]


@query("missing_cells")
def missing_cells(spark, sf_dir):
    """Expected cells without a row."""
    from tidemark.operators.coverage import missing_cells as op
    p = events_cells(spark, sf_dir)
    users = p.df.select("entity").distinct()
    return op(p.df, users, p.metrics, p.params.fit_start, p.params.fit_end)


@query("coverage_by_metric")
def coverage_by_metric(spark, sf_dir):
    """Rows / non-null / nulls per metric."""
    from tidemark.operators.coverage import coverage
    return coverage(events_grid(spark, sf_dir)[1], ["metric"])


@query("coverage_by_entity")
def coverage_by_entity(spark, sf_dir):
    """A2: rows / non-null / nulls per entity."""
    from tidemark.operators.coverage import coverage
    return coverage(events_grid(spark, sf_dir)[1], ["entity"])


@query("coverage_span")
def coverage_span(spark, sf_dir):
    """A16: 'first–last (n)' or NONE per entity x metric."""
    from tidemark.operators.coverage import coverage_span as op
    return op(events_grid(spark, sf_dir)[1])


@query("coverage_matrix")
def coverage_matrix(spark, sf_dir):
    """Non-null count per entity and metric, wide."""
    from tidemark.operators.coverage import coverage_matrix as op
    p, g = events_grid(spark, sf_dir)
    return op(g, p.metrics)


@query("wide_mean")
def wide_mean(spark, sf_dir):
    """Wide table with the mean as cell aggregate."""
    from tidemark.operators.coverage import wide_mean as op
    p = events_cells(spark, sf_dir)
    return op(p.df, p.metrics)


@query("candidate_screen")
def candidate_screen(spark, sf_dir):
    """Keep metrics with a value for every entity."""
    from tidemark.operators.coverage import candidate_screen as op
    return op(events_grid(spark, sf_dir)[1])


# --- profiles on the nation gap mart ------------------------------------------------

@query("profile")
def profile(spark, sf_dir):
    """Min / max / mean / count of the gap per metric."""
    from tidemark.operators.coverage import profile as op
    return op(nation_gap(spark, sf_dir)[1])


@query("nulls_by_metric")
def nulls_by_metric(spark, sf_dir):
    """NULL gaps per metric (groups with NULLs only)."""
    from tidemark.operators.coverage import nulls_by
    return nulls_by(nation_gap(spark, sf_dir)[1])


@query("rows_per_entity")
def rows_per_entity(spark, sf_dir):
    """A13."""
    from tidemark.operators.coverage import rows_per
    return rows_per(nation_gap(spark, sf_dir)[1])


@query("distinct_keys")
def distinct_keys(spark, sf_dir):
    """A17."""
    from tidemark.operators.coverage import distinct_keys as op
    return op(nation_gap(spark, sf_dir)[1], "entity")


@query("axis_range")
def axis_range(spark, sf_dir):
    """Common axis of the gap."""
    from tidemark.operators.reshape import axis_range as op
    return op(nation_gap(spark, sf_dir)[1])


# --- cohorts and tiers --------------------------------------------------------------

@query("cohort_means")
def cohort_means(spark, sf_dir):
    """Mean gap change by the cohort flag."""
    from tidemark.operators.compare import cohort_means as op
    s = marts.stuck_of(nation(spark, sf_dir)).filter(
        F.col("role").isin(*tables.SUBJECT_ROLES))
    return op(s, "western", METRIC_A)


@query("tier_gap")
def tier_gap(spark, sf_dir):
    """Tier means per period and their difference."""
    from tidemark.operators.compare import tier_gap as op
    p, g = nation_gap(spark, sf_dir)
    return op(g, p.entity_dim, METRIC_A, "subject", "entrant", p.params.fit_start,
              p.params.fit_end, p.entity_bound)


@query("mean_gain")
def mean_gain(spark, sf_dir):
    """Mean gap change per metric over the subject tier."""
    from tidemark.operators.compare import mean_gain as op
    return op(marts.stuck_of(nation(spark, sf_dir)), roles=("subject",),
              metrics=(METRIC_A, METRIC_B))


# --- ordered operators ------------------------------------------------------------------

@query("delta")
def delta(spark, sf_dir):
    """Period-on-period change of the 1-decimal gap."""
    from tidemark.operators.reshape import delta as op
    g = nation_gap(spark, sf_dir)[1].select("entity", "metric", "period", "gap")
    return op(g, digits=1)


@query("spikes")
def spikes(spark, sf_dir):
    """Spike-and-reversal points."""
    from tidemark.operators.reshape import spikes as op
    return op(nation_gap(spark, sf_dir)[1], SPIKE_THRESHOLD)


@query("series_shape")
def series_shape(spark, sf_dir):
    """X2 per series: peak, trough, monotonicity."""
    from tidemark.operators.reshape import series_shape as op
    p, g = nation_gap(spark, sf_dir)
    return op(g, p.params.fit_start, p.params.fit_end)


@query("last_value")
def last_value(spark, sf_dir):
    """Last observation of each series."""
    from tidemark.operators.reshape import last_value as op
    return op(nation_gap(spark, sf_dir)[1])


@query("endpoints")
def endpoints(spark, sf_dir):
    """Values at two periods with an 'NA' display fallback."""
    from tidemark.operators.reshape import endpoints as op
    p, g = nation_gap(spark, sf_dir)
    return op(g, p.params.fit_start, p.params.fit_end)


@query("slope_since_peak")
def slope_since_peak(spark, sf_dir):
    """Slope from the peak period to the window end."""
    from tidemark.operators.reshape import slope_since_peak as op
    p, g = nation_gap(spark, sf_dir)
    return op(g, p.params.fit_start, p.params.fit_end)


@query("to_wide")
def to_wide(spark, sf_dir):
    """Long -> wide over listed metrics."""
    from tidemark.operators.reshape import to_wide as op
    p, g = nation_gap(spark, sf_dir)
    return op(g, ["entity", "period"], "metric", "gap", p.metrics)


@query("snapshot_rank")
def snapshot_rank(spark, sf_dir):
    """Rank per metric at the reference period, margin to the next."""
    from tidemark.operators.compare import snapshot_rank as op
    p = nation(spark, sf_dir)
    df = p.df.filter(F.col("entity") != p.params.benchmark)
    return op(df, p.params.ref_period, group_bound=len(p.metrics))


@query("top_extremes")
def top_extremes(spark, sf_dir):
    """K largest gaps per metric."""
    from tidemark.operators.reshape import top_extremes as op
    g = nation_gap(spark, sf_dir)[1].select("entity", "metric", "period", "gap")
    return op(g.filter("entity <> 'ALL'"), TOP_K)


@query("last_n_periods")
def last_n_periods(spark, sf_dir):
    """Rows of the last n periods per metric."""
    from tidemark.operators.reshape import last_n_periods as op
    return op(nation(spark, sf_dir).df, LAST_N)


# --- trend analyses ------------------------------------------------------------------

@query("loo_slope")
def loo_slope(spark, sf_dir):
    """Leave-one-period-out slope."""
    from tidemark.operators.trend import loo_slope as op
    p, g = nation_gap(spark, sf_dir)
    return op(g, p.params.fit_start, p.params.fit_end)


@query("endpoint_vs_trend")
def endpoint_vs_trend(spark, sf_dir):
    """Endpoint change against the trend-implied change."""
    from tidemark.operators.trend import endpoint_vs_trend as op
    p = nation(spark, sf_dir)
    return op(marts.stuck_of(p), p.params.fit_start, p.params.fit_end)


@query("abs_slope_stats")
def abs_slope_stats(spark, sf_dir):
    """Mean / min absolute slope per bucket."""
    from tidemark.operators.trend import abs_slope_stats as op
    return op(marts.stuck_of(nation(spark, sf_dir)))


@query("band_margin")
def band_margin(spark, sf_dir):
    """Distance of each slope to its dead band."""
    from tidemark.operators.trend import band_margin as op
    p = nation(spark, sf_dir)
    return op(marts.stuck_of(p), p.params.bands)


@query("scenario_years")
def scenario_years(spark, sf_dir):
    """What-if closing time at the other metric's pace."""
    from tidemark.operators.compare import scenario_years as op
    return op(marts.closing_of(nation(spark, sf_dir)), METRIC_A, METRIC_B)


@query("metric_ratio")
def metric_ratio(spark, sf_dir):
    """Closing-time ratio of two metrics in one entity."""
    from tidemark.operators.compare import metric_ratio as op
    return op(marts.closing_of(nation(spark, sf_dir)), METRIC_A, METRIC_B)


@query("classifier_agreement")
def classifier_agreement(spark, sf_dir):
    """Stuck labels vs trajectory labels."""
    from tidemark.operators.compare import classifier_agreement as op
    p = nation(spark, sf_dir)
    return op(marts.stuck_of(p), marts.closing_of(p))


# --- comparisons -------------------------------------------------------------------

@query("dominance")
def dominance(spark, sf_dir):
    """Is A above B in every period; first overtaking period."""
    from tidemark.operators.compare import dominance as op
    p, g = nation_gap(spark, sf_dir)
    return op(g, PAIR[0], PAIR[1], bench_bound=p.bench_bound)


@query("rank_reversal")
def rank_reversal(spark, sf_dir):
    """Ranks on two metrics and the shift."""
    from tidemark.operators.compare import rank_reversal as op
    p = nation(spark, sf_dir)
    df = p.df.filter(F.col("entity") != p.params.benchmark)
    return op(df, p.params.ref_period, *RANK_METRICS, group_bound=len(p.metrics))


@query("tier_position")
def tier_position(spark, sf_dir):
    """Reference-tier entities below each subject entity."""
    from tidemark.operators.compare import tier_position as op
    p = nation(spark, sf_dir)
    n_periods = p.params.fit_end - p.params.fit_start + 1
    return op(p.df, p.entity_dim, REFERENCE_ROLES, tables.SUBJECT_ROLES,
              group_bound=len(p.metrics) * n_periods, entity_bound=p.entity_bound)


@query("benchmark_breaks")
def benchmark_breaks(spark, sf_dir):
    """Benchmark dips that recover within one period."""
    from tidemark.operators.reshape import benchmark_breaks as op
    p = nation(spark, sf_dir)
    return op(p.df, p.params.benchmark)


# --- landing -------------------------------------------------------------------------

@query("parse_period")
def parse_period_q(spark, sf_dir):
    """S3 F16: record rows with 'YR<year>' periods flattened."""
    from tidemark.sources.landing import flatten_records
    orders = tables.read_table(spark, sf_dir, "orders")
    customer = tables.read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nat = tables.read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rec = (orders.join(customer, orders.o_custkey == customer.c_custkey)
           .join(F.broadcast(nat), F.col("c_nationkey") == F.col("n_nationkey"))
           .groupBy(F.col("n_name").alias("economy"),
                    F.concat(F.lit("YR"), F.year("o_orderdate").cast("string")).alias("time"))
           .agg(F.avg("o_totalprice").alias("value")))
    return flatten_records(rec, "AOV")


@query("flatten_props")
def flatten_props(spark, sf_dir):
    """JSON element access on events.props."""
    ev = tables.read_table(spark, sf_dir, "events")
    return ev.select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


@query("label_search")
def label_search(spark, sf_dir):
    """P10: lower-cased substring search OR list membership."""
    nat = tables.read_table(spark, sf_dir, "nation")
    reg = tables.read_table(spark, sf_dir, "region")
    j = nat.join(F.broadcast(reg), nat.n_regionkey == reg.r_regionkey)
    from tidemark.functions.exprs import joined, strip_prefix
    hit = F.lower("r_name").contains(LABEL_NEEDLE) | F.col("n_name").isin(*LABEL_EXTRA)
    return j.filter(hit).select("n_name", "r_name",
                                strip_prefix("n_name", "NATION_").alias("code"),
                                joined(" / ", "r_name", "n_name").alias("label"))


# --- data quality ---------------------------------------------------------------------

def _dq_checks(spark, sf_dir):
    """(check, table, function that gives the violations).  A table is built
    by the first check that reads it, once."""
    from tidemark.operators import quality as Q
    from tidemark.sources.raw import latest_batch as latest
    panel = cache(lambda: nation(spark, sf_dir))
    landed = cache(lambda: raw_and_ledger(spark, sf_dir))
    stuck = cache(lambda: marts.stuck_of(panel()))
    closing = cache(lambda: marts.closing_of(panel()))

    def known_nulls():
        p = panel()
        allow = spark.createDataFrame([(tables.NATION_NO_LOW, METRIC_B)], "entity string, metric string")
        return Q.only_known_nulls(p.df, p.params.fit_start, p.params.fit_end, allow)

    return [
        ("not_null", "gap", lambda: Q.not_null(marts.gap_of(panel()), "gap")),
        ("accepted_values", "closing", lambda: Q.accepted_values(
            closing(), "status", list(P.STUCK_LABELS.values()))),
        ("unique", "entity_dim", lambda: Q.unique(tables.nation_entity_dim(spark, sf_dir), "role")),
        ("grain_unique", "raw", lambda: Q.grain_unique(landed()[0], ["metric", "entity", "period"])),
        ("row_count", "latest_batch", lambda: Q.row_count_is(latest(*landed()), RAW_EXPECTED_ROWS)),
        ("only_known_nulls", "panel", known_nulls),
        ("status_scoping", "stuck", lambda: Q.status_scoping(stuck())),
        ("closing_time_valid", "closing", lambda: Q.closing_time_valid(closing())),
        ("closing_time_null_scoping", "closing", lambda: Q.closing_time_null_scoping(closing())),
    ]


def _dq(idx):
    def fn(spark, sf_dir):
        return _dq_checks(spark, sf_dir)[idx][2]()
    return fn


for _i, _name in enumerate(["dq_not_null", "dq_accepted_values", "dq_unique",
                            "dq_grain_unique", "dq_row_count", "dq_only_known_nulls",
                            "dq_status_scoping", "dq_closing_time_valid",
                            "dq_closing_time_null_scoping"]):
    query(_name)(_dq(_i))


@query("dq_null_counts")
def dq_null_counts(spark, sf_dir):
    """DQ1 in one pass: NULLs per column of the gap mart."""
    from tidemark.operators.quality import null_counts
    return null_counts(marts.gap_of(nation(spark, sf_dir)))


@query("dq_report")
def dq_report(spark, sf_dir):
    """DQ10: one row per check.  The panel and three marts are written, and
    what their rows alone decide is observed while they are; only the checks
    that need a shuffle read a table."""
    from tidemark.operators import quality as Q
    prm = tables.NATION_PARAMS
    panel_watch = Q.Watch("panel").rows("only_known_nulls", Q.unlisted_null(
        prm.fit_start, prm.fit_end, [(tables.NATION_NO_LOW, METRIC_B)]))
    panel = tables.persist_panel(tables.nation_panel(spark, sf_dir), "nation", panel_watch)
    watches = {
        "gap": Q.Watch("gap").not_null("gap"),
        "stuck": Q.Watch("stuck").rows("status_scoping", Q.status_fault()),
        "closing": (Q.Watch("closing").accepted_values("status", list(P.STUCK_LABELS.values()))
                    .rows("closing_time_valid", Q.closing_time_fault())
                    .rows("closing_time_null_scoping", Q.closing_null_fault()))}
    base = _scratch(spark, "marts")
    gap = marts.materialize(marts.gap_of(panel), f"{base}/gap", watch=watches["gap"])
    marts.materialize(marts.stuck_of(panel, gap), f"{base}/stuck", watch=watches["stuck"])
    marts.materialize(marts.closing_of(panel, gap), f"{base}/closing", watch=watches["closing"])
    rest = [(name, table, make()) for name, table, make in _dq_checks(spark, sf_dir)
            if name in ("unique", "grain_unique", "row_count")]
    return Q.observed_report(spark, [panel_watch, *watches.values()]).unionByName(Q.run_checks(rest))


# The four checks that find nothing in sound marts, on marts spoilt on purpose.

@query("dq_nulls_unlisted")
def dq_nulls_unlisted(spark, sf_dir):
    """DQ6 without its list: the missing series are violations."""
    from tidemark.operators.quality import only_known_nulls
    p = nation(spark, sf_dir)
    nobody = spark.createDataFrame([], "entity string, metric string")
    return only_known_nulls(p.df, p.params.fit_start, p.params.fit_end, nobody)


@query("dq_spoilt_status")
def dq_spoilt_status(spark, sf_dir):
    """DQ7: one nation's rows all not classified, another's all without data."""
    from tidemark.operators.quality import status_scoping
    spoilt = marts.stuck_of(nation(spark, sf_dir)).withColumn(
        "status", F.when(F.col("entity") == SPOILT[0], P.STUCK_LABELS["not_classified"])
        .when(F.col("entity") == SPOILT[1], P.STUCK_LABELS["no_data"]).otherwise(F.col("status")))
    return status_scoping(spoilt).select("entity", "metric")


@query("dq_spoilt_time")
def dq_spoilt_time(spark, sf_dir):
    """DQ8: every figure negated, closed rows without one."""
    from tidemark.operators.quality import closing_time_valid
    spoilt = marts.closing_of(nation(spark, sf_dir)).withColumn(
        "years_to_close", F.when(F.col("closure_status") != P.ALREADY_CLOSED, -F.col("years_to_close")))
    return closing_time_valid(spoilt).select("entity", "metric")


@query("dq_spoilt_nulls")
def dq_spoilt_nulls(spark, sf_dir):
    """DQ9: a figure where there is none, and none where there is one."""
    from tidemark.operators.quality import closing_time_null_scoping
    y = F.col("years_to_close")
    spoilt = marts.closing_of(nation(spark, sf_dir)).withColumn("years_to_close", F.when(y.isNull(), y.isNull().cast(
        "double")))
    return closing_time_null_scoping(spoilt).select("entity", "metric")


SPOILT = ("NATION_0", "NATION_1")


# --- landing round trips ---------------------------------------

def _scratch(spark, name):
    import uuid
    from tidemark.session import shared_dir
    return shared_dir(spark, "tidemark-landing", f"{name}-{uuid.uuid4().hex}")


@query("land_envelope")
def land_envelope(spark, sf_dir):
    """Raw series -> envelope JSON files -> flattened, stamped rows
    appended to a raw table partitioned by batch -> newest batch."""
    from tidemark.sources.landing import envelope_documents, land_envelopes
    from tidemark.sources.raw import append_batch, latest_batch, read_ledger, read_raw
    base = _scratch(spark, "envelope")
    raw = tables.raw_batches(spark, sf_dir)
    envelope_documents(raw).write.partitionBy("batch_id").text(f"{base}/docs")
    docs = spark.read.text(f"{base}/docs")
    for b in sorted(tables.STATUS_BATCH.values()):   # fixed batch list, in time order
        landed, _ = land_envelopes(docs.filter(F.col("batch_id") == b).select("value"),
                                   "ENV", f"env_{b}")
        append_batch(landed, f"{base}/raw")
    return latest_batch(read_raw(spark, f"{base}/raw"), read_ledger(spark, f"{base}/raw"))


@query("landing_rejects")
def landing_rejects(spark, sf_dir):
    """Envelope rows without an entity or with an unreadable period,
    counted by reason.  One metric loses its entities and one year its
    digits before the rows go into envelopes."""
    from tidemark.sources.landing import envelope_documents, land_envelopes
    raw = tables.raw_batches(spark, sf_dir)
    spoilt = (raw.withColumn("entity", F.when(F.col("metric") != SPOILT_METRIC, F.col("entity")))
              .withColumn("period", F.when(F.col("period") == SPOILT_YEAR, F.lit("n/a"))
                          .otherwise(F.col("period").cast("string"))))
    _, rejected = land_envelopes(envelope_documents(spoilt), "ENV", "env_1")
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


# What the reject query spoils.
SPOILT_METRIC, SPOILT_YEAR = "5-LOW", 1996


@query("land_stream")
def land_stream(spark, sf_dir):
    """ST1: record files landed incrementally, one micro-batch per file
    group; the newest row per key afterwards."""
    from tidemark.sources.raw import latest_per_key, read_raw
    from tidemark.streaming.landing_stream import land_stream as run
    base = _scratch(spark, "stream")
    raw = tables.raw_batches(spark, sf_dir)
    rec = raw.select("metric", F.col("entity").alias("economy"),
                     F.concat(F.lit("YR"), F.col("period").cast("string")).alias("time"),
                     "value", "batch_id")
    # Batches arrive one after another in the watched folder; after each
    # arrival the stream runs with the same checkpoint and lands only the
    # new files, as its own micro-batch (so later batches get higher ids).
    for b in sorted(tables.STATUS_BATCH.values()):   # fixed batch list, in time order
        rec.filter(F.col("batch_id") == b).drop("batch_id") \
            .write.mode("overwrite").json(f"{base}/in/{b}")
        run(spark, f"{base}/in/*", f"{base}/raw", f"{base}/ckpt", source="REC")
    return latest_per_key(read_raw(spark, f"{base}/raw"))


# --- many-entity panels -------------------------------------------------------------

def part(spark, sf_dir) -> tables.Panel:
    return tables.persist_panel(tables.part_panel(spark, sf_dir), "part")


def events(spark, sf_dir) -> tables.Panel:
    return tables.persist_panel(tables.events_panel(spark, sf_dir), "events")


@query("part_gap")
def part_gap(spark, sf_dir):
    """J1 F1 on the part panel (one entity per part)."""
    return marts.gap_fact(part(spark, sf_dir))


@query("part_stuck_matrix")
def part_stuck_matrix(spark, sf_dir):
    """F3 F4 on the part panel."""
    return marts.stuck_of(part(spark, sf_dir))


@query("part_years_to_close")
def part_years_to_close(spark, sf_dir):
    """F5-F7 on the part panel (no role scope)."""
    return marts.closing_of(part(spark, sf_dir))


@query("part_dispersion")
def part_dispersion(spark, sf_dir):
    """F2 across all parts per metric and year."""
    return marts.dispersion_of(part(spark, sf_dir))


@query("events_gap")
def events_gap(spark, sf_dir):
    """J1 F1 on the sparse events panel; benchmark = mean over users."""
    return marts.gap_fact(events(spark, sf_dir))


# --- display and staging extras ---------------------------------------------------

SNAPSHOT_TOP_N = 5


@query("snapshot_top")
def snapshot_top(spark, sf_dir):
    """Wide snapshot at the reference period, sorted by one metric
    (descending, ties by entity), first n rows.  The limit is the feature;
    Spark plans it as a TakeOrdered (per-task top n, then a final top n)."""
    from tidemark.operators.reshape import to_wide
    p, g = nation_gap(spark, sf_dir)
    snap = g.filter(F.col("period") == p.params.ref_period)
    wide = to_wide(snap, ["entity"], "metric", "gap", p.metrics)
    return wide.orderBy(F.col(METRIC_A).desc_nulls_last(), "entity").limit(SNAPSHOT_TOP_N)


@query("superseded_keys")
def superseded_keys_q(spark, sf_dir):
    """Keys of older batches missing from the newest batch (the newest
    batch is not a superset of the older ones)."""
    from tidemark.sources.raw import superseded_keys
    raw, ledger = raw_and_ledger(spark, sf_dir)
    return superseded_keys(raw, ledger=ledger)


@query("scope_to_basket")
def scope_to_basket_q(spark, sf_dir):
    """Newest-batch rows restricted to an entity basket (the
    subject and entrant nations), a metric basket and a period window."""
    from tidemark.sources.landing import entity_basket, metric_basket, scope_to_basket
    from tidemark.sources.raw import latest_batch
    ents = entity_basket(spark, BASKET_ENTITIES)
    mets = metric_basket(spark, BASKET_METRICS).withColumnRenamed("code", "metric")
    return scope_to_basket(latest_batch(*raw_and_ledger(spark, sf_dir)), ents, mets,
                           BASKET_START, BASKET_END)


# Fixed basket of the scoping query.
BASKET_ENTITIES = (("subject", [f"NATION_{i}" for i in range(3, 25, 5)]),
                   ("entrant", [f"NATION_{i}" for i in range(2, 25, 5)]))
BASKET_METRICS = {"priorities": [{"code": "1-URGENT", "name": "Urgent"}, {"code": "5-LOW", "name": "Low"}]}
BASKET_START, BASKET_END = 1996, 1999


# --- ratios and extremes from the published analyses ----------------------------------

SHIFT_AT = 1998
EXTREME_K = 6


@query("abs_slope_ratio")
def abs_slope_ratio(spark, sf_dir):
    """Mean |slope| of the inverted bucket over the convergence bucket,
    and the smallest inverted |slope|."""
    from tidemark.operators.trend import bucket_ratio
    return bucket_ratio(marts.stuck_of(nation(spark, sf_dir)), F.abs(F.col("slope")))


@query("mean_gain_ratio")
def mean_gain_ratio(spark, sf_dir):
    """Mean gap change of metric A over metric B for the subject tier."""
    s = marts.stuck_of(nation(spark, sf_dir)).filter(F.col("role") == "subject")
    g = F.col("gap_change").cast("double")
    a = F.avg(F.when(F.col("metric") == METRIC_A, g))
    b = F.avg(F.when(F.col("metric") == METRIC_B, g))
    return (s.agg(a.alias("mean_a"), b.alias("mean_b"))
            .withColumn("ratio", F.try_divide(F.col("mean_a"), F.col("mean_b"))))


@query("top_abs_extremes")
def top_abs_extremes_q(spark, sf_dir):
    """The k gaps farthest from parity per metric."""
    from tidemark.operators.reshape import top_abs_extremes
    g = nation_gap(spark, sf_dir)[1].select("entity", "metric", "period", "gap")
    return top_abs_extremes(g.filter("entity <> 'ALL'"), EXTREME_K, center=100.0)


@query("level_shift")
def level_shift_q(spark, sf_dir):
    """Benchmark mean before / after a period, per metric."""
    from tidemark.operators.reshape import level_shift
    p = nation(spark, sf_dir)
    return level_shift(p.df, p.params.benchmark, SHIFT_AT)


# Further queries register themselves.
from tidemark.plans import analyses, stored  # noqa: E402, F401
