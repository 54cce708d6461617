"""Build job: raw table -> newest batch -> panel -> five marts + DQ report.

The Spark counterpart of the reference's build step, as a script for
``spark-submit``:

    spark-submit tidemark/plans/job.py --raw <raw parquet> \
        --entities roles.csv --metrics metrics.csv --benchmark ALL \
        --start 2014 --end 2024 --ref 2024 --closure-roles a,b,c --out <dir>

Dimension CSVs have the columns of ``ENTITY_DIM_SCHEMA`` /
``METRIC_DIM_SCHEMA``.  Output goes to ``--out`` (default: a folder under
``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import params as P
from tidemark.operators import quality as Q
from tidemark.plans.marts import build_marts
from tidemark.session import shared_dir
from tidemark.sources.raw import latest_batch, read_dim, read_ledger, read_raw
from tidemark.sources.tables import Panel


def panel_from_raw(spark: SparkSession, raw: DataFrame, entity_dim: DataFrame,
                   metric_dim: DataFrame, params: P.PanelParams, n_metrics: int,
                   entity_bound: int | None = None, ledger: DataFrame | None = None) -> Panel:
    """Staging (newest batch) as a panel.  The benchmark slice is bounded
    by metrics x periods of the window, which is what allows its
    broadcast."""
    staged = latest_batch(raw, ledger).select("entity", "metric", "period", "value")
    n_periods = params.fit_end - params.fit_start + 1
    return Panel(df=staged, entity_dim=entity_dim, metric_dim=metric_dim, params=params,
                 metrics=(), entity_bound=entity_bound, bench_bound=n_metrics * n_periods)


def mart_watches(expected_rows: int | None = None) -> dict[str, Q.Watch]:
    """The checks that are observed while the panel and its marts are written."""
    w = {t: Q.Watch(t) for t in ("panel", "gap", "stuck", "closing", "dispersion", "descriptive")}
    for t, cols in (("gap", ("entity", "metric", "period")), ("stuck", ("entity", "metric", "status")),
                    ("closing", ("entity", "metric", "status", "closure_status")),
                    ("dispersion", ("metric", "period", "n")),
                    ("descriptive", ("entity", "metric", "period", "role"))):
        for c in cols:
            w[t].not_null(c, label=f"{t}.{c}")
    closing_labels = list(P.TRAJECTORY_LABELS.values())
    w["stuck"].accepted_values("status", list(P.STUCK_LABELS.values()), label="stuck.status")
    w["closing"].accepted_values("status", closing_labels, label="closing.status")
    w["closing"].accepted_values("closure_status", closing_labels + [P.ALREADY_CLOSED],
                                 label="closing.closure_status")
    w["stuck"].rows("status_scoping", Q.status_fault())
    w["closing"].rows("closing_time_valid", Q.closing_time_fault())
    w["closing"].rows("closing_time_null_scoping", Q.closing_null_fault())
    if expected_rows is not None:
        w["panel"].row_count(expected_rows, label="staging")
    return w


def _list(text: str) -> tuple[str, ...]:
    return tuple(x.strip() for x in text.split(",") if x.strip())


def run(spark: SparkSession, args) -> dict:
    entity_dim = read_dim(spark, args.entities, P.ENTITY_DIM_SCHEMA)
    metric_dim = read_dim(spark, args.metrics, P.METRIC_DIM_SCHEMA)
    params = P.PanelParams(
        benchmark=args.benchmark, fit_start=args.start, fit_end=args.end, ref_period=args.ref,
        closure_roles=_list(args.closure_roles),
        dispersion_roles=_list(args.dispersion_roles) or None,
        dispersion_metrics=_list(args.dispersion_metrics) or None,
        descriptive_roles=_list(args.descriptive_roles))
    # Seed files are small configuration lists; their row counts bound the
    # broadcast of the dimensions.
    n_metrics = metric_dim.count()
    n_entities = entity_dim.count()
    panel = panel_from_raw(spark, read_raw(spark, args.raw), entity_dim, metric_dim, params,
                           n_metrics, entity_bound=n_entities, ledger=read_ledger(spark, args.raw))
    out = args.out or shared_dir(spark, "tidemark-marts", uuid.uuid4().hex)
    watches = mart_watches(args.expected_rows)
    marts = build_marts(spark, panel, out, watches=watches)
    # What a row alone decides was observed by the jobs that wrote the
    # marts; only what needs a shuffle reads them again.
    observed = Q.observed_report(spark, watches.values())
    report = observed.unionByName(Q.run_checks([
        ("grain_unique", "gap", Q.grain_unique(marts["gap"], ["entity", "metric", "period"])),
        ("grain_unique", "stuck", Q.grain_unique(marts["stuck"], ["entity", "metric"])),
        ("grain_unique", "closing", Q.grain_unique(marts["closing"], ["entity", "metric"])),
        ("unique", "entity_dim", Q.unique(entity_dim, "entity")),
        ("unique", "metric_dim", Q.unique(metric_dim, "metric")),
        ("accepted_values", "metric_dim", Q.accepted_values(metric_dim, "bucket", P.BUCKETS)),
    ])).withColumn("checked_at", F.current_timestamp())
    report.write.mode("overwrite").parquet(f"{out}/dq_report")
    marts["dq_report"] = spark.read.parquet(f"{out}/dq_report")
    return marts


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--raw", required=True)
    ap.add_argument("--entities", required=True)
    ap.add_argument("--metrics", required=True)
    ap.add_argument("--benchmark", required=True)
    ap.add_argument("--start", type=int, required=True)
    ap.add_argument("--end", type=int, required=True)
    ap.add_argument("--ref", type=int, required=True)
    ap.add_argument("--closure-roles", default="")
    ap.add_argument("--dispersion-roles", default="")
    ap.add_argument("--dispersion-metrics", default="")
    ap.add_argument("--descriptive-roles", default="")
    ap.add_argument("--expected-rows", type=int, default=None,
                    help="exact row count of the newest batch (completeness check)")
    ap.add_argument("--out", default=None)
    args = ap.parse_args(argv)
    from tidemark.session import build_session
    spark = build_session()
    run(spark, args)


if __name__ == "__main__":
    main()
