"""Readers for the driver's Parquet tables and the panels derived from them.

Each panel is a Spark job over the whole input tables: joins, one
aggregation with partial (map-side) combine, then an unpivot to the long
``(entity, metric, period, value)`` shape.  Nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import params as P
from tidemark.params import PanelParams


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ts_range(c: str, start_year: int, end_year: int):
    """Half-open timestamp range on whole years; a plain comparison on the
    raw column so Parquet receives it as a pushed filter."""
    lo = F.lit(f"{start_year}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{end_year + 1}-01-01 00:00:00").cast("timestamp_ntz")
    return (F.col(c) >= lo) & (F.col(c) < hi)


@dataclass
class Panel:
    """A long panel plus its dimensions and parameters.

    ``entity_bound`` / ``bench_bound`` are proven upper limits on the row
    counts of the entity dimension and of the benchmark slice; a side is
    broadcast only when such a bound exists and is small.
    """
    df: DataFrame
    entity_dim: DataFrame | None
    metric_dim: DataFrame
    params: PanelParams
    metrics: tuple[str, ...]
    entity_bound: int | None = None
    bench_bound: int | None = None


# ---------------------------------------------------------------------------
# Nation panel: entity = nation, period = order year, benchmark = ALL.
# ---------------------------------------------------------------------------
NATION_BENCHMARK = "ALL"
NATION_START, NATION_END = 1995, 2000
NATION_NO_LOW = "NATION_3"  # its low-priority series is forced missing
URGENT = "1-URGENT"
LOW = "5-LOW"

# Fixed metric catalogue of the nation panel: code, friendly name, bucket.
NATION_METRICS = (
    ("AOV", "Average order value", P.CONVERGENCE),
    ("URGENT_SHARE", "Urgent order share (%)", P.CONTEXT_INVERTED),
    ("LOW_AOV", "Average low-priority order value", P.CONVERGENCE),
    ("ORDERS", "Orders placed", P.CONTEXT),
)
# Fixed role of each region.
REGION_ROLES = {
    "EUROPE": "subject", "ASIA": "entrant", "AMERICA": "success",
    "AFRICA": "core", "MIDDLE EAST": "core",
}
WESTERN_REGIONS = ("EUROPE", "AMERICA")
SUBJECT_ROLES = ("subject", "entrant", "success")

NATION_PARAMS = PanelParams(
    benchmark=NATION_BENCHMARK, fit_start=NATION_START, fit_end=NATION_END,
    ref_period=NATION_END, closure_roles=SUBJECT_ROLES,
    dispersion_roles=("subject",),
    dispersion_metrics=("AOV", "URGENT_SHARE", "LOW_AOV"),
    descriptive_roles=SUBJECT_ROLES,
)

# TPC-H fixes nation at 25 rows at every scale factor.
NATION_ROWS = 25


def metric_dim(spark: SparkSession, catalogue) -> DataFrame:
    return spark.createDataFrame(list(catalogue), P.METRIC_DIM_SCHEMA)


def nation_entity_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    role_map = F.create_map(*[F.lit(x) for kv in REGION_ROLES.items() for x in kv])
    dim = (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
           .select(F.col("n_name").alias("entity"),
                   F.concat(F.lit("Nation "), F.col("n_nationkey").cast("string")).alias("entity_name"),
                   role_map[F.col("r_name")].alias("role"),
                   F.col("r_name").isin(*WESTERN_REGIONS).alias("western"),
                   F.col("r_name").alias("region")))
    bench = spark.createDataFrame(
        [(NATION_BENCHMARK, "All nations", "benchmark", None, None)],
        P.ENTITY_DIM_SCHEMA)
    return dim.unionByName(bench)


def nation_cells(spark: SparkSession, sf_dir: str,
                 start: int = NATION_START, end: int = NATION_END) -> DataFrame:
    """Wide cells (entity, period, AOV, URGENT_SHARE, LOW_AOV, ORDERS).

    One grouping-sets aggregate gives the nation rows and the ``ALL``
    benchmark rows in the same pass over the joined orders.
    """
    orders = (read_table(spark, sf_dir, "orders")
              .filter(ts_range("o_orderdate", start, end))
              .select("o_custkey", "o_totalprice", "o_orderpriority",
                      F.year("o_orderdate").cast("int").alias("period")))
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")))
    hundred, zero = F.lit(100.0).cast("double"), F.lit(0.0).cast("double")
    low = (F.col("o_orderpriority") == LOW) & (F.col("n_name") != NATION_NO_LOW)
    cells = base.groupingSets([["n_name", "period"], ["period"]], "n_name", "period").agg(
        F.grouping("n_name").alias("_g"),
        F.avg("o_totalprice").alias("AOV"),
        F.avg(F.when(F.col("o_orderpriority") == URGENT, hundred).otherwise(zero))
        .alias("URGENT_SHARE"),
        F.avg(F.when(low, F.col("o_totalprice"))).alias("LOW_AOV"),
        F.count(F.lit(1)).cast("double").alias("ORDERS"))
    return cells.select(
        F.when(F.col("_g") == 1, F.lit(NATION_BENCHMARK)).otherwise(F.col("n_name"))
        .alias("entity"),
        "period", "AOV", "URGENT_SHARE", "LOW_AOV", "ORDERS")


def to_long(wide: DataFrame, ids, metrics) -> DataFrame:
    """Unpivot metric columns to (ids..., metric, value); NULL cells kept."""
    return (wide.unpivot(list(ids), list(metrics), "metric", "value")
            .select("entity", "metric", F.col("period").cast("int").alias("period"),
                    F.col("value").cast("double").alias("value")))


def nation_panel(spark: SparkSession, sf_dir: str) -> Panel:
    metrics = tuple(m for m, _, _ in NATION_METRICS)
    df = to_long(nation_cells(spark, sf_dir), ["entity", "period"], metrics)
    n_periods = NATION_END - NATION_START + 1
    return Panel(df=df, entity_dim=nation_entity_dim(spark, sf_dir),
                 metric_dim=metric_dim(spark, NATION_METRICS), params=NATION_PARAMS,
                 metrics=metrics, entity_bound=NATION_ROWS + 1,
                 bench_bound=len(metrics) * n_periods)


# ---------------------------------------------------------------------------
# Raw table with batches: key = (nation, priority, year), one batch per
# order status.  Same keys land in several batches with other values.
# ---------------------------------------------------------------------------
# Fixed batch of each order status (sorts b1 < b2 < b3).
STATUS_BATCH = {"F": "b1", "O": "b2", "P": "b3"}
RAW_SOURCE = "ORD"


def raw_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus",
        F.year("o_orderdate").cast("int").alias("period"))
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    batch_map = F.create_map(*[F.lit(x) for kv in STATUS_BATCH.items() for x in kv])
    base = (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
            .withColumn("batch_id", batch_map[F.col("o_orderstatus")]))
    return (base.groupBy("batch_id", F.col("o_orderpriority").alias("metric"),
                         F.col("n_name").alias("entity"), "period")
            .agg(F.avg("o_totalprice").alias("value"))
            .select(F.lit(RAW_SOURCE).alias("source"), "metric", "entity", "period",
                    "value", F.current_timestamp().alias("ingested_at"), "batch_id"))


# ---------------------------------------------------------------------------
# Events panel: entity = user, metric = event type, period = day of year,
# value = sum of event values.  Sparse; benchmark = average over users.
# ---------------------------------------------------------------------------
EVENTS_BENCHMARK = "ALL"
# Fixed bucket of each event type.
EVENT_METRICS = (
    ("click", "Clicks value", P.CONVERGENCE),
    ("error", "Errors value", P.CONTEXT_INVERTED),
    ("purchase", "Purchases value", P.CONVERGENCE),
    ("signup", "Signups value", P.CONVERGENCE),
    ("view", "Views value", P.CONTEXT),
)
EVENTS_PARAMS = PanelParams(
    benchmark=EVENTS_BENCHMARK, fit_start=1, fit_end=30, ref_period=30,
    dispersion_metrics=("click", "error", "purchase", "signup"))


def events_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return (ev.groupBy(F.col("user_id").cast("string").alias("entity"),
                       F.col("event_type").alias("metric"),
                       F.dayofyear("ts").cast("int").alias("period"))
            .agg(F.sum("value").alias("value")))


def events_panel(spark: SparkSession, sf_dir: str, with_benchmark: bool = True) -> Panel:
    cells = events_cells(spark, sf_dir)
    df = cells
    if with_benchmark:
        bench = (cells.groupBy("metric", "period").agg(F.avg("value").alias("value"))
                 .select(F.lit(EVENTS_BENCHMARK).alias("entity"), "metric", "period", "value"))
        df = cells.unionByName(bench)
    metrics = tuple(m for m, _, _ in EVENT_METRICS)
    return Panel(df=df, entity_dim=None, metric_dim=metric_dim(spark, EVENT_METRICS),
                 params=EVENTS_PARAMS, metrics=metrics, entity_bound=None,
                 bench_bound=len(metrics) * 366)


# ---------------------------------------------------------------------------
# Part panel: entity = part, period = ship year; many entities.
# ---------------------------------------------------------------------------
PART_BENCHMARK = "ALL"
PART_START, PART_END = 1995, 2001
PART_METRICS = (
    ("AVG_PRICE", "Average line price", P.CONVERGENCE),
    ("RETURN_SHARE", "Returned line share (%)", P.CONTEXT_INVERTED),
    ("DISCOUNT", "Average discount (%)", P.CONTEXT),
)
PART_PARAMS = PanelParams(
    benchmark=PART_BENCHMARK, fit_start=PART_START, fit_end=PART_END,
    ref_period=PART_END, dispersion_metrics=("AVG_PRICE", "RETURN_SHARE"))


def part_panel(spark: SparkSession, sf_dir: str) -> Panel:
    li = (read_table(spark, sf_dir, "lineitem")
          .filter(ts_range("l_shipdate", PART_START, PART_END))
          .select("l_partkey", "l_extendedprice", "l_discount", "l_returnflag",
                  F.year("l_shipdate").cast("int").alias("period")))
    hundred, zero = F.lit(100.0).cast("double"), F.lit(0.0).cast("double")
    cells = li.groupingSets([["l_partkey", "period"], ["period"]], "l_partkey", "period").agg(
        F.grouping("l_partkey").alias("_g"),
        F.avg("l_extendedprice").alias("AVG_PRICE"),
        F.avg(F.when(F.col("l_returnflag") == "R", hundred).otherwise(zero)).alias("RETURN_SHARE"),
        F.avg(F.col("l_discount") * 100).alias("DISCOUNT"))
    cells = cells.select(
        F.when(F.col("_g") == 1, F.lit(PART_BENCHMARK))
        .otherwise(F.col("l_partkey").cast("string")).alias("entity"),
        "period", "AVG_PRICE", "RETURN_SHARE", "DISCOUNT")
    metrics = tuple(m for m, _, _ in PART_METRICS)
    return Panel(df=to_long(cells, ["entity", "period"], metrics), entity_dim=None,
                 metric_dim=metric_dim(spark, PART_METRICS), params=PART_PARAMS,
                 metrics=metrics, entity_bound=None,
                 bench_bound=len(metrics) * (PART_END - PART_START + 1))


def persist_panel(panel: Panel, name: str = "panel", watch=None) -> Panel:
    """Write the long panel once to the shared folder and continue from
    the written table.

    The panel is an aggregate of the fact tables; the gap needs it twice
    (all rows, and the benchmark slice), so without this the fact scan,
    join and aggregation would run twice.  The files are sorted by
    (metric, entity, period) inside each task so a benchmark or metric
    filter skips row groups, and the written table cuts the lineage: a lost
    executor does not send the job back to the fact tables.  A ``watch``
    observes its checks in the same job.
    """
    import uuid

    from tidemark.session import shared_dir
    spark = panel.df.sparkSession
    path = shared_dir(spark, "tidemark-panels", f"{name}-{uuid.uuid4().hex}")
    df = panel.df.sortWithinPartitions("metric", "entity", "period")
    (watch.on(df) if watch else df).write.mode("overwrite").parquet(path)
    return replace(panel, df=spark.read.schema(panel.df.schema).parquet(path))
