"""Queries over stored state: incremental trends, bucketed marts, the keyed
stream, and the landing of documents that span lines."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.operators import moments
from tidemark.plans import marts
from tidemark.plans.queries import _scratch, nation, part, query, raw_and_ledger
from tidemark.sources import bucketed, tables

# The window of the raw batches' trend and the decimals their values keep.
RAW_START, RAW_END = 1995, 2001
VALUE_SCALE = 2


@query("incremental_trend")
def incremental_trend(spark, sf_dir):
    """Three batches land one after another; each moves a stored
    state of moments on, and the trends come from the last state."""
    raw, _ = raw_and_ledger(spark, sf_dir)
    base = _scratch(spark, "moments")
    state = moments.empty_state(spark)
    for b in sorted(tables.STATUS_BATCH.values()):   # fixed batch list, in time order
        batch = raw.filter(F.col("batch_id") == b)
        state = moments.store(moments.advance(state, batch, RAW_START, RAW_END, VALUE_SCALE), f"{base}/{b}")
    return moments.trend_of(state, RAW_START, RAW_END, VALUE_SCALE).drop("slope_num", "slope_den")


def bucketed_gap(spark, sf_dir, panel) -> tables.Panel:
    """The panel with its gap fact stored in buckets of the series."""
    return replace(panel, df=bucketed.write_bucketed(marts.gap_fact(panel), _scratch(spark, "bucketed-gap")))


@query("bucketed_trend")
def bucketed_trend(spark, sf_dir):
    """Trends over the part panel's gap mart in buckets of the
    series, without an exchange."""
    from tidemark.operators.trend import trend
    p = bucketed_gap(spark, sf_dir, part(spark, sf_dir))
    return trend(p.df, p.params.fit_start, p.params.fit_end)


@query("bucketed_agreement")
def bucketed_agreement(spark, sf_dir):
    """Two marts in buckets of the series, joined without an
    exchange."""
    from tidemark.operators.compare import classifier_agreement
    p = nation(spark, sf_dir)
    stuck = bucketed.write_bucketed(marts.stuck_of(p), _scratch(spark, "bucketed-stuck"))
    closing = bucketed.write_bucketed(marts.closing_of(p), _scratch(spark, "bucketed-closing"))
    return classifier_agreement(stuck, closing)


@query("mart_catalog")
def mart_catalog(spark, sf_dir):
    """All marts of the nation panel written and read back, with
    their row and column counts."""
    built = marts.build_marts(spark, tables.nation_panel(spark, sf_dir), _scratch(spark, "marts"))
    return bucketed.read_back(built)


@query("keyed_stream")
def keyed_stream(spark, sf_dir):
    """ST1: record files arrive batch by batch; the stream's state keeps the
    newest row per key, across restarts from the checkpoint."""
    from tidemark.streaming.keyed_stream import keep_newest, keyed_table
    base = _scratch(spark, "keyed")
    rec = tables.raw_batches(spark, sf_dir).select(
        "metric", F.col("entity").alias("economy"), F.concat(F.lit("YR"), F.col("period").cast("string")).alias("time"),
        "value", "batch_id")
    for b in sorted(tables.STATUS_BATCH.values()):   # fixed batch list, in time order
        rec.filter(F.col("batch_id") == b).drop("batch_id").write.json(f"{base}/in/{b}")
        keep_newest(spark, f"{base}/in/*", f"{base}/ckpt")
    return keyed_table(spark, f"{base}/ckpt").select("metric", "entity", "period", "value")


# --- documents that span lines and pages --------------------------------------------

N_PAGES = 3
LOST_PAGE, TWICE_PAGE = ("5-LOW", 2), ("2-HIGH", 3)   # one page is lost on the way, one comes twice


def paged_documents(spark, sf_dir, base):
    """The newest batch as pretty-printed envelopes, a file for each page of
    each request (a metric), written to and read back from a folder."""
    from tidemark.sources.landing import read_documents
    from tidemark.sources.raw import latest_batch
    rows = latest_batch(*raw_and_ledger(spark, sf_dir)).withColumn(
        "page", F.col("period") % N_PAGES + 1)
    row = F.struct(F.struct(F.col("metric").alias("id")).alias("indicator"), F.col("entity").alias("countryiso3code"),
                   F.col("period").cast("string").alias("date"), "value")
    meta = F.struct(F.col("page"), F.lit(N_PAGES).alias("pages"), F.count(F.lit(1)).alias("total"))
    pretty = {"pretty": "true"}
    docs = (rows.groupBy(F.col("metric").alias("request"), "page").agg(meta.alias("meta"), F.collect_list(row).alias("rows"))
            .select("request", "page", F.concat(F.lit("[\n"), F.to_json("meta", pretty), F.lit(",\n"),
                                                F.to_json("rows", pretty), F.lit("\n]")).alias("value")))
    lost = (F.col("request") == LOST_PAGE[0]) & (F.col("page") == LOST_PAGE[1])
    twice = (F.col("request") == TWICE_PAGE[0]) & (F.col("page") == TWICE_PAGE[1])
    copies = F.when(lost, F.array().cast("array<int>")).when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    docs.select("request", "page", F.explode(copies).alias("copy"), "value") \
        .write.partitionBy("request", "page", "copy").text(f"{base}/docs")
    return read_documents(spark, f"{base}/docs").select("value", "request", "file")


@query("land_pages")
def land_pages(spark, sf_dir):
    """Pretty-printed envelopes of several pages, a file each, landed
    whole; the page that came twice lands once."""
    from tidemark.sources.landing import flatten_envelope
    rows, _ = flatten_envelope(paged_documents(spark, sf_dir, _scratch(spark, "pages")))
    return rows.select("metric", "entity", "period", "value").dropDuplicates(["metric", "entity", "period"])


@query("page_report")
def page_report(spark, sf_dir):
    """Pages that requests should have and have not, or have twice."""
    from tidemark.sources.landing import page_report as op
    return op(paged_documents(spark, sf_dir, _scratch(spark, "pages")), "request")


# --- seeds, baskets and stamps ----------------------------------------------------

@query("seed_dim")
def seed_dim(spark, sf_dir):
    """The entity dimension written as a seed CSV and read by the names
    of its header, typed; a further column passes through as text."""
    from tidemark import params as P
    from tidemark.sources.raw import read_dim
    path = _scratch(spark, "seed") + "/entities.csv"
    (tables.nation_entity_dim(spark, sf_dir).withColumn("name_length", F.length("entity"))
     .select("name_length", "entity", "entity_name", "role", "western", "region")
     .write.option("header", True).csv(path))
    return read_dim(spark, path, P.ENTITY_DIM_SCHEMA)


# Fixed baskets: entity lists in order (one entity stands in two of them, one
# has no data) and metric blocks by category.
ENTITY_GROUPS = (("subject", ("NATION_3", "NATION_8", "NATION_13", "NATION_18", "NATION_23")),
                 ("entrant", ("NATION_2", "NATION_7", "NATION_12", "NATION_17", "NATION_22")),
                 ("extra", ("NATION_8", "NATION_99")))
METRIC_BLOCKS = {"fast": [{"code": "1-URGENT", "name": "Urgent orders", "coverage": "full"},
                          {"code": "2-HIGH", "name": "High priority"}],
                 "slow": [{"code": "5-LOW", "name": "Low priority", "coverage": "partial"},
                          {"code": "9-NONE", "name": "Not a priority"}]}


@query("entity_basket")
def entity_basket(spark, sf_dir):
    """The entity lists one after another, duplicates kept, with the
    rows the newest batch has of each."""
    from tidemark.sources.landing import entity_basket as op
    from tidemark.sources.raw import latest_batch
    rows = latest_batch(*raw_and_ledger(spark, sf_dir)).groupBy("entity").agg(F.count(F.lit(1)).alias("n"))
    return (op(spark, ENTITY_GROUPS).join(rows, "entity", "left")
            .select("entity", "group", "pos", F.coalesce("n", F.lit(0)).alias("n_rows")))


@query("metric_basket")
def metric_basket(spark, sf_dir):
    """The metric blocks as rows, with the rows the newest batch has."""
    from tidemark.sources.landing import metric_basket as op
    from tidemark.sources.raw import latest_batch
    rows = latest_batch(*raw_and_ledger(spark, sf_dir)).groupBy("metric").agg(F.count(F.lit(1)).alias("n"))
    basket = op(spark, METRIC_BLOCKS)
    return (basket.join(rows, basket.code == rows.metric, "left")
            .select("code", "name", "coverage", "category", F.coalesce("n", F.lit(0)).alias("n_rows")))


@query("batch_stamp")
def batch_stamp(spark, sf_dir):
    """batch ids stamped from one UTC instant per day of events, with
    the events of the day."""
    from tidemark.sources.raw import batch_id_expr
    ev = tables.read_table(spark, sf_dir, "events")
    instant = F.date_trunc("day", "ts") + F.expr("INTERVAL '9:33:54' HOUR TO SECOND")
    return ev.groupBy(batch_id_expr("EVT", instant).alias("batch_id")).agg(F.count(F.lit(1)).alias("n_rows"))
