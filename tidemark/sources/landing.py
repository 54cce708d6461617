"""Landing of source documents.

Two document shapes:

* records ``{economy, time: "YR2008", value}`` (JSON lines);
* envelopes ``[meta, [rows]]`` with ``meta.pages`` and rows
  ``{indicator: {id}, countryiso3code, date, value}``, one envelope per
  text row: a line, or with ``read_documents`` a whole file.  A text that is
  not a 2-element list, or whose payload is NULL, yields no rows and goes to
  the rejected side with a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import params as P
from tidemark.functions.exprs import nan_to_null, parse_period

ENVELOPE_ROWS = T.ArrayType(P.ENVELOPE_ROW_SCHEMA)


def flatten_records(df: DataFrame, metric: str) -> DataFrame:
    """Record rows -> (metric, entity, period, value, period_ok).  NaN
    becomes NULL; an unparsable period gives period NULL and
    period_ok = false (quarantine)."""
    return df.select(F.lit(metric).alias("metric"), F.col("economy").alias("entity"),
                     parse_period("time").alias("period"),
                     nan_to_null(F.col("value").cast("double")).alias("value"),
                     (F.col("time").isNull() | parse_period("time").isNotNull())
                     .alias("period_ok"))


def envelope_parts(text: DataFrame, column: str = "value") -> DataFrame:
    """Parse one envelope per row: validity, page count, payload rows."""
    raw = F.col(column)
    is_list = F.trim(raw).startswith("[")
    n_items = F.json_array_length(raw)
    payload = F.get_json_object(raw, "$[1]")
    rows = F.from_json(payload, ENVELOPE_ROWS)
    reason = (F.when(~is_list | n_items.isNull(), "not a list")
              .when(n_items < 2, "error envelope")
              .when(payload.isNull() | (F.lower(F.trim(payload)) == "null"), "null payload")
              .when(rows.isNull(), "unreadable payload"))
    return text.select(
        raw.alias("doc"), reason.alias("reject_reason"),
        F.get_json_object(raw, "$[0].pages").cast("long").alias("pages"),
        rows.alias("rows"))


def flatten_envelope(text: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(rows, rejected).  rows: metric, entity, period, value, pages_warn
    (true when the envelope says more than one page exists) and ``date``,
    the period as written."""
    parts = envelope_parts(text, column)
    ok = parts.filter(F.col("reject_reason").isNull())
    rejected = parts.filter(F.col("reject_reason").isNotNull()).select("doc", "reject_reason")
    rows = (ok.select("pages", F.explode("rows").alias("r"))
            .select(F.col("r.indicator.id").alias("metric"),
                    F.col("r.countryiso3code").alias("entity"),
                    F.col("r.date").try_cast("int").alias("period"),
                    nan_to_null(F.col("r.value")).alias("value"),
                    (F.coalesce(F.col("pages"), F.lit(1)) > 1).alias("pages_warn"),
                    F.col("r.date").alias("date")))
    return rows, rejected


def page_warnings(text: DataFrame, column: str = "value") -> DataFrame:
    """(doc, pages) of envelopes that say more than one page exists: their
    later pages are not in the document."""
    return envelope_parts(text, column).filter(F.col("pages") > 1).select("doc", "pages")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(value, file): one row per file, whatever lines its document spans; a
    document is read by one task and may have 2 GB.  Partition columns of the
    folder stay."""
    return (spark.read.text(path, wholetext=True)
            .withColumn("file", F.col("_metadata.file_path")))


def page_report(docs: DataFrame, request: str, column: str = "value") -> DataFrame:
    """(request, page, fault): pages a request should have and has not, and
    pages that came more than once.

    A request's envelopes say how many pages there are; the largest number
    counts.  An envelope without a page number is page 1.  Documents that are
    no envelope are ``flatten_envelope``'s rejects and count as absent.  Only
    page numbers are shuffled, never documents."""
    raw = F.col(column)
    said = docs.select(F.col(request).alias("request"), *_page_numbers(raw))
    pages = (said.filter(F.col("pages").isNotNull()).groupBy("request", "page")
             .agg(F.count(F.lit(1)).alias("n"), F.max("pages").alias("pages")))
    have = pages.groupBy("request").agg(F.max("pages").alias("pages"),
                                        F.map_from_entries(F.collect_list(F.struct("page", "n"))).alias("have"))
    wanted = F.sequence(F.lit(1).cast("long"), F.greatest("pages", F.lit(1).cast("long")))
    rows = have.select("request", "have", F.explode(F.array_union(wanted, F.map_keys("have"))).alias("page"))
    n = F.try_element_at("have", "page")
    return (rows.withColumn("fault", F.when(n.isNull(), "missing").when(n > 1, "repeated"))
            .filter("fault IS NOT NULL").select("request", "page", "fault"))


def _page_numbers(raw: Column) -> list[Column]:
    ok = F.trim(raw).startswith("[") & (F.json_array_length(raw) >= 2)
    return [F.when(ok, F.coalesce(F.get_json_object(raw, f"$[0].{name}").try_cast("long"), F.lit(1))).alias(name)
            for name in ("page", "pages")]


def row_fault(metric: str = "metric", entity: str = "entity", period: str = "period") -> Column:
    """Why a landed row can't enter the raw table; NULL for a good row."""
    return (F.when(F.col(metric).isNull(), "no metric")
            .when(F.col(entity).isNull(), "no entity")
            .when(F.col(period).isNull(), "unreadable period"))


def scope_to_basket(df: DataFrame, entities: DataFrame, metrics: DataFrame,
                    start: int, end: int) -> DataFrame:
    """Keep basket entities and metrics inside the window.  No hint: the
    baskets' sizes decide at run time."""
    return (df.filter(F.col("period").between(start, end))
            .join(entities.select("entity"), "entity", "left_semi")
            .join(metrics.select("metric"), "metric", "left_semi"))


def entity_basket(spark, groups) -> DataFrame:
    """Concatenate named entity lists in order, duplicates kept:
    ``groups`` = [(group, [entity, ...]), ...] -> (entity, group, pos)."""
    rows, pos = [], 0
    for group, members in groups:
        for e in members:
            rows.append((e, group, pos))
            pos += 1
    schema = "entity string, group string, pos int"
    return spark.createDataFrame(rows, schema)


def metric_basket(spark, blocks) -> DataFrame:
    """Category blocks -> rows (code, name, coverage, category):
    ``blocks`` = {category: [{code, name, coverage?}, ...]}."""
    rows = [(i["code"], i["name"], i.get("coverage"), cat)
            for cat, items in blocks.items() for i in items]
    return spark.createDataFrame(rows, "code string, name string, coverage string, "
                                       "category string")


def envelope_documents(raw: DataFrame, pages: int = 1) -> DataFrame:
    """Serialise raw rows as envelope documents, one per (batch, metric,
    entity) series, as one JSON text per row.  A series holds at most one
    row per period, so no document grows with the data."""
    row = F.struct(F.struct(F.col("metric").alias("id")).alias("indicator"),
                   F.col("entity").alias("countryiso3code"),
                   F.col("period").cast("string").alias("date"),
                   F.col("value").alias("value"))
    meta = F.struct(F.lit(1).alias("page"), F.lit(pages).alias("pages"),
                    F.count(F.lit(1)).alias("total"))
    return (raw.groupBy("batch_id", "metric", "entity")
            .agg(meta.alias("meta"), F.collect_list(row).alias("rows"))
            .select("batch_id", F.concat(F.lit("["), F.to_json("meta"), F.lit(","),
                                         F.to_json("rows"), F.lit("]")).alias("value")))


def land_envelopes(text: DataFrame, source: str, batch_id: str) -> tuple[DataFrame, DataFrame]:
    """Flatten envelope text rows (column ``value``) and stamp them.
    Returns (raw rows, rejected): rejected holds whole documents and single
    rows, as JSON, with the reason."""
    from tidemark.sources.raw import stamp_batch
    rows, rejected = flatten_envelope(text)
    judged = rows.withColumn("reject_reason", row_fault())
    good = judged.filter(F.col("reject_reason").isNull()).drop("pages_warn", "date", "reject_reason")
    bad = (judged.filter(F.col("reject_reason").isNotNull())
           .select(F.to_json(F.struct("metric", "entity", "date", "value")).alias("doc"), "reject_reason"))
    return stamp_batch(good, source, batch_id), rejected.unionByName(bad)
