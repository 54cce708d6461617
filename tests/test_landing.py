import json
import math
import tempfile

from tidemark.sources.landing import flatten_envelope, flatten_records, scope_to_basket
from tidemark.sources.raw import (append_batch, latest_batch, latest_per_key, read_raw,
                                  stamp_batch)
from tidemark.operators.coverage import batch_conflicts, complete_grid, missing_cells


def test_flatten_records_periods_and_nan(spark):
    df = spark.createDataFrame([("A", "YR2008", 1.0), ("A", "2009", math.nan),
                                ("A", "abc", 2.0), ("A", None, 3.0)],
                               "economy string, time string, value double")
    out = [(r["period"], r["value"], r["period_ok"]) for r in flatten_records(df, "m").collect()]
    assert out == [(2008, 1.0, True), (2009, None, True), (None, 2.0, False), (None, 3.0, True)]


def test_envelope_guards(spark):
    good = json.dumps([{"pages": 1}, [{"indicator": {"id": "m"}, "countryiso3code": "A",
                                       "date": "2010", "value": 1.5}]])
    multi = json.dumps([{"pages": 3}, [{"indicator": {"id": "m"}, "countryiso3code": "B",
                                        "date": "2011", "value": None}]])
    error = json.dumps([{"message": "bad"}])
    null_payload = json.dumps([{"pages": 1}, None])
    empty = json.dumps([{"pages": 1}, []])
    text = spark.createDataFrame([(d,) for d in (good, multi, error, null_payload, empty)],
                                 "value string")
    rows, rejected = flatten_envelope(text)
    got = sorted((r["entity"], r["period"], r["value"], r["pages_warn"]) for r in rows.collect())
    assert got == [("A", 2010, 1.5, False), ("B", 2011, None, True)]
    reasons = sorted(r["reject_reason"] for r in rejected.collect())
    assert reasons == ["error envelope", "null payload"]


def test_append_replay_and_latest(spark):
    path = tempfile.mkdtemp(prefix="tm-raw-") + "/raw"
    assert read_raw(spark, path).count() == 0
    base = spark.createDataFrame([("m", "A", 1, 1.0), ("m", "B", 1, 2.0)],
                                 "metric string, entity string, period int, value double")
    append_batch(stamp_batch(base, "S", "s_1"), path)
    newer = spark.createDataFrame([("m", "A", 1, 5.0)],
                                  "metric string, entity string, period int, value double")
    append_batch(stamp_batch(newer, "S", "s_2"), path)
    append_batch(stamp_batch(newer, "S", "s_2"), path)  # replay: no double count
    raw = read_raw(spark, path)
    assert raw.count() == 3
    assert latest_batch(raw).count() == 1                    # partial newest batch
    lpk = {r["entity"]: r["value"] for r in latest_per_key(raw).collect()}
    assert lpk == {"A": 5.0, "B": 2.0}
    plan = latest_batch(raw)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower() or "PartitionFilters" in plan


def test_batch_conflict_null_vs_number(spark):
    raw = spark.createDataFrame([("m", "A", 1, None, "b1"), ("m", "A", 1, 5.0, "b2"),
                                 ("m", "B", 1, 1.0, "b1"), ("m", "B", 1, 1.0, "b2")],
                                "metric string, entity string, period int, value double, "
                                "batch_id string")
    assert [r["entity"] for r in batch_conflicts(raw).collect()] == ["A"]


def test_missing_cell_vs_null_cell(spark):
    panel = spark.createDataFrame([("A", "m", 1, None)],
                                  "entity string, metric string, period int, value double")
    ents = spark.createDataFrame([("A",)], "entity string")
    grid = complete_grid(panel, ents, ["m"], 1, 2).collect()
    assert sorted((r["period"], r["value"]) for r in grid) == [(1, None), (2, None)]
    assert [r["period"] for r in missing_cells(panel, ents, ["m"], 1, 2).collect()] == [2]


def test_scope_to_basket(spark):
    df = spark.createDataFrame([("A", "m", 1, 1.0), ("Z", "m", 1, 1.0), ("A", "q", 1, 1.0),
                                ("A", "m", 9, 1.0)],
                               "entity string, metric string, period int, value double")
    ents = spark.createDataFrame([("A",)], "entity string")
    mets = spark.createDataFrame([("m",)], "metric string")
    assert scope_to_basket(df, ents, mets, 1, 5).count() == 1


def test_batch_id_format_sorts_by_time(spark):
    from pyspark.sql import functions as F
    from tidemark.sources.raw import batch_id_expr
    df = spark.createDataFrame([("2026-06-30 09:33:54",), ("2026-12-01 00:00:00",)], "t string")
    ids = [r["b"] for r in df.select(batch_id_expr("SRC", F.to_timestamp("t")).alias("b"))
           .collect()]
    assert ids == ["src_20260630T093354Z", "src_20261201T000000Z"]
    assert ids == sorted(ids)


def test_string_helpers(spark):
    from tidemark.functions.exprs import joined, strip_prefix
    df = spark.createDataFrame([("IDX_RL.SC", "x", None)], "c string, a string, b string")
    r = df.select(strip_prefix("c", "IDX_").alias("s"), joined(";", "a", "b", "c").alias("j")
                  ).collect()[0]
    assert (r["s"], r["j"]) == ("RL.SC", "x;IDX_RL.SC")


def test_raw_paths_and_newest_batch_per_source(spark, tmp_path):
    from tidemark.sources.raw import append_batch, latest_batch, read_raw, stamp_batch, superseded_keys
    path = str(tmp_path / "raw")
    assert read_raw(spark, path).count() == 0 and read_raw(spark, f"file:{path}").count() == 0

    def land(source, batch, rows):
        from tidemark import params as P
        df = spark.createDataFrame(rows, P.PANEL_SCHEMA).select("metric", "entity", "period", "value")
        names = [f.name for f in P.RAW_SCHEMA.fields if f.name not in ("source", "ingested_at", "batch_id")]
        for n in set(names) - set(df.columns):
            from pyspark.sql import functions as F
            df = df.withColumn(n, F.lit(None).cast(P.RAW_SCHEMA[n].dataType))
        append_batch(stamp_batch(df, source, batch), path)

    land("WDI", "wdi_20250101T000000Z", [("A", "old", 1, 1.0)])
    land("WDI", "wdi_20260101T000000Z", [("A", "x", 1, 2.0)])
    land("WGI", "wgi_20250601T000000Z", [("A", "y", 1, 3.0)])
    for p in (path, f"file:{path}"):
        raw = read_raw(spark, p)
        assert sorted(r["metric"] for r in latest_batch(raw).collect()) == ["x", "y"]
        assert [r["metric"] for r in superseded_keys(raw).collect()] == ["old"]


def test_batch_lands_metric_by_metric(spark, tmp_path):
    from pyspark.sql import functions as F
    from tidemark import params as P
    path = str(tmp_path / "raw")
    base = spark.createDataFrame([("A", "m/1", 1, 1.0), ("A", "m3", 1, 3.0)], P.PANEL_SCHEMA)
    for metric in ("m/1", "m3", "m3"):
        append_batch(stamp_batch(base.filter(F.col("metric") == metric), "S", "s_1"), path)
    append_batch(stamp_batch(base.limit(0), "S", "s_2"), path)  # nothing lands, no batch
    raw = read_raw(spark, path)
    assert raw.columns == P.RAW_SCHEMA.names
    assert sorted((r["metric"], r["value"]) for r in latest_batch(raw).collect()) == [("m/1", 1.0), ("m3", 3.0)]


def test_publish_refuses_repeated_further_and_no_rows(spark, tmp_path):
    from tidemark import params as P
    from tidemark.sources.raw import publish_if_complete
    base = spark.createDataFrame([("A", "m", 1, 1.0), ("B", "m", 1, 2.0)], P.PANEL_SCHEMA)
    def published(df, name, **kw):
        rep = publish_if_complete(stamp_batch(df, "S", f"s_{name}"), str(tmp_path / "raw"), str(tmp_path / name), **kw)
        return rep.collect()[0]["published"]
    assert not published(base.union(base), "1") and not published(base.limit(0), "2")
    assert not published(base, "3", expected_keys=base.filter("entity = 'A'"))
    assert published(base, "4", expected_keys=base)
    assert read_raw(spark, str(tmp_path / "raw")).count() == 2


def test_bad_envelope_rows_are_rejected_and_pages_warned(spark):
    from tidemark.sources.landing import land_envelopes, page_warnings
    rows = [{"indicator": {"id": "m"}, "countryiso3code": "A", "date": "2010", "value": 1.5},
            {"indicator": {"id": "m"}, "countryiso3code": None, "date": "2010", "value": 1.5},
            {"indicator": {"id": "m"}, "countryiso3code": "A", "date": "20x0", "value": 1.5}]
    text = spark.createDataFrame([(json.dumps([{"pages": 2}, rows]),), ("{}",)], "value string")
    good, rejected = land_envelopes(text, "S", "s_1")
    assert [(r["entity"], r["period"]) for r in good.collect()] == [("A", 2010)]
    assert sorted(r["reject_reason"] for r in rejected.collect()) == ["no entity", "not a list", "unreadable period"]
    assert [r["pages"] for r in page_warnings(text).collect()] == [2]


def test_seed_by_name_keeps_other_attributes(spark, tmp_path):
    from tidemark import params as P
    from tidemark.sources.raw import read_dim
    (tmp_path / "roles.csv").write_text("role,entity,member\nsubject,A,true\n")
    d = read_dim(spark, str(tmp_path / "roles.csv"), P.ENTITY_DIM_SCHEMA).collect()[0].asDict()
    assert d == {"entity": "A", "role": "subject", "member": "true"}
