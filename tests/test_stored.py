"""Stored state: incremental moments, observed checks, bucketed tables, the
ledger of landed batches, the keyed stream."""
import json
import os
import random
import re
import tempfile

import pytest
from conftest import as_dicts, panel_df
from pyspark.sql import functions as F

from tidemark.operators import moments
from tidemark.operators import quality as Q
from tidemark.operators.trend import trend
from tidemark.plans.job import mart_watches
from tidemark.plans.marts import build_marts
from tidemark.sources import bucketed, tables
from tidemark.sources.raw import append_batch, latest_batch, latest_per_key, ledger_path, read_ledger, read_raw, stamp_batch
from tidemark.streaming.keyed_stream import keep_newest, keyed_table

CELL = "metric string, entity string, period int, value double"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"(?<!Broadcast)Exchange", plan(df)))


# --- incremental trend -------------------------------------------------------------

def batches(seed):
    """Batches of random new, revised, withdrawn (NULL) and repeated cells."""
    rng, out = random.Random(seed), []
    for _ in range(4):
        cells = {}
        for _ in range(40):
            v = None if rng.random() < 0.15 else round(rng.uniform(-50, 50), 2)
            cells[rng.choice("mn"), rng.choice("ABC"), rng.randrange(1990, 2003)] = v
        out.append([(*k, v) for k, v in cells.items()])
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_incremental_trend_equals_trend_of_newest_cells(spark, seed):
    base, state, landed = tempfile.mkdtemp(prefix="tm-mom-"), moments.empty_state(spark), None
    for i, rows in enumerate(batches(seed)):
        batch = spark.createDataFrame(rows, CELL)
        one = stamp_batch(batch, "S", f"s_{i}")
        landed = one if landed is None else landed.unionByName(one)
        state = moments.store(moments.advance(state, batch, 1992, 2000, 2), f"{base}/{i}", buckets=4)
        got = {(r["entity"], r["metric"]): r for r in moments.trend_of(state, 1992, 2000, 2).collect()}
        newest = latest_per_key(landed).drop("batch_id")
        want = as_dicts(trend(newest, 1992, 2000, y="value", exact_scale=2))
        want = {(w["entity"], w["metric"]): w for w in want}
        assert got.keys() == want.keys()
        for k, w in want.items():
            g = got[k]
            assert g["n_points"] == w["n_points"] and (g["slope"] is None) == (w["slope"] is None)
            for c in ("slope", "intercept", "gap_start", "gap_end", "gap_change"):
                assert (g[c] is None and w[c] is None) or g[c] == pytest.approx(w[c], rel=1e-9, abs=1e-6), (k, c)
            if w["n_points"]:
                assert (int(g["slope_num"]), int(g["slope_den"])) == (int(w["slope_num"]), int(w["slope_den"]))


def test_incremental_trend_reads_state_and_batch_only(spark):
    base = tempfile.mkdtemp(prefix="tm-mom-")
    for i, rows in enumerate(batches(3)):
        append_batch(stamp_batch(spark.createDataFrame(rows, CELL), "S", f"s_{i}"), f"{base}/raw")
    raw, state = read_raw(spark, f"{base}/raw"), moments.empty_state(spark)
    for i in range(2):
        state = moments.store(moments.advance(state, raw.filter(F.col("batch_id") == f"s_{i}"), 1992, 2000, 2),
                              f"{base}/state{i}", buckets=8)
    third = moments.advance(state, raw.filter(F.col("batch_id") == "s_2"), 1992, 2000, 2)
    scans = re.findall(r"FileScan parquet [^\n]*", plan(third))
    assert len(scans) == 2 and sum("/state1" in s and "Bucketed: true" in s for s in scans) == 1
    assert sum(bool(re.search(r"PartitionFilters: \[[^\]]*batch_id#\d+ = s_2", s)) for s in scans) == 1
    # a batch that comes twice changes nothing
    again = moments.advance(moments.store(third, f"{base}/state2", buckets=8),
                            raw.filter(F.col("batch_id") == "s_2"), 1992, 2000, 2)
    same = third.select("entity", "metric", "n", "sx", "sy", "sxy")
    assert again.select(*same.columns).exceptAll(same).count() == 0


def test_incremental_trend_large_and_empty(spark):
    state = moments.advance(moments.empty_state(spark), spark.createDataFrame([], CELL), 1, 9, 2)
    assert state.count() == 0
    rows = [("m", "A", p, 9e13 * p) for p in range(1, 10)] + [("m", "B", 1, 1e300), ("m", None, 1, 1.0)]
    state = moments.advance(state, spark.createDataFrame(rows, CELL), 1, 9, 2)
    got = {r["entity"]: r for r in moments.trend_of(state, 1, 9, 2).collect()}
    assert got["A"]["slope"] == 9e13 and got["B"]["n_points"] == 0 and got["B"]["slope"] is None and set(got) == {"A", "B"}


# --- trend with extreme values -------------------------------------------------------

def test_one_extreme_series_leaves_the_others_their_labels(spark):
    from tidemark import params as P
    from tidemark.operators.gap import gap_to_benchmark
    from tidemark.operators.trend import stuck_matrix
    rows = [("Z", "m", p, 10.0 if p < 1999 else 1e-12) for p in range(1995, 2000)]
    rows += [("A", "m", p, 1e9 + p) for p in range(1995, 2000)]
    rows += [("Z", "k", p, 100.0) for p in range(1995, 2000)]
    rows += [("A", "k", p, 100.0 + 0.2 * (p - 1995)) for p in range(1995, 2000)]      # exactly on the band
    rows += [("B", "k", p, 100.0 + 0.3 * (p - 1995)) for p in range(1995, 2000)]
    rows += [("C", "k", p, 1e300 if p == 1997 else 1.0) for p in range(1995, 2000)]
    dim = spark.createDataFrame([("m", "M", P.CONVERGENCE), ("k", "K", P.CONVERGENCE)], P.METRIC_DIM_SCHEMA)
    params = P.PanelParams(benchmark="Z", fit_start=1995, fit_end=1999, ref_period=1999)
    gap = gap_to_benchmark(panel_df(spark, rows), "Z")
    got = {(r["entity"], r["metric"]): r["status"] for r in stuck_matrix(gap, None, dim, params).collect()}
    assert got["A", "k"] == "stuck" and got["B", "k"] == "catching_up" and got["Z", "k"] == "stuck"
    assert got["A", "m"] == "catching_up" and ("C", "k") in got


# --- observed checks ---------------------------------------------------------------

def test_watch_reports_what_reading_the_table_would(spark):
    rows = [(1, "a"), (2, None), (None, "b"), (None, "zz"), (5, "zz"), (6, "y")]
    df = spark.createDataFrame(rows, "k int, s string")
    w = (Q.Watch("t").not_null("k").not_null("s", label="t.s").accepted_values("s", ["a", "b"]).row_count(6)
         .row_count(7, label="other").rows("k_small", F.col("k") > 4))
    w.on(df).write.mode("overwrite").parquet(tempfile.mkdtemp(prefix="tm-w-") + "/t")
    got = {(r["check"], r["table"]): r["n_violations"] for r in Q.observed_report(spark, [w]).collect()}
    want = {(r["check"], r["table"]): r["n_violations"] for r in Q.run_checks([
        ("not_null", "t", Q.not_null(df, "k")), ("not_null", "t.s", Q.not_null(df, "s")),
        ("accepted_values", "t", Q.accepted_values(df, "s", ["a", "b"])), ("row_count", "t", Q.row_count_is(df, 6)),
        ("row_count", "other", Q.row_count_is(df, 7)), ("k_small", "t", df.filter("k > 4"))]).collect()}
    assert got == want and w.n_rows == 6


def test_watch_on_an_empty_table(spark):
    w = Q.Watch("t").not_null("k").accepted_values("k", [1]).row_count(0)
    w.on(spark.createDataFrame([], "k int")).write.mode("overwrite").parquet(tempfile.mkdtemp(prefix="tm-w-") + "/t")
    assert [n for _, _, n in w.report_rows()] == [0, 0, 0]


def test_marts_are_checked_while_they_are_written(spark):
    from conftest import SF001
    watches = mart_watches(expected_rows=1)
    built = build_marts(spark, tables.nation_panel(spark, SF001), tempfile.mkdtemp(prefix="tm-m-"), watches=watches)
    for name, mart in built.items():
        assert watches[name].n_rows == mart.count()
    report = {(c, t): n for w in watches.values() for c, t, n in w.report_rows()}
    assert report["row_count", "staging"] == 1 and report["status_scoping", "stuck"] == 0
    assert report["not_null", "gap.entity"] == 0


# --- ledger --------------------------------------------------------------------------

def test_newest_batch_is_found_without_the_raw_table(spark):
    path = tempfile.mkdtemp(prefix="tm-led-") + "/raw"
    assert read_ledger(spark, path) is None
    for source, b, v in (("S", "s_1", 1.0), ("S", "s_2", 2.0), ("T", "t_1", 3.0), ("S", "s_2", 4.0)):
        append_batch(stamp_batch(spark.createDataFrame([("m", "A", 1, v)], CELL), source, b), path)
    append_batch(stamp_batch(spark.createDataFrame([], CELL), "U", "u_1"), path)   # lands nothing
    raw, ledger = read_raw(spark, path), read_ledger(spark, path)
    assert sorted(tuple(r) for r in ledger.collect()) == [("S", "s_1"), ("S", "s_2"), ("T", "t_1")]
    df = latest_batch(raw, ledger)
    assert sorted(r["value"] for r in df.collect()) == [3.0, 4.0]
    assert sorted(map(str, df.collect())) == sorted(map(str, latest_batch(raw).collect()))
    s = plan(df)
    subquery = s[s.index("Subquery"):]
    raw_scans = [x for x in re.findall(r"FileScan parquet [^\n]*", s) if ledger_path(path) not in x]
    assert raw_scans and all("PartitionFilters: [" in x and "PartitionFilters: []" not in x for x in raw_scans)
    assert ledger_path(path) in subquery


# --- bucketed tables -----------------------------------------------------------------

def test_bucketed_marts_need_no_exchange(spark):
    from tidemark.operators.compare import classifier_agreement
    from tidemark.operators.reshape import delta
    rows = [(e, m, p, float(p * len(e) + ord(m))) for e in ("A", "BB", "CCC") for m in "xyz" for p in range(1, 9)]
    df = panel_df(spark, rows).withColumnRenamed("value", "gap")
    base = tempfile.mkdtemp(prefix="tm-b-")
    t = bucketed.write_bucketed(df, f"{base}/gap", buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(trend(df, 1, 8)) == 1 and exchanges(trend(t, 1, 8)) == 0
        assert exchanges(delta(t)) == 0
        assert sorted(map(str, trend(t, 1, 8).collect())) == sorted(map(str, trend(df, 1, 8).collect()))
        left = spark.createDataFrame([("A", "x", "stuck")], "entity string, metric string, status string")
        a, b = (bucketed.write_bucketed(left, f"{base}/{n}", buckets=4, sort=()) for n in "ab")
        assert exchanges(classifier_agreement(a, b)) == 0 and classifier_agreement(a, b).count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # another session only registers the folder
    spark.sql(f"DROP TABLE {bucketed.table_name(f'{base}/gap')}")
    again = bucketed.register(spark, f"{base}/gap", t.schema, buckets=4)
    assert exchanges(trend(again, 1, 8)) == 0 and again.count() == len(rows)
    got = {r["table"]: (r["n_rows"], r["n_columns"]) for r in bucketed.read_back({"gap": again, "a": a}).collect()}
    assert got == {"gap": (len(rows), 4), "a": (1, 3)}


# --- keyed stream -----------------------------------------------------------------------

def put(folder, name, records, text=""):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text + "".join(json.dumps(r) + "\n" for r in records))


def rec(metric, entity, time, value):
    return {"metric": metric, "economy": entity, "time": time, "value": value}


def test_keyed_stream_keeps_the_newest_row_across_restarts(spark):
    base = tempfile.mkdtemp(prefix="tm-key-")
    inp, ck, changes = f"{base}/in", f"{base}/ckpt", []

    def changed(df, epoch):
        changes.append((epoch, sorted((r["metric"], r["entity"], r["period"]) for r in df.collect())))
    put(inp, "a.json", [rec("m", "A", "YR2001", 1.0), rec("m", "B", "2001", 2.0), rec("m", None, "2001", 9.0),
                        rec("m", "C", "bad", 9.0)], text='{"metric": broken\n')
    q = keep_newest(spark, inp, ck, changed=changed)
    assert q.lastProgress["observedMetrics"]["landing"]["n_rejected"] == 3
    put(inp, "b.json", [rec("m", "A", "2001", None), rec("n", "A", "2001", float("nan"))])
    keep_newest(spark, inp, ck, changed=changed)
    put(inp, "c.json", [rec("m", "B", "2001", 7.0)])
    put(inp, "d.json", [rec("m", "D", "2002", 8.0)])
    keep_newest(spark, inp, ck, max_files_per_trigger=1, changed=changed)
    keep_newest(spark, inp, ck, changed=changed)       # nothing new
    got = sorted(tuple(r)[:4] for r in keyed_table(spark, ck).collect())
    assert got == [("m", "A", 2001, None), ("m", "B", 2001, 7.0), ("m", "D", 2002, 8.0), ("n", "A", 2001, None)]
    assert [c for _, c in changes if c] == [[("m", "A", 2001), ("m", "B", 2001)], [("m", "A", 2001), ("n", "A", 2001)],
                                            [("m", "B", 2001)], [("m", "D", 2002)]]


def test_keyed_stream_replays_a_failed_batch(spark):
    base = tempfile.mkdtemp(prefix="tm-key-")
    inp, ck, fail = f"{base}/in", f"{base}/ckpt", [True]

    def changed(df, epoch):
        df.count()
        if epoch == 1 and fail.pop() if fail else False:
            raise RuntimeError("lost")
    put(inp, "a.json", [rec("m", "A", "2001", 1.0)])
    fail_on, fail[:] = fail[:], []
    keep_newest(spark, inp, ck, changed=changed)
    fail[:] = fail_on
    put(inp, "b.json", [rec("m", "A", "2001", 5.0), rec("m", "B", "2001", 6.0)])
    with pytest.raises(Exception):
        keep_newest(spark, inp, ck, changed=changed)
    fail[:] = []
    keep_newest(spark, inp, ck, changed=changed)
    assert sorted(tuple(r)[:4] for r in keyed_table(spark, ck).collect()) == [("m", "A", 2001, 5.0), ("m", "B", 2001, 6.0)]
