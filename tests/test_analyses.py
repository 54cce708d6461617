"""Best breaks, balanced sub-panels, SQL functions, drifting records, paged
documents: against brute force."""
import itertools
import json
import math
import os
import random
import tempfile

import numpy as np
import pytest
from conftest import panel_df

from tidemark.operators import breaks, subpanel
from tidemark.operators.reshape import complete_rows, to_wide, transpose
from tidemark.sources import drift
from tidemark.sources.landing import flatten_envelope, page_report, read_documents


# --- best breaks ---------------------------------------------------------------------

def residual(points, kind):
    x, y = (np.array(v, dtype=float) for v in zip(*points))
    if kind == breaks.LEVEL or len(set(x)) == 1:
        return float(((y - y.mean()) ** 2).sum())
    fit = np.polyfit(x - x.mean(), y, 1)
    return float(((y - np.polyval(fit, x - x.mean())) ** 2).sum())


def brute(points, kind, least):
    n, out = len(points), [residual(points, kind)]
    for k in (1, 2):
        best = (math.inf, None)
        for cut in itertools.combinations(range(1, n), k):
            parts = [points[a:b] for a, b in zip((0, *cut), (*cut, n))]
            if min(map(len, parts)) >= least:
                best = min(best, (round(sum(residual(p, kind) for p in parts), 6), [points[c][0] for c in cut]),
                           key=lambda t: t[0])
        out.append(best)
    return out


@pytest.mark.parametrize("kind", [breaks.LINE, breaks.LEVEL])
@pytest.mark.parametrize("least", [1, 2, 3])
def test_best_breaks_against_all_splits(spark, kind, least):
    rng, rows, series = random.Random(least), [], {}
    for s in range(12):
        periods = sorted(rng.sample(range(1990, 2010), rng.randrange(1, 14)))
        shift = rng.randrange(1990, 2010)
        pts = [(p, round(rng.uniform(0, 3) + (9 if p >= shift else 0) + 0.5 * p * (s % 2), 2)) for p in periods]
        series[f"E{s}"] = pts
        rows += [(f"E{s}", "m", p, v) for p, v in pts] + [(f"E{s}", "m", 1900 + s, 77.0), (f"E{s}", "m", 2020, None)]
    got = {r["entity"]: r for r in breaks.best_breaks(panel_df(spark, rows), 1990, 2020, y="value", least=least,
                                                      kind=kind).collect()}
    assert got.keys() == series.keys()
    for e, pts in series.items():
        g, (sse0, one, two) = got[e], brute(pts, kind, least)
        assert g["n"] == len(pts) and g["sse0"] == pytest.approx(sse0, abs=1e-6)
        for want, cost, at in ((one, "sse1", ["break1"]), (two, "sse2", ["break2a", "break2b"])):
            if want[1] is None:
                assert g[cost] is None and all(g[a] is None for a in at)
                continue
            assert g[cost] == pytest.approx(want[0], abs=1e-5)
            cut = [i for i, (p, _) in enumerate(pts) if p in [g[a] for a in at]]
            parts = [pts[a:b] for a, b in zip((0, *cut), (*cut, len(pts)))]   # the reported split costs that much
            assert min(map(len, parts)) >= least and sum(residual(p, kind) for p in parts) == pytest.approx(want[0], abs=1e-5)


def test_best_breaks_ties_and_empty(spark):
    flat = panel_df(spark, [("A", "m", p, 1.0) for p in range(1, 9)])
    r = breaks.best_breaks(flat, 1, 8, y="value").collect()[0]
    assert (r["break1"], r["break2a"], r["break2b"], r["sse2"]) == (3, 3, 5, 0.0)   # the earliest
    assert breaks.best_breaks(flat.limit(0), 1, 8, y="value").count() == 0
    assert breaks.best_breaks(flat, 50, 60, y="value").count() == 0


# --- balanced sub-panels -------------------------------------------------------------

def test_balanced_frontier_against_all_sets_and_windows(spark):
    rng, metrics, start, end = random.Random(5), ("a", "b", "c"), 3, 12
    cells = {(e, m, p) for e in range(15) for m in metrics for p in range(start, end + 1) if rng.random() < 0.8}
    rows = [(f"E{e}", m, p, 1.0) for e, m, p in cells]
    rows += [("E0", "z", 5, 1.0), ("E1", "a", 99, 1.0), ("NULLS", "a", 4, None)]
    want = {}
    for bits in range(1, 8):
        chosen = [m for i, m in enumerate(metrics) if bits >> i & 1]
        for a in range(start, end + 1):
            for b in range(a, end + 1):
                n = sum(all((e, m, p) in cells for m in chosen for p in range(a, b + 1)) for e in range(15))
                key = (len(chosen), b - a + 1)
                if n and (n, -bits, -a) > want.get(key, ((0,),))[0]:
                    want[key] = ((n, -bits, -a), "+".join(chosen), a, b, n)
    df = panel_df(spark, rows)
    got = {(r["n_metrics"], r["n_periods"]): (r["metrics"], r["start"], r["end"], r["n_entities"])
           for r in subpanel.balanced_frontier(df, metrics, start, end).collect()}
    assert got == {k: v[1:] for k, v in want.items()}
    best = subpanel.largest_balanced(df, metrics, start, end).collect()[0]
    assert best["n_cells"] == max(k[0] * k[1] * v[4] for k, v in want.items())
    assert subpanel.balanced_frontier(df.limit(0), metrics, start, end).count() == 0
    with pytest.raises(ValueError):
        subpanel.presence(df, metrics, 1, 100)


# --- SQL functions ---------------------------------------------------------------------

def test_sql_functions_agree_with_the_expressions(spark):
    from tidemark import params as P
    from tidemark.functions import exprs, sql
    for s in sql.scalars():
        spark.sql(s)
    rows = [(b, g, s, st) for b in (*P.BUCKETS, None) for g in (None, 99.99, 100.0, 100.01, 0.0)
            for s in (None, 0.0, 0.2, -0.2, 2.5, -2.5) for st in ("no_data", "catching_up", "diverging", "stalled", "x")]
    df = spark.createDataFrame(rows, "bucket string, gap double, slope double, status string")
    y = exprs.years_to_close_expr("bucket", "gap", "slope", "status")
    both = (df.withColumn("y", y).withColumn("c", exprs.closure_status_expr("bucket", "gap", "status"))
            .withColumn("b", exprs.years_bucket_expr("status", "y")).withColumn("g", exprs.gap_expr("gap", "slope"))
            .selectExpr("*", "tm_years(bucket, gap, slope, status) AS y2", "tm_closure(bucket, gap, status) AS c2",
                        "tm_gap(gap, slope) AS g2").selectExpr("*", "tm_years_bucket(status, y2) AS b2"))
    bad = both.where("NOT (y <=> y2 AND c <=> c2 AND b <=> b2 AND g <=> g2)")
    assert both.count() == len(rows) and bad.count() == 0, bad.take(3)


def test_sql_status_on_the_bands(spark):
    from tidemark.functions import sql
    for s in sql.scalars():
        spark.sql(s)
    got = spark.sql("""SELECT tm_status(20, 1, 'convergence') a, tm_status(21, 1, 'convergence') b,
        tm_trajectory(-21, 1, 'convergence') c, tm_status(-201, 1, 'context_inverted') d,
        tm_trajectory(200, 1, 'context_inverted') e, tm_status(5, 1, 'context') f, tm_status(NULL, 1, 'context') g,
        tm_trajectory(5, 0, 'convergence') h, tm_status(5, 1, 'governance') i""").collect()[0]
    assert tuple(got) == ("stuck", "catching_up", "diverging", "catching_up", "stalled", "not_classified", "no_data",
                          "no_data", "not_classified")


# --- drifting records -------------------------------------------------------------------

def test_drift_report_and_known_fields(spark):
    texts = ['{"a": 1, "b": {"c": "x", "d": 2.5}}', '{"a": "1"}', '{"a": null, "e": [1, 2]}', "{broken", None, "7", "[]"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, j string")
    known = {"$.a": "bigint", "$.b.d": "double"}
    got = {(r["path"], r["type"]): (r["n_rows"], r["verdict"]) for r in drift.drift_report(df, "j", known).collect()}
    assert got[("$.a", "BIGINT")] == (1, "known") and got[("$.a", "STRING")] == (1, "retyped")
    assert got[("$.a", "VOID")] == (1, "known") and got[("$.b.c", "STRING")] == (1, "unknown")
    assert got[("$.b.d", "DECIMAL(2,1)")][1] in ("known", "retyped") and got[(None, None)] == (1, "unreadable")
    assert got[("$.e", "ARRAY<BIGINT>")] == (1, "unknown")
    land = {r["id"]: (r["a"], r["d"], r["readable"]) for r in drift.land_known(df, "j", known).collect()}
    assert land[0] == (1, 2.5, True) and land[1][0] in (1, None) and land[3] == (None, None, False) and land[4][2] is False
    assert drift.drift_report(df.limit(0), "j", known).count() == 0


# --- documents that span lines and pages ----------------------------------------------

def test_pretty_printed_pages(spark):
    base = tempfile.mkdtemp(prefix="tm-pages-")

    def doc(request, name, meta, n, lines=True):
        os.makedirs(f"{base}/request={request}", exist_ok=True)
        rows = [{"indicator": {"id": request}, "countryiso3code": f"E{i}", "date": "2001", "value": i / 2} for i in range(n)]
        with open(f"{base}/request={request}/{name}.json", "w") as f:
            f.write(json.dumps([meta, rows], indent=2 if lines else None))
    doc("x", "1", {"page": 1, "pages": 3}, 2)
    doc("x", "3", {"page": 3, "pages": 3}, 1)
    doc("x", "3b", {"page": 3, "pages": 3}, 1)
    doc("y", "1", {"page": 1, "pages": 1}, 40_000)          # some MB on very many lines
    doc("z", "1", {}, 1, lines=False)
    with open(f"{base}/request=z/error.json", "w") as f:
        f.write('[\n {"message": "no"}\n]')
    docs = read_documents(spark, base)
    rows, rejected = flatten_envelope(docs)
    assert rows.count() == 2 + 1 + 1 + 40_000 + 1 and [r["reject_reason"] for r in rejected.collect()] == ["error envelope"]
    got = sorted(tuple(r) for r in page_report(docs, "request").collect())
    assert got == [("x", 2, "missing"), ("x", 3, "repeated")]


# --- table operators --------------------------------------------------------------------

def test_complete_rows_transpose_and_unique_cells(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, None), ("b", 1, 4.0), (None, 1, 5.0)], "k string, p int, v double")
    assert complete_rows(df, ["k", "v"]).count() == 2 and complete_rows(df, []).count() == 4
    wide = to_wide(df.where("k is not null"), ["k"], "p", "v", [1, 2], unique=True)
    t = {r["field"]: (r["a"], r["b"]) for r in transpose(wide, "k", ["a", "b"], ["1", "2"]).collect()}
    assert t == {"1": (2.0, 4.0), "2": (None, None)}
    twice = df.unionByName(df)
    assert to_wide(twice, ["k"], "p", "v", [1]).count() == 3
    with pytest.raises(Exception, match="more than one row"):
        to_wide(twice, ["k"], "p", "v", [1], unique=True).collect()
