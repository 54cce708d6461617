import os
import random
import tempfile

from conftest import SF001, entity_dim_df, metric_dim_df, panel_df

from tidemark import params as P
from tidemark.operators import quality as Q
from tidemark.plans import marts
from tidemark.sources import tables
from tidemark.sources.landing import entity_basket, metric_basket
from tidemark.sources.raw import read_dim, superseded_keys


def test_build_marts_writes_all_five(spark):
    out = tempfile.mkdtemp(prefix="tm-marts-")
    built = marts.build_marts(spark, tables.nation_panel(spark, SF001), out)
    assert set(built) == {"gap", "stuck", "closing", "dispersion", "descriptive"}
    for name in built:
        assert os.path.isdir(f"{out}/{name}")
    assert Q.grain_unique(built["gap"], ["entity", "metric", "period"]).count() == 0
    assert Q.grain_unique(built["stuck"], ["entity", "metric"]).count() == 0
    assert built["stuck"].count() == 26 * 4


def test_read_dim_csv(spark):
    path = tempfile.mkdtemp(prefix="tm-dim-") + "/roles.csv"
    with open(path, "w") as f:
        f.write("entity,entity_name,role,western,region\nA,Alpha,subject,true,X\n"
                "B,Beta,core,false,Y\n")
    d = read_dim(spark, path, P.ENTITY_DIM_SCHEMA)
    rows = {r["entity"]: (r["role"], r["western"]) for r in d.collect()}
    assert rows == {"A": ("subject", True), "B": ("core", False)}


def test_baskets_keep_order_and_duplicates(spark):
    e = entity_basket(spark, [("six", ["A", "B"]), ("bench", ["Z"]), ("extra", ["A"])])
    assert [r["entity"] for r in e.orderBy("pos").collect()] == ["A", "B", "Z", "A"]
    assert Q.unique(e, "entity").count() == 1
    m = metric_basket(spark, {"income": [{"code": "x", "name": "X"}],
                              "labour": [{"code": "y", "name": "Y", "coverage": "partial"}]})
    assert sorted((r["code"], r["category"]) for r in m.collect()) == [
        ("x", "income"), ("y", "labour")]


def test_superseded_keys(spark):
    raw = spark.createDataFrame([("m", "A", 1, 1.0, "b1"), ("m", "B", 1, 1.0, "b1"),
                                 ("m", "A", 1, 2.0, "b2")],
                                "metric string, entity string, period int, value double, "
                                "batch_id string")
    assert [r["entity"] for r in superseded_keys(raw).collect()] == ["B"]


def random_panel(rnd, n_entities=12, n_metrics=4, periods=range(1, 7)):
    rows = []
    for m in range(n_metrics):
        for p in periods:
            rows.append(("BENCH", f"m{m}", p, rnd.choice([0.0, None, 50.0, 100.0, 80.0])))
        for e in range(n_entities):
            level, slope = rnd.uniform(20, 180), rnd.uniform(-8, 8)
            for p in periods:
                v = None if rnd.random() < 0.25 else level + slope * p + rnd.uniform(-3, 3)
                rows.append((f"E{e}", f"m{m}", p, v))
    return rows


def test_dq_invariants_hold_on_random_panels(spark):
    """Property check: on random panels with injected NULLs and zero /
    missing benchmarks, the scoping and validity checks report nothing but
    the documented exceptions (context without data; no_data but closed;
    catching up without a gap at the reference period)."""
    buckets = [P.CONVERGENCE, P.CONTEXT_INVERTED, P.CONTEXT, P.GOVERNANCE]
    md = metric_dim_df(spark, [(f"m{i}", f"metric {i}", b) for i, b in enumerate(buckets)])
    ed = entity_dim_df(spark, [(f"E{e}", f"e{e}", "s", None, None) for e in range(12)])
    params = P.PanelParams(benchmark="BENCH", fit_start=1, fit_end=6, ref_period=6,
                           closure_roles=("s",))
    for seed in range(3):
        p = tables.Panel(df=panel_df(spark, random_panel(random.Random(seed))), entity_dim=ed,
                         metric_dim=md, params=params, metrics=tuple(f"m{i}" for i in range(4)))
        g = marts.gap_fact(p)
        stuck = marts.stuck_of(p, g)
        closing = marts.closing_of(p, g)
        assert Q.status_scoping(stuck, context_exempt_no_data=True).count() == 0
        bad = Q.closing_time_valid(closing).collect()
        assert all(r["status"] == "no_data" and r["closure_status"] == P.ALREADY_CLOSED
                   for r in bad)
        # the only null-scoping reports: catching up, but no gap at the
        # reference period (no years figure can be computed)
        bad = Q.closing_time_null_scoping(closing).collect()
        assert all(r["status"] == "catching_up" and r["gap_ref"] is None for r in bad)
        assert Q.grain_unique(stuck, ["entity", "metric"]).count() == 0
        assert closing.filter("years_to_close < 0").count() == 0


def test_build_marts_stops_on_grain_violation(spark):
    import pytest
    p = tables.nation_panel(spark, SF001)
    dup = tables.Panel(df=p.df.unionByName(p.df.limit(1)), entity_dim=p.entity_dim,
                       metric_dim=p.metric_dim, params=p.params, metrics=p.metrics)
    with pytest.raises(marts.GrainError):
        marts.build_marts(spark, dup, tempfile.mkdtemp(prefix="tm-marts-"))


def test_publish_only_complete_batches(spark):
    from tidemark.sources.raw import publish_if_complete, read_raw, stamp_batch
    base = tempfile.mkdtemp(prefix="tm-pub-")
    schema = "metric string, entity string, period int, value double"
    expected = spark.createDataFrame([("m", "A", 1), ("m", "B", 1)],
                                     "metric string, entity string, period int")
    partial = stamp_batch(spark.createDataFrame([("m", "A", 1, 1.0)], schema), "S", "s_2")
    rep = publish_if_complete(partial, f"{base}/raw", f"{base}/stage_2", expected).collect()[0]
    assert (rep["n_missing"], rep["published"]) == (1, False)
    assert read_raw(spark, f"{base}/raw").count() == 0
    full = stamp_batch(spark.createDataFrame([("m", "A", 1, 1.0), ("m", "B", 1, None)], schema),
                       "S", "s_3")
    rep = publish_if_complete(full, f"{base}/raw", f"{base}/stage_3", expected,
                              expected_rows=2).collect()[0]
    assert rep["published"] is True
    assert read_raw(spark, f"{base}/raw").count() == 2
