from conftest import as_dicts, panel_df

from tidemark.operators.compare import dominance
from tidemark.operators.dispersion import dispersion, dispersion_shape
from tidemark.operators.reshape import (delta, last_value, series_shape, spikes,
                                        top_extremes, to_wide)


def gap_df(spark, rows):
    return panel_df(spark, rows).withColumnRenamed("value", "gap")


def test_dispersion_group_of_one_and_mean_zero(spark):
    rows = [("A", "one", 1, 5.0), ("A", "zero", 1, -1.0), ("B", "zero", 1, 1.0)]
    out = {r["metric"]: r for r in dispersion(gap_df(spark, rows), 1, 1).collect()}
    assert out["one"]["sd_gap"] is None and out["one"]["cv_gap"] is None
    assert out["zero"]["mean_gap"] == 0.0 and out["zero"]["cv_gap"] is None


def test_dispersion_null_member_not_counted(spark):
    rows = [(e, "m", 1, float(i)) for i, e in enumerate("ABCDE")] + [("F", "m", 1, None)]
    assert dispersion(gap_df(spark, rows), 1, 1).collect()[0]["n"] == 5


def test_dispersion_shape_peak_tie_earliest(spark):
    d = spark.createDataFrame([("m", 1, 0.3), ("m", 2, 0.5), ("m", 3, 0.5), ("m", 4, 0.2)],
                              "metric string, period int, cv_gap double")
    s = dispersion_shape(d, 1, 4).collect()[0]
    assert s["peak_period"] == 2 and s["trough_period"] == 4 and s["monotone_down"] is False


def test_delta_gap_in_middle(spark):
    rows = [("A", "m", 1, 1.0), ("A", "m", 2, None), ("A", "m", 3, 3.0), ("A", "m", 4, 4.5)]
    out = [r["delta"] for r in as_dicts(delta(gap_df(spark, rows)), ["period"])]
    assert out == [None, None, None, 1.5]


def test_spike_and_reversal_flagged_once(spark):
    rows = [("A", "m", p, v) for p, v in enumerate([50.0, 50.0, 56.2, 50.2, 50.5], 1)]
    out = spikes(gap_df(spark, rows), 5.0).collect()
    assert len(out) == 1 and out[0]["period"] == 3


def test_dominance_crossing(spark):
    rows = [("a", "m", 1, 1.0), ("b", "m", 1, 2.0), ("a", "m", 2, 3.0), ("b", "m", 2, 2.5),
            ("a", "m", 3, 4.0), ("b", "m", 3, 3.0)]
    r = dominance(gap_df(spark, rows), "a", "b").collect()[0]
    assert r["always_above"] is False and r["first_overtake"] == 2


def test_series_shape_and_last_value_keeps_null(spark):
    rows = [("A", "m", 1, 3.0), ("A", "m", 2, 5.0), ("A", "m", 3, 5.0), ("A", "m", 4, None)]
    s = series_shape(gap_df(spark, rows), 1, 4).collect()[0]
    assert s["peak_period"] == 2 and s["trough_period"] == 1 and s["never_falls"] is True
    lv = last_value(gap_df(spark, rows)).collect()[0]
    assert lv["last_period"] == 4 and lv["last_value"] is None


def test_top_extremes_exactly_k_and_group_limit(spark):
    rows = [(e, "m", 1, v) for e, v in zip("BACDE", [9.0, 9.0, 9.0, 7.0, 1.0])]
    df = top_extremes(gap_df(spark, rows), 2)
    assert sorted((r["rank"], r["entity"]) for r in df.collect()) == [(1, "A"), (2, "B")]
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


def test_last_n_periods_on_an_axis_with_holes(spark):
    from tidemark.operators.reshape import last_n_periods
    rows = [(e, "m", p, 1.0) for e in "AB" for p in (2010, 2014, 2018)]
    got = last_n_periods(gap_df(spark, rows), 2).collect()
    assert sorted({r["period"] for r in got}) == [2014, 2018] and len(got) == 4


def test_wide_pivot_counts_empty_cells_as_zero(spark):
    from pyspark.sql import functions as F
    from tidemark.operators.reshape import pivot_agg
    df = gap_df(spark, [("A", "v0", 1, 1.0)])
    for n in (3, 150):
        w = pivot_agg(df, ["entity"], "metric", [f"v{i}" for i in range(n)], lambda c: F.count(F.when(c, F.col("gap"))))
        r = w.collect()[0]
        assert (r["v0"], r["v1"], r[f"v{n - 1}"]) == (1, 0, 0)


def test_dominance_with_unknown_periods(spark):
    from tidemark.operators.compare import dominance
    rows = [("A", "m", 1, 5.0), ("B", "m", 1, 1.0), ("A", "m", 2, None), ("B", "m", 2, 9.0),
            ("A", "n", 1, 1.0), ("B", "n", 1, 2.0), ("A", "n", 2, None), ("B", "n", 2, 1.0),
            ("A", "n", 3, 3.0), ("B", "n", 3, 1.0), ("B", "n", 4, 1.0)]
    got = {r["metric"]: r for r in dominance(gap_df(spark, rows), "A", "B").collect()}
    assert got["m"]["always_above"] is None
    assert got["n"]["always_above"] is False
    assert (got["n"]["first_overtake"], got["n"]["n_periods"]) == (3, 4)


def test_to_wide_listed_values(spark):
    rows = [("A", "x", 1, 1.0), ("A", "y", 1, 2.0)]
    w = to_wide(gap_df(spark, rows), ["entity", "period"], "metric", "gap", ["x", "y", "z"])
    r = w.collect()[0]
    assert (r["x"], r["y"], r["z"]) == (1.0, 2.0, None)
