"""Each DQ operator passes on a clean frame and fails on a frame broken
for it (mutation check)."""
from tidemark.operators import quality as Q


def test_not_null_and_counts(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), (None, None)], "k string, v double")
    assert Q.not_null(df, "v").count() == 2
    counts = {r["column"]: r["nulls"] for r in Q.null_counts(df).collect()}
    assert counts == {"k": 1, "v": 2}


def test_accepted_values_null_passes(spark):
    df = spark.createDataFrame([("x",), (None,), ("y",), ("bad",)], "s string")
    bad = Q.accepted_values(df, "s", ["x", "y"]).collect()
    assert [(r["s"], r["n_rows"]) for r in bad] == [("bad", 1)]


def test_unique_and_grain(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, p int")
    assert Q.unique(df, "k").count() == 1
    assert Q.grain_unique(df, ["k", "p"]).count() == 0
    dup = df.unionByName(df.limit(1))
    assert Q.grain_unique(dup, ["k", "p"]).count() == 1


def test_row_count(spark):
    df = spark.range(5)
    assert Q.row_count_is(df, 5).count() == 0
    assert Q.row_count_is(df, 6).collect()[0]["n_rows"] == 5


def test_only_known_nulls(spark):
    df = spark.createDataFrame([("X", "p", 1, None), ("Y", "p", 1, None), ("Y", "p", 9, None)],
                               "entity string, metric string, period int, value double")
    allow = spark.createDataFrame([("X", "p")], "entity string, metric string")
    bad = Q.only_known_nulls(df, 1, 5, allow).collect()
    assert [(r["entity"], r["period"]) for r in bad] == [("Y", 1)]


def test_status_scoping(spark):
    cols = "bucket string, status string, slope double"
    ok = spark.createDataFrame([("context", "not_classified", 1.0),
                                ("convergence", "no_data", None),
                                ("convergence", "stuck", 0.1)], cols)
    assert Q.status_scoping(ok).count() == 0
    broken = spark.createDataFrame([("context", "catching_up", 1.0),
                                    ("convergence", "no_data", 1.0),
                                    ("convergence", "stuck", None),
                                    ("context_inverted", "diverging", 3.0)], cols)
    assert Q.status_scoping(broken).count() == 4
    ctx = spark.createDataFrame([("context", "no_data", None)], cols)
    assert Q.status_scoping(ctx).count() == 1
    assert Q.status_scoping(ctx, context_exempt_no_data=True).count() == 0


def test_closing_time_checks(spark):
    cols = "status string, closure_status string, years_to_close double"
    ok = spark.createDataFrame([("catching_up", "catching_up", 12.0),
                                ("diverging", "already_closed", 0.0),
                                ("stalled", "stalled", None)], cols)
    assert Q.closing_time_valid(ok).count() == 0
    assert Q.closing_time_null_scoping(ok).count() == 0
    bad = spark.createDataFrame([("catching_up", "catching_up", -1.0),
                                 ("no_data", "already_closed", None)], cols)
    assert Q.closing_time_valid(bad).count() == 2
    bad2 = spark.createDataFrame([("catching_up", "catching_up", 0.0),
                                  ("stalled", "stalled", 5.0),
                                  ("catching_up", "catching_up", None)], cols)
    assert Q.closing_time_null_scoping(bad2).count() == 3


def test_run_checks(spark):
    df = spark.createDataFrame([("a", None)], "k string, v double")
    rep = Q.run_checks([("nn", "t", Q.not_null(df, "v")), ("nk", "t", Q.not_null(df, "k"))])
    assert {r["check"]: r["n_violations"] for r in rep.collect()} == {"nn": 1, "nk": 0}
