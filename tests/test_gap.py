from conftest import as_dicts, panel_df

from tidemark.operators.gap import gap_to_benchmark, with_benchmark


def test_benchmark_zero_null_missing_keep_row(spark):
    rows = [("B", "m", 1, 0.0), ("A", "m", 1, 5.0),       # bench 0
            ("B", "m", 2, None), ("A", "m", 2, 5.0),      # bench NULL
            ("A", "m", 3, 5.0),                           # no bench row
            ("B", "m", 4, 10.0), ("A", "m", 4, None)]     # value NULL
    out = as_dicts(gap_to_benchmark(panel_df(spark, rows), "B").filter("entity = 'A'"),
                   ["period"])
    assert [r["gap"] for r in out] == [None, None, None, None]
    assert len(out) == 4


def test_benchmark_against_itself_is_100(spark):
    rows = [("B", "m", p, 3.0 + p) for p in range(1, 4)]
    out = as_dicts(gap_to_benchmark(panel_df(spark, rows), "B"))
    assert {r["gap"] for r in out} == {100.0}


def test_rounding_half_away_from_zero(spark):
    # 2.675 % and -0.125 % of a benchmark of 100
    rows = [("B", "m", 1, 100.0), ("A", "m", 1, 2.675), ("C", "m", 1, -0.125)]
    out = {r["entity"]: r["gap"] for r in gap_to_benchmark(panel_df(spark, rows), "B").collect()}
    assert out["A"] == 2.68
    assert out["C"] == -0.13


def test_with_benchmark_broadcasts_bounded_side(spark):
    rows = [("B", "m", 1, 1.0), ("A", "m", 1, 2.0)]
    df = with_benchmark(panel_df(spark, rows), "B", bench_bound=10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
