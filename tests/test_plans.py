"""Plan shape: pushdown, broadcast of bounded sides, one shuffle per trend."""
from conftest import SF001

from tidemark.plans import marts
from tidemark.sources import tables
from tidemark.operators.trend import trend


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_orders_scan_pushes_date_filter_and_prunes(spark):
    p = tables.nation_panel(spark, SF001)
    s = plan(p.df)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in s
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate" in s


def test_gap_benchmark_join_is_broadcast(spark):
    p = tables.nation_panel(spark, SF001)
    s = plan(marts.gap_of(p))
    assert "BroadcastHashJoin" in s and "LeftOuter" in s


def test_trend_one_shuffle_on_series_key(spark):
    g = spark.read.parquet(SF001 + "/orders.parquet").selectExpr(
        "cast(o_custkey as string) as entity", "o_orderpriority as metric",
        "year(o_orderdate) as period", "o_totalprice as gap")
    s = plan(trend(g, 1995, 2000))
    assert s.count("Exchange hashpartitioning") == 1
    assert "partial_regr_slope" in s or "PartialMerge" in s or "Partial" in s


def shuffles(df):
    import re
    return len(re.findall(r"(?<!Broadcast)Exchange", plan(df)))


def test_closing_time_one_shuffle_dims_after(spark):
    p = tables.persist_panel(tables.nation_panel(spark, SF001))
    s = plan(marts.closing_of(p))
    assert shuffles(marts.closing_of(p)) == 1
    # tree strings print the root first: below the (first) aggregate the
    # only outer join is the benchmark's; the two dimension joins sit above
    below = s[s.index("HashAggregate"):]
    assert below.count("LeftOuter") == 1
    assert s[:s.index("HashAggregate")].count("LeftOuter") == 2


def test_gap_reads_written_panel_not_fact_tables(spark):
    p = tables.persist_panel(tables.nation_panel(spark, SF001))
    s = plan(marts.gap_of(p))
    assert "orders.parquet" not in s and "tidemark-panels" in s


def test_pivot_is_one_shuffle(spark):
    from tidemark.operators.reshape import to_wide
    p = tables.persist_panel(tables.nation_panel(spark, SF001))
    w = to_wide(marts.gap_fact(p), ["entity", "period"], "metric", "gap", p.metrics)
    assert shuffles(w) == 1
