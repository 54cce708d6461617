import random

from tidemark.operators.rank import count_below, value_rank


def brute_below(rows, weights=None):
    out = {}
    for i, (g, k, _) in enumerate(rows):
        if k is None:
            out[i] = None
            continue
        out[i] = sum((weights[j] if weights else 1)
                     for j, (g2, k2, _) in enumerate(rows) if g2 == g and k2 is not None and k2 < k)
    return out


def test_count_below_matches_brute_force_with_ties_and_nulls(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("ab"), rnd.choice([None, 1.0, 2.0, 2.0, 3.5, rnd.random() * 10]), i)
            for i in range(400)]
    df = spark.createDataFrame(rows, "g string, k double, id int").repartition(5)
    got = {r["id"]: r["below"] for r in count_below(df, ["g"], "k").collect()}
    expect = brute_below(rows)
    assert got == {rows[i][2]: expect[i] for i in range(len(rows))}


def test_count_below_weighted(spark):
    rnd = random.Random(3)
    rows = [("g", float(rnd.randint(0, 20)), i) for i in range(200)]
    w = [rnd.randint(0, 1) for _ in rows]
    df = spark.createDataFrame([r + (w[i],) for i, r in enumerate(rows)],
                               "g string, k double, id int, w long")
    got = {r["id"]: (r["below"], r["n_group"])
           for r in count_below(df, ["g"], "k", weight="w").collect()}
    expect = brute_below(rows, w)
    assert all(got[i] == (expect[i], sum(w)) for i in range(len(rows)))


def test_value_rank_is_sql_rank(spark):
    df = spark.createDataFrame([("m", "A", 3.0), ("m", "B", 1.0), ("m", "C", 3.0),
                                ("m", "D", 7.0)], "metric string, entity string, v double")
    out = {r["entity"]: (r["rank"], r["percent_rank"]) for r in
           value_rank(df, ["metric"], "v").collect()}
    assert out == {"B": (1, 0.0), "A": (2, 1 / 3), "C": (2, 1 / 3), "D": (4, 1.0)}
    desc = {r["entity"]: r["rank"] for r in value_rank(df, ["metric"], "v", True).collect()}
    assert desc == {"D": 1, "A": 2, "C": 2, "B": 4}


def test_next_key_is_next_distinct_value(spark):
    rows = [("m", "A", 3.0), ("m", "B", 1.0), ("m", "C", 3.0), ("m", "D", 7.0), ("n", "E", 2.0)]
    df = spark.createDataFrame(rows, "metric string, entity string, v double")
    out = {r["entity"]: r["nxt"] for r in
           value_rank(df, ["metric"], "v", next_out="nxt").collect()}
    assert out == {"B": 3.0, "A": 7.0, "C": 7.0, "D": None, "E": None}
