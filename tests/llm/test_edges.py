"""Edge cases of the corpus operators: NULL ids, repeated rows, very long
texts, clashing columns, empty tables."""
import random

from pyspark.sql import functions as F

from tidemark.llm import decontam, langid, lines, nearcopy, sharding, tokencount

DOCS = "doc_id long, text string"


def prose(seed, n, names=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(names)}x" for _ in range(n))


def test_token_counts_edges(spark):
    initial, rest = ["a", "ab", "w"], ["b", "c"]
    rows = [(None, "ab a"), (1, "ab ab"), (1, "ab ab"), (2, "ab " * 200_000), (3, "a" + "b" * 100_000), (4, None), (5, "")]
    df = spark.createDataFrame([(*r, 9, "x") for r in rows], DOCS + ", n_words int, n_tokens string")
    got = sorted(((r.doc_id, r.n_words, r.n_tokens) for r in tokencount.token_counts(df, initial, rest).collect()), key=str)
    assert got == sorted([(None, 2, 2), (1, 2, 2), (1, 2, 2), (2, 200_000, 200_000), (3, 1, 100_000), (4, 0, 0), (5, 0, 0)], key=str)
    assert tokencount.token_counts(df.limit(0), initial, rest).count() == 0


def test_contaminated_clashing_long_and_shuffled(spark, monkeypatch):
    item = prose(1, 30, 9000)
    rows = [(1, prose(2, 30_000, 9000) + " " + item), (2, "x" * 300_000), (3, item), (3, item), (None, item), (4, None)]
    df = spark.createDataFrame([(*r, "q", 1) for r in rows], DOCS + ", iw string, seed int")
    tests = spark.createDataFrame([(7, item, 5), (8, None, 5), (9, "", 5)], "item_id long, text string, doc_id int")
    want = {(1, 7, 20, 20, 0), (3, 7, 20, 20, 0)}
    assert {tuple(r) for r in decontam.contaminated(df, tests).collect()} == want
    monkeypatch.setattr(decontam, "MAX_SEEDS", 0)     # the same join, by a shuffle
    out = decontam.contaminated(df, tests)
    assert {tuple(r) for r in out.collect()} == want
    assert decontam.contaminated(df, tests.limit(0)).count() == 0


def test_line_dedup_long_clashing_and_empty(spark):
    long = "\n".join(f"line number {i}" for i in range(50_000))
    rows = [(1, long, 5), (2, long + "\nits own last line", 6), (3, "y" * 200_000, 7)]
    df = spark.createDataFrame(rows, DOCS + ", n_lines int")
    got = {r.doc_id: r for r in lines.line_dedup(df).collect()}
    assert got[1].text == long and got[2].text == "its own last line" and len(got[3].text) == 200_000
    assert (got[2].n_lines, got[2]["_n_lines"], got[2].n_dropped) == (6, 50_001, 50_000)
    assert lines.line_dedup(df.limit(0)).count() == 0


def test_write_shards(spark, tmp_path):
    names = ["a", "b", "c"]
    df = spark.createDataFrame([(i, f"t{i}", "mine") for i in range(500)] + [(None, None, None)] * 3,
                               DOCS + ", part string")
    sharding.write_shards(df, f"{tmp_path}/out", names, files_per_shard=2)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(back.columns) == ["doc_id", "part", "shard", "text"] and back.count() == 503
    placed = sharding.assign_shards(df, names).select("doc_id", "shard")
    assert back.select("doc_id", "shard").exceptAll(placed).count() == 0
    files = back.select("shard", F.input_file_name().alias("f")).distinct().groupBy("shard").count().collect()
    assert {r["shard"] for r in files} == set(names) and all(r["count"] <= 2 for r in files)


def test_near_copies_clashing_long_and_repeated(spark):
    long = prose(5, 30_000, 9000)
    rows = [(1, long), (2, long + " more"), (3, prose(6, 60, 9000)), (3, prose(6, 60, 9000)), (4, "z" * 100_000), (5, "z" * 100_000)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], DOCS + ", class_id string, digest int")
    got = {r.doc_id: r.class_id for r in nearcopy.near_copies(df).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4}


def test_pipeline_on_empty_and_repeated_tables(spark, tmp_path):
    import corpus_pipeline as P
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, prose(i, 60, 9000), "en" if i % 2 else "fr", "s", 1) for i in range(20)]
    rows += rows[:5] + [(50 + i, prose(1, 60, 9000), "en", "s", 1) for i in range(6)] + [(None, prose(77, 60, 9000), "en", "s", 1)]
    item = spark.createDataFrame([(1, prose(999, 30, 9000)), (2, "w1x")], "item_id long, text string")
    for name, part in (("full", rows), ("none", [])):
        spark.createDataFrame(part, kind).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        item.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    assert P.run(spark, f"{tmp_path}/none").count() == 0
    got = sorted((r.doc_id if r.doc_id is not None else -1) for r in P.run(spark, f"{tmp_path}/full").collect())
    # an item of one word drops nothing; copies lose their line, and one of the emptied texts stays
    assert got == sorted([-1, *range(20), *range(5), 50])


def test_language_id_sample_of_a_hot_language(spark):
    rows = [(i, "ka lo mi" if i % 50 else "shr ght", "aa" if i % 50 else "bb") for i in range(3000)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    new = spark.createDataFrame([(1, "lo ka"), (2, "ght shr shr")], DOCS)
    assert [r.lang_pred for r in langid.identify(new, model).orderBy("doc_id").collect()] == ["aa", "bb"]
