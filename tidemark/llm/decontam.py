"""Benchmark decontamination by spaced seeds.

A seed looks at some of a few neighbouring words and ignores the others, as
one of a few fixed masks says.  The hashes of all seeds of the test items
are joined with those of the training texts; a hit puts an item at a place
in a text, and the words of both are compared there.  A substituted word
spoils only the seeds whose mask looks at it.  The masks of every item length
cover all sets of substitutions that SHARE accepts: whichever words are
exchanged, a seed without one of them is left, so no hit is missed.

Built from DataFrame functions only.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import read, word_hashes

# Fixed values: (words of an item at least, masks).  1: the word counts, 0: it
# may differ.  The tests hold each against all substitutions of a window.
COVERS = ((10, ("111011", "11001011", "11111")), (6, ("11011", "1111")), (5, ("111", "1101")),
          (4, ("1111",)), (3, ("111",)), (2, ("11",)), (1, ("1",)))
WINDOW = 20        # words of an item that must be found side by side, or all it has
SHARE = 0.8        # share of these words that must be equal
# Seeds of the test set that are broadcast at most: 4 M rows of 24 bytes.
# Beyond that, the same join is a shuffle join.
MAX_SEEDS = 4_000_000


def covers(share: float = SHARE) -> tuple[tuple[int, tuple[str, ...]], ...]:
    """(words of an item at least, masks), longest items first.  Below SHARE a
    mask is the run of equal words that is left in every accepted window."""
    if share >= SHARE:
        return COVERS
    if share <= 0:
        raise ValueError("share must be positive")
    runs = []
    for n in range(WINDOW, 0, -1):
        equal = max(1, math.ceil(share * n - 1e-9))
        runs.append((n, ("1" * math.ceil(equal / (n - equal + 1)),)))
    return tuple(runs)


def _seed(words: Column, at: Column, mask: str) -> Column:
    """Hash of the words a mask looks at from a position; NULL where the
    mask reaches beyond the words."""
    looks = [F.get(words, at + F.lit(i)) for i, c in enumerate(mask) if c == "1"]
    return F.when(at + F.lit(len(mask)) <= F.size(words), F.xxhash64(F.lit(mask), *looks))


def _seed_rows(df: DataFrame, words: str, masks: list[str], *keep: str) -> DataFrame:
    """(keep..., pos, seed) for every place of a mask in a row's words."""
    pos = F.sequence(F.lit(0), F.size(words) - 1)
    seeds = F.array(*[_seed(F.col(words), F.col("pos"), m) for m in masks])
    return (df.where(F.size(words) > 0)
            .select(*keep, words, F.explode(pos).alias("pos"))
            .select(*keep, "pos", F.explode(seeds).alias("seed")).where("seed IS NOT NULL"))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", share: float = SHARE) -> DataFrame:
    """(id, item id, ``n_match``, ``n_window``, ``item_word``): the items a
    document holds, with the best window of min(WINDOW, words of the item)
    item words: how many of them the document has at the same places, and
    where the window begins.  Only windows with at least ``share`` of their
    words equal count.  Words are runs of letters and digits, lower-cased.

    Items without a word (NULL, empty) take no part; an item of few words is
    found wherever its words stand, be it by chance.  A document may begin or
    end inside an item: words it lacks count as exchanged.  Rows with a NULL
    id or NULL item id take no part.  Repeated rows give one row per (id, item id); ties between
    windows go to the first.  Empty tables give no rows.

    A passage that a third of the documents hold gives each of them its own
    few rows; nothing is paired among documents.  Seed hits are reduced to
    distinct (document, item, shift) before texts are joined back.
    """
    tests = (items.where(F.col(item_col).isNotNull())
             .select(F.col(item_col).alias("item"), word_hashes(F.col(item_text_col)).alias("iw"))
             .where(F.size("iw") > 0).distinct())
    # masks of the item lengths there are
    table, top = covers(share), None
    size, parts, used = F.size("iw"), [], set()
    lengths = {r[0] for r in tests.select(F.least(size, F.lit(WINDOW))).distinct().collect()}
    for least, masks in table:
        if any(n >= least and (top is None or n < top) for n in lengths):
            own = tests.where((size >= least) & (size < top if top else F.lit(True)))
            parts.append(_seed_rows(own, "iw", list(masks), "item"))
            used.update(masks)
        top = least
    if not parts:
        parts.append(_seed_rows(tests, "iw", list(table[0][1]), "item"))
    seeds = reduce(DataFrame.unionAll, parts).select("seed", "item", F.col("pos").alias("ipos"))
    small = seeds.count() <= MAX_SEEDS
    texts = (docs.where(F.col(id_col).isNotNull())
             .select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    rows = _seed_rows(texts.select("id", word_hashes(F.col("text")).alias("dw")), "dw",
                      sorted(used or table[0][1]), "id")
    hits = (rows.join(F.broadcast(seeds) if small else seeds, "seed")
            .select("id", "item", (F.col("pos") - F.col("ipos")).alias("shift")).distinct())

    # compare the words around each hit
    found = (hits.join(F.broadcast(tests) if small else tests, "item")
             .join(texts.join(hits.select("id").distinct(), "id", "left_semi")
                   .select("id", word_hashes(F.col("text")).alias("dw")), "id"))
    window = F.least(F.lit(WINDOW), F.size("iw"))
    equal = F.transform("iw", lambda w, i: F.coalesce(
        (w == F.when(i + F.col("shift") >= 0, F.get("dw", i + F.col("shift")))).cast("int"), F.lit(0)))
    runs = F.transform(
        F.sequence(F.lit(0), F.size("iw") - window),
        lambda i: F.struct(F.aggregate(F.slice("equal", i + 1, window), F.lit(0),
                                       lambda s, x: s + x).alias("n"), (-i).alias("at")))
    best = (found.select("id", "item", "iw", equal.alias("equal"))
            .select("id", "item", window.alias("n_window"), F.array_max(runs).alias("best"))
            .where(F.col("best.n") >= F.ceil(F.lit(share) * F.col("n_window") - 1e-9))
            .groupBy("id", "item")
            .agg(F.max(F.struct("best", "n_window")).alias("b")))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col),
                       F.col("b.best.n").cast("long").alias("n_match"),
                       F.col("b.n_window").cast("long").alias("n_window"),
                       (-F.col("b.best.at")).cast("long").alias("item_word"))


def op2_decontamination(spark, sf_dir):
    return contaminated(read(spark, sf_dir, "documents").select("doc_id", "text"),
                        read(spark, sf_dir, "benchmark").select("item_id", "text"))


# The rule itself: every alignment of an item with a text, by all the places
# where their words are equal.
def op2_sql() -> str:
    words = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
    return f"""
WITH d AS (SELECT *, row_number() OVER () AS d FROM (
  SELECT DISTINCT doc_id, {words} AS w FROM documents WHERE doc_id IS NOT NULL)),
b AS (SELECT *, row_number() OVER () AS b, least({WINDOW}, len(w)) AS n_window FROM (
  SELECT DISTINCT item_id, {words} AS w FROM benchmark WHERE item_id IS NOT NULL)),
al AS (
  SELECT x.d, y.b, x.p - y.q AS s, list(y.q) AS equal
  FROM (SELECT d, unnest(w) AS word, unnest(range(len(w))) AS p FROM d) x
  JOIN (SELECT b, unnest(w) AS word, unnest(range(len(w))) AS q FROM b) y USING (word)
  GROUP BY x.d, y.b, s),
win AS (
  SELECT doc_id, item_id, n_window, u.o AS o,
         len(list_filter(equal, lambda q: q >= u.o AND q < u.o + n_window)) AS n
  FROM (SELECT * FROM al JOIN b USING (b) JOIN (SELECT d, doc_id FROM d) USING (d)
        WHERE len(equal) >= ceil({SHARE} * n_window - 1e-9)) h,
       LATERAL (SELECT unnest(range(len(h.w) - h.n_window + 1)) AS o) u)
SELECT doc_id, item_id, max(n)::BIGINT AS n_match, arg_max(n_window, n)::BIGINT AS n_window,
       arg_min(o, o - n * 1000000)::BIGINT AS item_word
FROM win WHERE n >= ceil({SHARE} * n_window - 1e-9)
GROUP BY doc_id, item_id
"""
