"""Repeated passages by sparse suffix arrays.

Of all suffixes of the texts' words only those are retained that begin at a
minimiser: a place whose K-word hash is the least of some W neighbouring ones.
The choice depends on content alone, so every window of LENGTH words belongs
to one retained suffix, and two equal windows to suffixes that agree in their
first K words.

Retained suffixes whose first K words some other document has are sorted by
range over all tasks, by their first words, then by more and more of what
follows and of what stands before.  Neighbours that agree are extended to the left and to the right: of
the windows around both suffixes those are equal that lie in the extension.
Runs of neighbours that share a window are a chain; the window is repeated if
the chain has two documents.  What neighbours leave open, chains cut by a
border between tasks or by suffixes that sorted between, is settled by the
chains' heads, one row a chain: heads of one window meet by its fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import bitset
from tidemark.llm.bytewords import least_places, ngrams
from tidemark.llm.common import freed, importable, read, written
from tidemark.llm.wordhash import word_hashes

LENGTH = 50  # words of a passage at least
K = 15       # words of a suffix that choose it and that neighbours share
AFTER = (25, 50)   # words from a suffix's place on by which suffixes are sorted beyond that
BEFORE = (12, 35)  # then words before it

_SORT = ("after1", "after2", "before1", "before2")
_SUFFIX = f"x long, id long, row long, place int, back int, {', '.join(f'{c} long' for c in _SORT)}, fps array<long>"
_FOUND = "kind byte, id long, row long, start int, n int, x long, fp long, lo long, hi long"
HEAD, RUN, OPEN = 0, 1, 2


def _chosen(batch: pa.RecordBatch, length: int, k: int):
    """For runs of a batch's rows: (first row, word hashes end to end, row of
    each word, hashes of k words, places of windows, their suffixes' places)."""
    for lo, _, flat, sizes in word_hashes(batch.column(0).to_pylist()):
        row = np.repeat(np.arange(len(sizes)), sizes)
        if len(row) < length:
            continue
        at = np.flatnonzero(row[:len(row) - length + 1] == row[length - 1:])
        if len(at):
            x = ngrams(flat, k)
            yield lo, flat, row, x, at, least_places(x, length - k + 1)[at]


def _retained(texts: DataFrame, length: int, k: int) -> DataFrame:
    """(x, id): first words of all retained suffixes."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, _, row, x, _, suffix in _chosen(b, length, k):
                places = np.unique(suffix)
                yield pa.RecordBatch.from_arrays([pa.array(x[places].view(np.int64)),
                                                  b.column(1).take(pa.array(lo + row[places]))], names=["x", "id"])
    return texts.select("text", "id").mapInArrow(find, "x long, id long")


def _suffixes(texts: DataFrame, length: int, k: int, shared) -> DataFrame:
    """Suffixes that the filter ``shared`` holds: place, the words before it
    that its first window has (``back``), hashes to sort by, and the
    fingerprints of its windows."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, flat, row, x, at, suffix in _chosen(b, length, k):
                keep = bitset.found(shared.value, x[suffix])
                at, suffix = at[keep], suffix[keep]
                if not len(at):
                    continue
                fps = ngrams(flat, length)[at].view(np.int64)
                first = np.flatnonzero(np.diff(suffix, prepend=-1))
                cuts = np.append(first, len(at)).astype(np.int32)
                place = suffix[first]
                r = row[place]
                begin, end = np.searchsorted(row, r), np.searchsorted(row, r, side="right")
                more = []
                for n, first_ in [*((n, place) for n in AFTER), *((n, place - n) for n in BEFORE)]:
                    inside = (first_ >= begin) & (first_ + n <= end)  # 0 where the text ends before
                    more.append(np.zeros(len(place), dtype=np.int64))
                    more[-1][inside] = ngrams(flat, n)[first_[inside]].view(np.int64)
                where = pa.array(lo + r)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[place].view(np.int64)), b.column(1).take(where), b.column(2).take(where),
                     pa.array((place - begin).astype(np.int32)), pa.array((place - at[first]).astype(np.int32)),
                     *map(pa.array, more), pa.ListArray.from_arrays(pa.array(cuts), pa.array(fps))],
                    names=[c.split()[0] for c in _SUFFIX.split(", ")])
    return texts.select("text", "id", "row").mapInArrow(find, _SUFFIX)


def _compare(w: int):
    """Compare sorted suffixes with their neighbours.  Gives heads of chains
    (window, least and greatest id), runs of windows that are repeated, and
    windows that are still open."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, ids, row, place, back = (b.column(i).to_numpy() for i in range(5))
            if not len(x):
                continue
            windows = b.column(b.num_columns - 1)
            cuts = windows.offsets.to_numpy()
            fps = windows.values.to_numpy()[cuts[0]:cuts[-1]]
            line = np.repeat(np.arange(len(x)), np.diff(cuts))
            # windows by their distance to the suffix: column w - 1 begins with it
            col = np.arange(len(fps)) - np.repeat(cuts[:-1] - cuts[0], np.diff(cuts)) - back[line] + w - 1
            table, valid = np.zeros((len(x), w), dtype=np.int64), np.zeros((len(x), w), dtype=bool)
            table[line, col], valid[line, col] = fps, True
            # how far neighbours agree to both sides of the suffix
            equal = np.zeros((len(x), w), dtype=bool)
            equal[1:] = (valid[1:] & valid[:-1] & (table[1:] == table[:-1])) & (x[1:] == x[:-1])[:, None]
            lo, hi = np.zeros((len(x), w), dtype=np.int64), np.zeros((len(x), w), dtype=np.int64)
            for c in range(w):
                head = np.flatnonzero(~equal[:, c])
                size = np.diff(np.append(head, len(x)))
                lo[:, c] = np.repeat(np.minimum.reduceat(ids, head), size)
                hi[:, c] = np.repeat(np.maximum.reduceat(ids, head), size)
            i, c = np.nonzero(valid & ~equal)
            yield _rows(HEAD, len(i), x=x[i], fp=table[i, c], lo=lo[i, c], hi=hi[i, c])
            known = valid & (lo < hi)
            i, c = np.nonzero(valid & ~known)
            yield _rows(OPEN, len(i), id=ids[i], row=row[i], start=place[i] + c - w + 1, n=np.ones(len(i)), x=x[i],
                        fp=table[i, c])
            step = np.diff(np.pad(known, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            i, c = np.nonzero(step == 1)
            end = np.nonzero(step == -1)[1]
            yield _rows(RUN, len(i), id=ids[i], row=row[i], start=place[i] + c - w + 1, n=end - c, x=x[i], fp=table[i, c])
    return compare


def _rows(kind: int, count: int, **columns) -> pa.RecordBatch:
    out = []
    for name, type_ in (c.split() for c in _FOUND.split(", ")):
        t = {"byte": pa.int8(), "int": pa.int32(), "long": pa.int64()}[type_]
        out.append(pa.array(np.full(count, kind), t) if name == "kind" else
                   pa.array(np.asarray(columns[name]).astype(t.to_pandas_dtype())) if name in columns else pa.nulls(count, t))
    return pa.RecordBatch.from_arrays(out, names=[c.split()[0] for c in _FOUND.split(", ")])


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             length: int = LENGTH, k: int = K, bits: int = bitset.BITS) -> DataFrame:
    """(id, ``start``, ``n_words``, ``first_id``): the longest passages of a
    document of which every ``length`` words side by side stand in another
    document too, as word positions (from 0); ``first_id`` is the least id of
    all documents that hold the passage's first ``length`` words.  Words are
    runs of letters and digits, lower-cased.

    Passages that overlap, but of which no window over both is repeated, stay
    apart, and so do those that only touch.  Repeats within one document only
    do not count.  NULL, empty and shorter texts have no passage.  Rows with a
    NULL id take no part.  Rows that repeat an id are one document; each of
    its different texts has its passages.  Other columns are not looked at.
    An empty table gives no rows.

    Suffixes are dealt by range of all they are sorted by, so one that a third
    of the corpus holds lies in many tasks.  Nothing is listed pair by pair.
    """
    if not 0 < k <= length:
        raise ValueError("a suffix is chosen by some of the words of a passage")
    spark = docs.sparkSession
    importable(spark)
    # shorter texts have too few characters for the words
    texts = (docs.where(F.col(id_col).isNotNull() & (F.length(text_col) >= 2 * length - 1))
             .select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("id"),
                     F.xxhash64(text_col).alias("row")))
    with freed(spark):
        shared = written(_retained(texts, length, k).groupBy("x").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
                         .where("lo < hi").select("x"), "shared")
        table = spark.sparkContext.broadcast(bitset.bloom(shared, "x", bits))
        suffixes = written(_suffixes(texts, length, k, table), "suffixes")
        order = ["x", *_SORT, "id", "row", "place"]
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        found = written(suffixes.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                        .mapInArrow(_compare(length - k + 1), _FOUND), "compared")
        repeated = written(found.where(F.col("kind") == HEAD).groupBy("x", "fp")
                           .agg(F.min("lo").alias("first_id"), F.max("hi").alias("last"))
                           .where("first_id < last").select("x", "fp", "first_id"), "repeated")
        cols = ["id", "row", "start", "n", "x", "fp"]
        late = found.where(F.col("kind") == OPEN).select(cols).join(repeated, ["x", "fp"], "left_semi").select(cols)
        runs = found.where(F.col("kind") == RUN).select(cols).unionByName(late)
        by = Window.partitionBy("id", "row").orderBy("start", "n")
        end = F.max(F.col("start") + F.col("n")).over(by.rowsBetween(Window.unboundedPreceding, -1))
        joined = written(
            runs.withColumn("new", F.coalesce((F.col("start") > end).cast("int"), F.lit(1)))
            .withColumn("passage", F.sum("new").over(by))
            .groupBy("id", "row", "passage")
            .agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("n")).alias("end"),
                 F.min_by(F.struct("x", "fp"), "start").alias("w")), "passages")
    return (joined.select("id", "start", "end", "w.x", "w.fp").join(repeated, ["x", "fp"])
            .select(F.col("id").alias(id_col), F.col("start").cast("long").alias("start"),
                    (F.col("end") - F.col("start") - 1 + length).cast("long").alias("n_words"), "first_id"))


def op10_repeated_passages(spark, sf_dir):
    return passages(read(spark, sf_dir, "documents").select("doc_id", "text"))


# By the definition: all windows, no choice of suffixes.
OP10_SQL = f"""
WITH d AS (SELECT *, row_number() OVER () AS rid FROM (
  SELECT DISTINCT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'),
                                      lambda x: x <> '') AS w, text
  FROM documents WHERE doc_id IS NOT NULL)),
x AS (
  SELECT rid, doc_id, s AS start, md5(array_to_string(w[s + 1 : s + {LENGTH}], ' ')) AS key
  FROM (SELECT rid, doc_id, w, unnest(range(len(w) - {LENGTH - 1})) AS s FROM d WHERE len(w) >= {LENGTH})),
r AS (SELECT key, min(doc_id) AS first FROM x GROUP BY key HAVING count(DISTINCT doc_id) > 1),
f AS (SELECT rid, doc_id, start, first FROM x JOIN r USING (key)),
g AS (SELECT *, CASE WHEN start = lag(start) OVER q + 1 THEN 0 ELSE 1 END AS new FROM f
      WINDOW q AS (PARTITION BY rid ORDER BY start)),
p AS (SELECT *, sum(new) OVER (PARTITION BY rid ORDER BY start) AS passage FROM g)
SELECT doc_id, min(start)::BIGINT AS start, (max(start) - min(start) + {LENGTH})::BIGINT AS n_words,
       arg_min(first, start) AS first_id
FROM p GROUP BY rid, doc_id, passage
"""
