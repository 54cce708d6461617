"""Substring dedup by relative Lempel-Ziv parsing.

A reference block is a document that is the least one to hold some anchors: a
window of WINDOW words selects the least of the K-word hashes in it, so two
equal windows have equal anchors, and a document can only share a window with
blocks with which it shares an anchor.  Documents are therefore sent, anchor
by anchor, to the block of the least document that holds the anchor, and are
factored greedily against that block's index: a factor goes on as long as the
document and the block agree word by word, and where it ends, the windows over
the end are looked up in the index on their own.  Factors of at least WINDOW
words are duplicate spans.

A window that its block does not hold may still stand in another document
before this one, but then that document has sent it to the same block in vain
too.  These windows are grouped by anchor and fingerprint, the exact way for
what the blocks leave over; so each window is judged, and no document is sent
to every block that shares a passage with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bitset
from tidemark.llm.bytewords import Rows, byte_set, chunks, least_places, ngrams, words
from tidemark.llm.common import freed, fresh, importable, read, written
from tidemark.llm.wordhash import mix

# What separates words.
BLANKS = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

WINDOW = 13      # words of a duplicate span at least
K = 7            # words of an anchor
CHUNK = 1 << 23  # bytes of text that are hashed together
PART = 1 << 14   # anchors that one part of a block's documents has at most, on average

_APART = byte_set(BLANKS)


def _windows(rows: Rows, window: int, k: int):
    """(row of each word, hash of the anchors by place, places of windows,
    their anchors' places, fingerprints of windows by place)"""
    starts, _, hashes = words(rows.buf, _APART)
    row = rows.row_of(starts)
    if len(starts) < window:
        return None
    at = np.flatnonzero(row[:len(row) - window + 1] == row[window - 1:])
    # rows of a chunk that repeat an id with the same text say nothing new
    same = mix(rows.columns[0].to_numpy().view(np.uint64)) ^ rows.columns[1].to_numpy().view(np.uint64)
    once = np.zeros(len(rows), dtype=bool)
    once[np.unique(same, return_index=True)[1]] = True
    at = at[once[row[at]]]
    if not len(at):
        return None
    x = ngrams(hashes, k)
    return row, x, at, least_places(x, window - k + 1)[at], ngrams(hashes, window)


def _lists(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values))


def _anchors(base: DataFrame, window: int, k: int) -> DataFrame:
    """(x, id): the anchors of all windows."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(batches, CHUNK):
            if (found := _windows(rows, window, k)) is None:
                continue
            row, x, _, anchor, _ = found
            places = np.unique(anchor)
            ids = rows.columns[0].to_numpy()[row[places]]
            for lo in range(0, len(places), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[places[lo:lo + (1 << 16)]].view(np.int64)),
                                                  pa.array(ids[lo:lo + (1 << 16)])], names=["x", "id"])
    return base.select("text", "id", "row").mapInArrow(find, "x long, id long")


def _sent(base: DataFrame, window: int, k: int, shared) -> DataFrame:
    """(x, id, row, start, fps): for every anchor that the filter ``shared``
    holds, the fingerprints of its windows and the first one's place."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(batches, CHUNK):
            if (found := _windows(rows, window, k)) is None:
                continue
            row, x, at, anchor, fps = found
            keep = bitset.found(shared.value, x[anchor])
            at, anchor = at[keep], anchor[keep]
            if not len(at):
                continue
            first = np.flatnonzero(np.diff(anchor, prepend=-1) | (np.diff(at, prepend=-2) != 1))
            cuts = np.append(first, len(at))
            r = row[at[first]]
            place = at[first] - np.searchsorted(row, r)
            for lo in range(0, len(first), 1 << 15):
                hi = min(lo + (1 << 15), len(first))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[anchor[first[lo:hi]]].view(np.int64)), rows.columns[0].take(pa.array(r[lo:hi])),
                     rows.columns[1].take(pa.array(r[lo:hi])), pa.array(place[lo:hi].astype(np.int32)),
                     _lists(fps[at[cuts[lo]:cuts[hi]]].view(np.int64), cuts[lo:hi + 1] - cuts[lo])],
                    names=["x", "id", "row", "start", "fps"])
    return base.select("text", "id", "row").mapInArrow(find, "x long, id long, row long, start int, fps array<long>")


_FACTORED = "id long, row long, start int, n int, ref long, ref_start int, x long, fp long"


def _factor(window: int):
    """Parse documents against their blocks.  Rows come by block, the block's
    own windows before the documents; its index is kept from batch to batch."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, kept_key, kept_at = None, np.zeros(0, np.uint64), np.zeros(0, np.int32)
        for b in batches:
            if not b.num_rows:
                continue
            ref, salt, own, ids, rowkey, x, start = (b.column(i).to_numpy(zero_copy_only=False) for i in range(7))
            fps = b.column(7)
            cuts = fps.offsets.to_numpy()
            size = np.diff(cuts)
            line = np.repeat(np.arange(b.num_rows), size)
            at = (start[line] + np.arange(len(line)) - np.repeat(cuts[:-1] - cuts[0], size)).astype(np.int32)
            with np.errstate(over="ignore"):
                seed = mix(mix(ref.view(np.uint64)) + salt.astype(np.uint64))
            fp = fps.values.to_numpy()[cuts[0]:cuts[-1]]
            key = mix(fp.view(np.uint64) ^ seed[line])
            same = block == (ref[0], salt[0])
            mine = own[line]
            all_key = np.concatenate([kept_key, key[mine]]) if same else key[mine]
            all_at = np.concatenate([kept_at, at[mine]]) if same else at[mine]
            order = np.lexsort((all_at, all_key))
            index, source = all_key[order], all_at[order]
            last = (ref == ref[-1]) & (salt == salt[-1])
            of_last = mine & last[line]
            if same and last[0]:  # still the same block
                kept_key, kept_at = np.concatenate([kept_key, key[of_last]]), np.concatenate([kept_at, at[of_last]])
            else:
                kept_key, kept_at = key[of_last], at[of_last]
            block = (ref[-1], salt[-1])
            q = np.flatnonzero(~mine)
            if not len(q):
                continue
            found = np.searchsorted(index, key[q])
            hit = np.zeros(len(q), dtype=bool)
            inside = found < len(index)
            hit[inside] = index[found[inside]] == key[q][inside]
            h = q[hit]
            if len(h):
                src, ln, w = source[found[hit]], line[h], at[h]
                fresh_ = np.ones(len(h), dtype=bool)
                fresh_[1:] = ((ref[ln[1:]] != ref[ln[:-1]]) | (ids[ln[1:]] != ids[ln[:-1]])
                              | (rowkey[ln[1:]] != rowkey[ln[:-1]]) | (np.diff(w) != 1) | (np.diff(src) != 1))
                f = np.flatnonzero(fresh_)
                n = np.diff(np.append(f, len(h))) + window - 1
                none = pa.nulls(len(f), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[ln[f]]), pa.array(rowkey[ln[f]]), pa.array(w[f]), pa.array(n.astype(np.int32)),
                     pa.array(ref[ln[f]]), pa.array(src[f]), none, none], names=[c.split()[0] for c in _FACTORED.split(", ")])
            m = q[~hit]
            if len(m):
                ln = line[m]
                none = pa.nulls(len(m), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[ln]), pa.array(rowkey[ln]), pa.array(at[m]), none, pa.nulls(len(m), pa.int64()), none,
                     pa.array(x[ln]), pa.array(fp[m])], names=[c.split()[0] for c in _FACTORED.split(", ")])
    return parse


def duplicate_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    k: int = K, part: int = PART, bits: int = bitset.BITS) -> DataFrame:
    """(id, row, start, n, ref, ref_start): spans of ``n`` words from word
    ``start`` (from 0) on, every ``window`` words of which stand side by side
    in a document with a smaller id too; together the spans cover all such
    windows.  ``ref`` is such a document and ``ref_start`` the place there
    (NULL for single windows found outside the blocks).  ``row`` is the
    text's hash and tells rows apart that repeat an id.

    A block that very many documents are sent to is dealt over parts, each
    with the block's index; their number follows the count of its anchors.
    """
    if not 0 < k <= window:
        raise ValueError("an anchor has at least one word and at most a window's")
    spark = docs.sparkSession
    importable(spark)
    base = (docs.where(F.col(id_col).isNotNull() & (F.length(text_col) >= 2 * window - 1))
            .select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("id"),
                    F.xxhash64(text_col).alias("row")))
    with freed(spark):
        shared = written(_anchors(base, window, k).groupBy("x")
                         .agg(F.min("id").alias("ref"), F.max("id").alias("last"), F.count("*").alias("n"))
                         .where("ref < last").select("x", "ref", "n"), "anchors")
        table = spark.sparkContext.broadcast(bitset.bloom(shared, "x", bits))
        parts = (shared.groupBy("ref").agg(F.ceil(F.sum("n") / part).cast("int").alias("parts")).where("parts > 1"))
        blocks = written(shared.join(parts, "ref", "left")
                         .select("x", "ref", F.coalesce("parts", F.lit(1)).alias("parts")), "blocks")
        own = F.col("id") == F.col("ref")
        salts = F.when(own, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("id", "row"), F.col("parts")).cast("int")))
        sent = (_sent(base, window, k, table).join(blocks, "x")
                .select("ref", F.explode(salts).alias("salt"), own.alias("own"), "id", "row", "x", "start", "fps"))
        factored = written(sent.repartition("ref", "salt")
                           .sortWithinPartitions("ref", "salt", F.desc("own"), "id", "row", "start")
                           .mapInArrow(_factor(window), _FACTORED), "factors")
        left = factored.where("ref IS NULL")
        again = (left.groupBy("x", "fp").agg(F.min("id").alias("first"), F.max("id").alias("last"))
                 .where("first < last").select("x", "fp", "first"))
        single = (left.select("id", "row", "start", "x", "fp").join(again, ["x", "fp"]).where("first < id")
                  .select("id", "row", "start", F.lit(window).alias("n"), F.col("first").alias("ref"),
                          F.lit(None).cast("int").alias("ref_start")))
        single = written(single, "single-windows")
    return (factored.where("ref IS NOT NULL").select("id", "row", "start", "n", "ref", "ref_start")
            .unionByName(single))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    k: int = K, part: int = PART) -> DataFrame:
    """``docs`` with the words of all duplicate spans taken out of its text
    and the others joined by one space, plus ``n_words`` (before) and
    ``n_removed``; these get a leading underscore where ``docs`` has such a
    column.

    Words are runs of characters other than ASCII white space, unchanged.  A
    word goes if a window of ``window`` words that covers it also starts in a
    document with a smaller id; windows are judged on the input.  NULL text
    becomes the empty text.  Rows with a NULL id neither claim nor lose words;
    rows that repeat an id are one document and each keep their text.  An
    empty table gives no rows.
    """
    n_words, n_removed, h, spans, list_ = fresh(docs, "n_words", "n_removed", "text_row", "dup_spans", "text_words")
    found = (duplicate_spans(docs, id_col, text_col, window, k, part)
             .groupBy("id", "row").agg(F.collect_set(F.struct("start", "n")).alias(spans))
             .select(F.col("id").alias(f"{h}_id"), F.col("row").alias(f"{h}_row"), spans))
    joined = (docs.withColumn(h, F.xxhash64(text_col))
              .join(found, (F.col(id_col) == F.col(f"{h}_id")) & (F.col(h) == F.col(f"{h}_row")), "left"))
    all_ = F.col(list_)
    gone = F.flatten(F.transform(F.col(spans), lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1)))
    kept = F.array_except(F.sequence(F.lit(0), F.size(all_) - 1), gone)
    size = fresh(joined, "kept_places")[0]
    return (joined.withColumn(list_, F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD), F.lit(0)))
            .withColumn(size, F.when(F.col(spans).isNotNull(), kept))
            .withColumn(n_words, F.size(all_).cast("long"))
            .withColumn(n_removed, F.coalesce(F.size(all_) - F.size(size), F.lit(0)).cast("long"))
            .withColumn(text_col, F.array_join(F.when(F.col(size).isNull(), all_).otherwise(
                F.transform(F.col(size), lambda i: F.get(all_, i))), " "))
            .select(*docs.columns, n_words, n_removed))


def op13_substring_dedup(spark, sf_dir):
    out = substring_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


# By the definition: all windows.
OP13_SQL = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
x AS (
  SELECT rid, doc_id, s, array_to_string(w[s + 1 : s + {WINDOW}], ' ') AS key
  FROM (SELECT *, unnest(range(len(w) - {WINDOW - 1})) AS s FROM d WHERE len(w) >= {WINDOW} AND doc_id IS NOT NULL)),
m AS (SELECT key, min(doc_id) AS first FROM x GROUP BY key),
g AS (SELECT DISTINCT rid, unnest(range(s, s + {WINDOW})) AS i FROM x JOIN m USING (key) WHERE doc_id > first),
l AS (SELECT rid, doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(r.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(t.text, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT rid, count(*) AS n FROM g GROUP BY rid) r USING (rid)
LEFT JOIN (SELECT l.rid, string_agg(l.word, ' ' ORDER BY l.i) AS text FROM l LEFT JOIN g ON g.rid = l.rid AND g.i = l.i
           WHERE g.rid IS NULL GROUP BY l.rid) t USING (rid)
"""
