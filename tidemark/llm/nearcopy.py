"""Near-copy classes by ProbMinHash.

A document is the multiset of its five-word shingles.  Every shingle sends
exponential arrivals, at the rate of its count, to random registers; a
register keeps the shingle that arrives first, and a shingle stops as soon
as its next arrival is later than all registers of the document.  Equal
registers estimate the probability Jaccard similarity.  Bands of registers
give buckets; what shares a bucket is verified with the exact similarity.

Classes are the connected components of all verified bucket pairs, found
without listing the pairs of a bucket:

1. copies with equal words become one representative;
2. each bucket's members are compared with its least member;
3. only in buckets that still hold several components, shingles that no
   other such document has are counted.  They bound a document's similarity
   to any other from above; a document that no other can reach drops out.
   Documents with a chain of shared buckets make a group, whose HUBS members
   with the smallest shares of own shingles are compared with the rest;
4. those still outside the largest component of their group meet blocks of
   the group, whose shared weights are one matrix product; only what may be
   similar comes out and is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import importable, read, written
from tidemark.llm.components import components
from tidemark.llm.wordhash import mix, word_hashes

WORDS = 5            # words in a shingle
SIMILARITY = 0.8
HUBS = 16            # members of a group that are compared with all others at once
BLOCK = 32_000       # shingles in a block, on average
BANDS, ROWS = 30, 5  # a pair of similarity 0.8 is missed with probability 7e-6
HASH_BITS = 52

_MASK = np.uint64((1 << HASH_BITS) - 1)


def shingles(hashes: np.ndarray, sizes: np.ndarray, k: int = WORDS):
    """Distinct shingles of documents whose word hashes lie end to end:
    (document, shingle hash, count).  A document of fewer than k words has
    one shingle, of all its words."""
    docs, n = len(sizes), len(hashes)
    first = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(docs, dtype=np.uint64), sizes)
    left = np.repeat(first + sizes, sizes) - np.arange(n)  # words from here to the end
    with np.errstate(over="ignore"):
        code = np.zeros(n, dtype=np.uint64)
        padded = np.concatenate([hashes, np.zeros(k, dtype=np.uint64)])
        for j in range(k):
            word = padded[j:j + n] * np.uint64(2 * j + 0x9E3779B97F4A7C15)
            code += mix(np.where(left > j, word, np.uint64(j)))
    keep = (left >= k) | ((np.repeat(sizes, sizes) < k) & (np.repeat(first, sizes) == np.arange(n)))
    key = np.sort((owner[keep] << np.uint64(HASH_BITS)) | (mix(code[keep]) & _MASK))
    if not len(key):
        return np.zeros(0, np.int64), key, np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.concatenate([new, [len(key)]]))
    key = key[new]
    return (key >> np.uint64(HASH_BITS)).astype(np.int64), key & _MASK, count


def prob_minhash(doc: np.ndarray, item: np.ndarray, weight: np.ndarray, docs: int,
                 registers: int) -> np.ndarray:
    """Register contents, docs x registers (0 where a document has no item)."""
    best = np.full(docs * registers, np.inf)
    kept = np.zeros(docs * registers, dtype=np.uint64)
    time = np.zeros(len(item))
    step = 0
    while len(item):
        with np.errstate(over="ignore"):
            r = mix(item + np.uint64(step + 1) * np.uint64(0xA24BAED4963EE407))
            # 53 random bits for the waiting time, another mix for the register
            time = time - np.log(((r >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53) / weight
            register = (mix(r) % np.uint64(registers)).astype(np.int64)
        latest = best.reshape(docs, registers).max(axis=1)
        go = time < latest[doc]
        doc, item, weight, time, register = (x[go] for x in (doc, item, weight, time, register))
        at = doc * registers + register
        np.minimum.at(best, at, time)
        won = best[at] == time
        kept[at[won]] = item[won]
        step += 1
    return kept.reshape(docs, registers)


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Probability Jaccard similarity of two weighted sets (sorted items):
    the sum over shared d of 1 / sum_e max(a_e / a_d, b_e / b_d)."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    shared = b[at] == a
    n = int(shared.sum())
    if not n:
        return 0.0
    if (wa == 1).all() and (wb == 1).all():
        return n / (len(a) + len(b) - n)
    x, y = wa[shared].astype(float), wb[at[shared]].astype(float)
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    ratio = x / y
    order = np.argsort(ratio)
    x, y, ratio = x[order], y[order], ratio[order]
    below = np.cumsum(y)             # items up to d count b_e * ratio_d
    above = x[::-1].cumsum()[::-1] - x  # those after it count a_e
    total = above + only_a + ratio * (below + only_b)
    return float((x / total).sum())


def _digests(part: np.ndarray, n: np.ndarray, texts: list[str | None]) -> list[bytes]:
    """Digest of every document's words; of its text where it has none."""
    cut = np.cumsum(n)
    return [blake2b(part[e - m:e].tobytes(), digest_size=16).digest() if m else
            blake2b((t or "").encode("utf-8", "surrogatepass"), digest_size=16, person=b"wordless").digest()
            for e, m, t in zip(cut.tolist(), n.tolist(), texts, strict=True)]


def _steps(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, word hashes end to end, number of words of each row)
    for runs of at most 4,000 rows."""
    for lo, hi, flat, sizes in word_hashes(batch.column(1).to_pylist()):
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        for a in range(0, hi - lo, 4000):
            b = min(a + 4000, hi - lo)
            yield lo + a, lo + b, flat[cuts[a]:cuts[b]], sizes[a:b]


def sketches(docs: DataFrame) -> DataFrame:
    """(id, digest, bands) of docs (id, text); no bands without words."""
    registers = BANDS * ROWS

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, part, n in _steps(batch):
                doc, item, count = shingles(part, n)
                kept = prob_minhash(doc, item, count.astype(float), hi - lo, registers)
                bands = np.zeros((hi - lo, BANDS), dtype=np.uint64)
                with np.errstate(over="ignore"):
                    for j in range(ROWS):
                        bands = mix(bands * np.uint64(31) + kept[:, j::ROWS])
                digests = _digests(part, n, batch.column(1).slice(lo, hi - lo).to_pylist())
                ends = np.concatenate([[0], np.cumsum(n > 0)]).astype(np.int32) * BANDS
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(digests, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(bands[n > 0].reshape(-1).view(np.int64)))],
                    names=["id", "digest", "bands"])

    return docs.mapInArrow(sketch, "id long, digest binary, bands array<long>")


def weighted_shingles(docs: DataFrame) -> DataFrame:
    """(id, sorted distinct shingles, their counts) of docs (id, text): one
    row per id, of the text whose digest is least."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, part, n in _steps(batch):
                doc, item, count = shingles(part, n)
                cut = pa.array(np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo),
                     pa.array(_digests(part, n, batch.column(1).slice(lo, hi - lo).to_pylist()), pa.binary()),
                     pa.ListArray.from_arrays(cut, pa.array(item.astype(np.int64))),
                     pa.ListArray.from_arrays(cut, pa.array(count.astype(np.int32)))],
                    names=["id", "digest", "items", "counts"])

    return (docs.mapInArrow(spell, "id long, digest binary, items array<long>, counts array<int>")
            .groupBy("id").agg(F.min_by(F.struct("items", "counts"), "digest").alias("s"))
            .select("id", "s.items", "s.counts"))


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of pairs (a, b) whose exact similarity reaches ``least``."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = [batch.column(i) for i in range(2, 6)]
            flat = [c.flatten().to_numpy(zero_copy_only=False) for c in col]
            cut = [c.offsets.to_numpy() - c.offsets[0].as_py() for c in col]
            ok = [similarity(*(f[c[i]:c[i + 1]] for f, c in zip(flat, cut, strict=True)))
                  >= least - 1e-12 for i in range(batch.num_rows)]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    left = sets.select(F.col("id").alias("a"), F.col("items").alias("ia"), F.col("counts").alias("ca"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("ib"), F.col("counts").alias("cb"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "ia", "ca", "ib", "cb")
            .mapInArrow(judge, "a long, b long"))


def allowed(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """(a, b) of all documents in the two blocks of a row, of different roots,
    whose shared shingles allow the similarity ``least``: with weights A and B,
    X and Y of them shared, it is at most X Y / (A Y + (B - Y) X)."""

    def sets_of(block) -> tuple:
        docs = block.values
        items, counts = docs.field("items"), docs.field("counts")
        cuts = items.offsets.to_numpy()
        return (docs.field("rep").to_numpy(), docs.field("root").to_numpy(),
                np.repeat(np.arange(len(docs)), np.diff(cuts)), items.values.to_numpy()[cuts[0]:cuts[-1]],
                counts.values.to_numpy()[cuts[0]:cuts[-1]].astype(np.float32))

    for batch in batches:
        for row in range(batch.num_rows):
            a, root_a, doc_a, item_a, w_a = sets_of(batch.column(0)[row])
            b, root_b, doc_b, item_b, w_b = sets_of(batch.column(1)[row])
            total_a = np.bincount(doc_a, w_a, len(a))[:, None]
            total_b = np.bincount(doc_b, w_b, len(b))[None, :]
            both = np.intersect1d(item_a, item_b)
            x, y = np.zeros((len(a), len(b))), np.zeros((len(a), len(b)))
            for lo in range(0, len(both), 4096):
                part = both[lo:lo + 4096]
                sides = []
                for doc, item, w, n in ((doc_a, item_a, w_a, len(a)), (doc_b, item_b, w_b, len(b))):
                    at = np.minimum(np.searchsorted(part, item), len(part) - 1)
                    hit = part[at] == item
                    m = np.zeros((n, len(part)), dtype=np.float32)
                    m[doc[hit], at[hit]] = w[hit]
                    sides.append(m)
                x += sides[0] @ (sides[1] > 0).astype(np.float32).T
                y += (sides[0] > 0).astype(np.float32) @ sides[1].T
            top = x * y >= (least - 1e-6) * (total_a * y + (total_b - y) * x)
            i, j = np.nonzero(top & (x > 0) & (root_a[:, None] != root_b[None, :]))
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a[i], b[j])), pa.array(np.minimum(a[i], b[j]))],
                                             names=["a", "b"])


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least: float = SIMILARITY) -> DataFrame:
    """(id, ``class_id``, ``copy_of``) for every distinct id: the least id of
    its class, and the least id of the documents with the very same words.

    A class is a connected component of documents that share a bucket and
    have probability Jaccard similarity >= ``least`` on counted five-word
    shingles (plain Jaccard where no shingle repeats).  Documents of fewer
    than five words have one shingle.  Documents without words (empty, only
    punctuation) are a class if their texts are the same; NULL counts as
    empty.  Rows with a NULL id are left out.  Rows that repeat an id: the class of the row whose digest is
    least counts for all.  An empty table gives no rows.
    """
    importable(docs.sparkSession)
    texts = (docs.where(F.col(id_col).isNotNull())
             .select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")))
    sketch = written(sketches(texts), "sketches")
    one = sketch.groupBy("id").agg(F.min("digest").alias("digest"))
    reps = sketch.groupBy("digest").agg(F.min("id").alias("rep"), F.any_value("bands").alias("bands"))

    # buckets with several representatives
    rows = reps.select("rep", F.posexplode("bands").alias("band", "bucket"))
    shared = (rows.groupBy("band", "bucket").agg(F.min("rep").alias("hub"), F.max("rep").alias("last"))
              .where("hub < last").drop("last"))
    buckets = written(rows.join(shared, ["band", "bucket"]), "buckets")
    sets = written(weighted_shingles(
        texts.join(buckets.select(F.col("rep").alias("id")).distinct(), "id", "left_semi")), "shingles")

    # 2. the least member of each bucket
    pairs = buckets.where("rep > hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    links = written(verified(pairs, sets, least), "verified")
    roots = components(links)

    # 3. buckets with several components
    def labelled(rows: DataFrame, roots: DataFrame) -> DataFrame:
        named = (rows.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
                 .withColumn("root", F.coalesce("root", "rep")))
        mixed = (named.groupBy("band", "bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                 .where("lo < hi").select("band", "bucket"))
        return named.join(mixed, ["band", "bucket"], "left_semi")

    def reaches(x: str, y: str):
        """Whether documents with these shares of own shingles can be similar:
        J <= (1 - x)(1 - y) / (1 - xy), from the concavity of the sum over the
        shared shingles, with equality where the rest has equal weights."""
        return (1 - F.col(x)) * (1 - F.col(y)) >= least * (1 - F.col(x) * F.col(y)) - 1e-9

    mixed = written(labelled(buckets.select("band", "bucket", "rep"), roots), "mixed")
    open_ids = mixed.select(F.col("rep").alias("id")).distinct()
    lonely = (sets.join(open_ids, "id", "left_semi")
              .select("id", F.explode(F.arrays_zip("items", "counts")).alias("s"))
              .groupBy("s.items").agg(F.min("id").alias("id"), F.max("id").alias("last"),
                                      F.sum("s.counts").alias("n"))
              .where("id = last").groupBy("id").agg(F.sum("n").alias("own")))
    sizes = sets.select("id", F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x).alias("size"))
    bound = (open_ids.join(sizes, "id").join(lonely, "id", "left")
             .select(F.col("id").alias("rep"), "size", F.coalesce("own", F.lit(0)).alias("own"))
             .where(F.col("own") <= (1 - least) * F.col("size") + 1e-9))
    able = written(mixed.drop("root").join(bound, "rep").withColumn("share", F.col("own") / F.col("size")),
                   "open")
    # documents with a chain of shared buckets make a group; its HUBS members
    # with the smallest shares are compared with all others, once for all buckets
    chained = written(able.groupBy("band", "bucket").agg(F.min("rep").alias("hub"))
                      .join(able, ["band", "bucket"])
                      .select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct(), "chains")
    groups = components(chained).select(F.col("node").alias("rep"), F.col("root").alias("group"))
    member = written(able.select("rep", "share").distinct().join(groups, "rep")
                     .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
                     .select("rep", "share", "group", F.coalesce("root", "rep").alias("root")), "members")
    first = Window.partitionBy("group").orderBy("share", "rep")
    hubs = (member.withColumn("place", F.row_number().over(first)).where(F.col("place") <= HUBS)
            .select("group", F.col("rep").alias("hub"), F.col("share").alias("hub_share"),
                    F.col("root").alias("hub_root")))
    tried = (member.join(hubs, "group")
             .where((F.col("root") != F.col("hub_root")) & reaches("share", "hub_share"))
             .select(F.greatest("rep", "hub").alias("a"), F.least("rep", "hub").alias("b")).distinct())
    tried = written(tried.join(pairs, ["a", "b"], "left_anti"), "tried")
    links2 = written(verified(tried, sets, least), "verified")
    roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links2))

    # 4. what the bound still allows across components
    # strays, those outside their group's largest component, meet the blocks
    # of their group; a block pair gives only what its shared weights allow
    rest = written(labelled(able, roots).select("rep", "share", "root").distinct().join(groups, "rep"), "rest")
    sizes = rest.groupBy("group", "root").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("group").agg(F.max(F.struct("n", "root")).alias("m")).select(
        "group", F.col("m.root").alias("main"))
    stocked = written(rest.join(main, "group").join(sets.withColumnRenamed("id", "rep"), "rep")
                      .withColumn("stray", F.col("root") != F.col("main")).drop("main"), "stocked")
    blocks = (stocked.groupBy("group", "stray")
              .agg(F.ceil(F.sum(F.size("items")) / BLOCK).cast("int").alias("n_blocks")))
    packed = written(
        stocked.join(blocks, ["group", "stray"])
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("n_blocks")).cast("int"))
        .groupBy("group", "stray", "block")
        .agg(F.collect_list(F.struct("rep", "root", "items", "counts")).alias("docs")), "blocks")
    other = blocks.select("group", F.col("stray").alias("other"),
                          F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("place"))
    met = (packed.where("stray").select("group", F.col("block").alias("own"), F.col("docs").alias("left"))
           .join(other, "group").where("NOT other OR place >= own")
           .join(packed.select("group", F.col("stray").alias("other"), F.col("block").alias("place"),
                               F.col("docs").alias("right")), ["group", "other", "place"]))
    last = (met.select("left", "right").mapInArrow(lambda x: allowed(x, least), "a long, b long").distinct()
            .join(pairs, ["a", "b"], "left_anti").join(tried, ["a", "b"], "left_anti"))
    links3 = written(verified(last, sets, least), "verified")
    roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links3))

    classes = (reps.select("digest", "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
               .select("digest", F.col("rep").alias("copy_of"), F.coalesce("root", "rep").alias("class_id")))
    return one.join(classes, "digest").select(F.col("id").alias(id_col), "class_id", "copy_of")


def op4_near_copies(spark, sf_dir):
    return near_copies(read(spark, sf_dir, "documents").select("doc_id", "text"))
