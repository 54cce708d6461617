"""Phrase collocation mining with Rabin-Karp fingerprints.

Every task hashes all n-grams of its texts with prefix polynomials in numpy
and counts them a chunk of text at a time, comparing occurrences that share a
fingerprint word by word.  What is shuffled is one row per n-gram of a chunk:
its fingerprint, its count there and a pointer to one occurrence.  N-grams
that are too rare in total go; the pointers of the others are looked up in
the texts, where each phrase must have its fingerprint again, and only these
phrases are ever built.

Across chunks, phrases that share the 64-bit fingerprint are told apart by 32
bits of a second one that knows nothing of the first; each is then looked up
in the text on its own.  Two phrases could only pass for one if both agree,
which for a million million different n-grams has a probability of 10^-5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import bitset
from tidemark.llm.bytewords import STEP, Rows, byte_set, chunks, groups, hashed, ngrams, same_bytes, words
from tidemark.llm.common import freed, importable, read, written
from tidemark.llm.wordhash import mix

# What separates words, what separates pieces, and the language
# of texts without one.
BLANKS = b" \t"
CUTS = b".,;:!?\n\x0b\x0c\r"
NO_LANG = "und"

LEAST = 10        # occurrences of a phrase at least
MAX_WORDS = 3
COVER = 50        # percent of a phrase's occurrences inside a longer one
TOP = 2000        # phrases returned of each language
SCALE = 1_000_000
CHUNK = 14 << 20  # bytes of text whose n-grams are counted together
BUCKETS = 16      # tasks that share the first ranking of one language

_APART, _CUT = byte_set(BLANKS + CUTS), byte_set(CUTS)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


class _Hashed:
    """Words of a chunk and the fingerprints of their n-grams, by language."""

    def __init__(self, rows: Rows, lang_hash: pa.Array):
        self.buf = _LOWER[rows.buf]
        self.starts, self.ends, first = words(self.buf, _APART)
        self.hashes = first, hashed(self.buf, self.starts, self.ends, 1)
        self.row = rows.row_of(self.starts).astype(np.int32)
        self.seeds = mix(lang_hash.to_numpy().view(np.uint64))

    def __len__(self) -> int:
        return len(self.starts)

    def ngrams(self, n: int, which: int = 0) -> np.ndarray:
        """Fingerprints of the n words from each place on; of 0 words, of the
        language alone."""
        out = ngrams(self.hashes[which], n, which) if n else np.zeros(len(self), dtype=np.uint64)
        for lo in range(0, len(out), STEP):  # by parts, to need no further array of this length
            part = slice(lo, min(lo + STEP, len(out)))
            out[part] = mix(out[part] ^ self.seeds[self.row[part]])
        return out


def _tally(rows: Rows, sizes: tuple[int, ...], known: np.ndarray | None, mask: int) -> Iterator[pa.RecordBatch]:
    """One row per distinct n-gram of the chunk: fingerprint ``fp``; ``spot``,
    32 bits of the second fingerprint and the place in the text of ``key``;
    ``times``, its count and words.  Size 0 stands for all words of a
    language."""
    lang, lang_hash, key = rows.columns
    h, mask = _Hashed(rows, lang_hash), np.uint64(mask)
    if not len(h):
        return
    pieces = np.searchsorted(np.flatnonzero(_CUT[h.buf]), h.starts).astype(np.int32)
    langs = pc.dictionary_encode(lang).indices.to_numpy().astype(np.int32)[h.row]
    word = groups(h.hashes[0] & mask, lambda a, b: same_bytes(h.buf, h.starts, h.ends, a, b))
    for n in sizes:
        if n == 0:
            _, at, count = np.unique(langs, return_index=True, return_counts=True)
            fp = h.ngrams(0)[at] & mask
        else:
            places = (np.flatnonzero(pieces[:len(pieces) - n + 1] == pieces[n - 1:]).astype(np.int32)
                      if len(pieces) >= n else [])
            if not len(places):
                continue
            if known is not None:  # both its shorter n-grams must be frequent
                held = bitset.found(known, mix(h.ngrams(n - 1) & mask))
                places = places[held[places] & held[places + 1]]
                del held
            fp = h.ngrams(n)[places] & mask

            def same(a, b):
                x, y = places[a], places[b]  # noqa: B023 - used in this round only
                equal = langs[x] == langs[y]
                for i in range(n):  # noqa: B023
                    equal &= word[x + i] == word[y + i]
                return equal
            lead = groups(fp, same)
            count = np.bincount(lead, minlength=len(lead))
            del lead
            first = np.flatnonzero(count)
            at, fp, count = places[first], fp[first], count[first]
            del places, first
        r = h.row[at]
        spot = h.ngrams(n, 1)[at] >> np.uint64(32) << np.uint64(32) | (h.starts[at] - rows.first[r]).astype(np.uint64)
        out = [pa.array(fp.view(np.int64)), pa.array(spot.view(np.int64)), pa.array(count.astype(np.int64) << 8 | n),
               pa.array(key.to_numpy()[r])]
        for lo in range(0, len(at), 1 << 16):
            yield pa.RecordBatch.from_arrays([c.slice(lo, 1 << 16) for c in out], names=["fp", "spot", "times", "key"])


def _phrases(mask: int):
    """(lang, text, lang_hash, spots) rows -> (lang, words, phrase, f) of the
    spots whose fingerprints the text has there."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(batches, CHUNK, text=1):
            lang, lang_hash, spots = rows.columns
            h = _Hashed(rows, lang_hash)
            row = np.repeat(np.arange(len(rows)), np.diff(spots.offsets.to_numpy()))
            fp, check, size, n, at = (spots.flatten().field(i).to_numpy() for i in range(5))
            place = rows.first[row] + at
            first = np.minimum(np.searchsorted(h.starts, place), len(h) - 1)
            good = (h.starts[first] == place) & (first + size <= len(h))
            for k in np.unique(size):
                of = np.flatnonzero(good & (size == k))
                good[of] = ((h.ngrams(k)[first[of]] & np.uint64(mask)) == fp[of].view(np.uint64)) & (
                    (h.ngrams(k, 1)[first[of]] >> np.uint64(32)).astype(np.uint32) == check[of].view(np.uint32))
            row, size, n, first = row[good], size[good], n[good], first[good]
            last = first + np.maximum(size, 1) - 1
            raw = h.buf.tobytes()
            text = [raw[s:e] if k else b"" for s, e, k in zip(h.starts[first], h.ends[last], size, strict=True)]
            gaps = np.concatenate([[0], np.cumsum((h.starts[1:] - h.ends[:-1] != 1) | (h.buf[h.ends[:-1]] != 32))])
            for i in np.flatnonzero((size > 1) & (gaps[last] != gaps[first])):
                text[i] = b" ".join(text[i].split())  # more than one blank between words
            for lo in range(0, len(text), 1 << 16):
                part = slice(lo, lo + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [lang.take(pa.array(row[part])), pa.array(size[part].astype(np.int32)),
                     pa.array(text[part], pa.binary()), pa.array(n[part])], names=["lang", "words", "phrase", "f"])
    return look


def phrase_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  max_words: int = MAX_WORDS, least: int = LEAST, mask: int = (1 << 64) - 1,
                  bits: int = bitset.BITS) -> DataFrame:
    """(lang, words, phrase, f): every phrase of 1 to ``max_words`` words that
    occurs at least ``least`` times in its language, and for 0 words and the
    empty phrase the number of all words of the language.

    Occurrences are counted within pieces, overlaps included; the words of a
    phrase are joined by one space.  A NULL language is ``und``; NULL and
    empty texts have no words; rows that repeat an id or a whole row count
    like any others.

    ``mask`` shortens the first fingerprint (for tests).  An n-gram of three or
    more words is only shuffled if a Bloom filter of ``2 ** bits`` bits says
    that both n-grams inside it are frequent; where the filter is too full for
    the corpus, more is shuffled and the result is the same.  No key gets more
    rows than there are chunks.
    """
    spark = docs.sparkSession
    importable(spark)
    base = (docs.where(F.length(text_col) > 0)
            .select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col), F.lit(NO_LANG)).alias("lang"),
                    F.xxhash64(id_col, lang_col, text_col).alias("key"))
            .select("text", "lang", F.xxhash64("lang").alias("lang_hash"), "key"))

    def level(sizes: tuple[int, ...], known=None) -> DataFrame:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in chunks(batches, CHUNK):
                yield from _tally(rows, sizes, known.value if known is not None else None, mask)
        # One shuffle of packed rows; they hardly repeat within a task, so
        # nothing is combined before it beyond the chunks.
        rows = (base.mapInArrow(count, "fp long, spot long, times long, key long").repartition("fp")
                .select("fp", F.shiftright("spot", 32).cast("int").alias("check"), "key",
                        F.col("spot").bitwiseAND(0xFFFFFFFF).alias("at"),
                        F.col("times").bitwiseAND(0xFF).cast("int").alias("words"),
                        F.shiftright("times", 8).alias("n")))
        total = rows.groupBy("fp", "check", "words").agg(
            F.sum("n").alias("n"), F.max("key").alias("key"), F.max_by("at", "key").alias("at"))
        return written(total.where((F.col("n") >= least) | (F.col("words") == 0)), "phrase-spots")

    def filter_of(spots: DataFrame, n: int):
        fps = spots.where(F.col("words") == n).select("fp").distinct()
        table = bitset.bloom(fps.mapInArrow(_mixed, "h long"), "h", bits)
        return spark.sparkContext.broadcast(table)

    with freed(spark):
        spots = [level(tuple(range(min(2, max_words) + 1)))]
        for n in range(3, max_words + 1):
            spots.append(level((n,), filter_of(spots[-1], n - 1)))
        found = spots[0]
        for s in spots[1:]:
            found = found.unionByName(s)
        return written(_looked_up(base, found, mask), "phrase-counts")


def _mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scrambled once more, so that short fingerprints also fill all bits."""
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(mix(b.column(0).to_numpy().view(np.uint64)).view(np.int64))], names=["h"])


def _looked_up(base: DataFrame, spots: DataFrame, mask: int) -> DataFrame:
    """The phrases that spots point to.  Rows that repeat a whole row are one
    here; should two rows share a key, a spot is looked up in both."""
    wanted = (spots.select("key", F.struct("fp", "check", "words", "n", "at").alias("s"))
              .groupBy("key").agg(F.collect_list("s").alias("spots")))
    texts = base.groupBy("key").agg(F.collect_set(F.struct("lang", "text", "lang_hash")).alias("d"))
    return (texts.join(wanted, "key").select(F.explode("d").alias("d"), "spots")
            .select("d.lang", "d.text", "d.lang_hash", "spots")
            .mapInArrow(_phrases(mask), "lang string, words int, phrase binary, f long")
            .select("lang", "words", F.col("phrase").cast("string").alias("phrase"), "f"))


def _inside(parts: Column, size: Column, least: int) -> Column:
    """All runs of at least ``least`` words that are shorter than the whole."""
    return F.flatten(F.transform(F.sequence(F.lit(least), size - 1), lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda i: F.array_join(F.slice(parts, i, n), " "))))


def scored(counts: DataFrame, max_words: int = MAX_WORDS, cover: int = COVER, scale: int = SCALE) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer one
    covers, from ``phrase_counts``.

    The score is ``floor(scale * a * a / (l * r))`` of the cut that gives the
    least, the first of those that tie.  It is exact for counts below 10^16:
    products are decimals of 38 digits.
    """
    split = F.split("phrase", " ")
    cand = counts.where("words >= 2").select("lang", "words", "phrase", F.col("f").alias("a"))
    sides = F.flatten(F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.array(
        F.struct(F.array_join(F.slice(split, F.lit(1), k), " ").alias("part"), k.alias("k"), F.lit(0).alias("side")),
        F.struct(F.array_join(F.slice(split, k + 1, F.col("words") - k), " ").alias("part"), k.alias("k"),
                 F.lit(1).alias("side")))))
    known = counts.where("words >= 1").select("lang", F.col("phrase").alias("part"), "f")
    # A common word is a part of very many candidates: their side is the one
    # that AQE splits, the other has one row per phrase.
    cuts = cand.select("lang", "phrase", "a", F.explode(sides).alias("c")).select("lang", "phrase", "a", "c.*")
    both = (cuts.join(known, ["lang", "part"]).groupBy("lang", "phrase", "a")
            .agg(*[F.max(F.when((F.col("k") == k) & (F.col("side") == s), F.col("f"))).alias(f"{name}{k}")
                   for k in range(1, max_words) for s, name in enumerate("lr")]))
    exact = "cast({} as decimal(16,0))"
    options = [F.struct(F.expr(f"cast({scale} as decimal(7,0)) * ({exact.format('a')} * {exact.format('a')}) div "
                               f"({exact.format(f'l{k}')} * {exact.format(f'r{k}')})").cast("long").alias("score"),
                        F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
               for k in range(1, max_words)]
    options = [F.when(F.col(f"l{k + 1}").isNotNull(), o) for k, o in enumerate(options)]
    best = F.least(*options) if len(options) > 1 else options[0]
    inner = (cand.where("words >= 3")
             .select("lang", F.col("a").alias("over"), F.explode(_inside(split, F.col("words"), 2)).alias("phrase"))
             .groupBy("lang", "phrase").agg(F.max("over").alias("over")))
    return (both.select("lang", "phrase", "a", best.alias("b")).join(inner, ["lang", "phrase"], "left")
            .where(F.expr(f"over IS NULL OR 100 * over < {int(cover)} * a"))
            .select("lang", "phrase", "a", "b.l", "b.r", "b.score"))


def collocations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 max_words: int = MAX_WORDS, least: int = LEAST, cover: int = COVER, top: int = TOP,
                 mask: int = (1 << 64) - 1) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` collocations of
    every language by score, then count, then phrase in byte order.

    See ``phrase_counts`` for NULLs, empty texts and repeated rows and
    ``scored`` for the arithmetic.  Other columns are not looked at; an empty
    table gives no rows.  Each language is ranked in BUCKETS parts first, so
    the last task gets at most ``top`` rows of each.
    """
    if max_words < 2:
        raise ValueError("a collocation has two words at least")
    counts = phrase_counts(docs, id_col, text_col, lang_col, max_words, least, mask)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS))
    ranked = (scored(counts, max_words, cover).withColumn("part", part)
              .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
              .where(F.col("rank") <= top)
              .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
              .where(F.col("rank") <= top))
    total = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l",
                                             "r", "n", "score")


def op11_collocations(spark, sf_dir):
    return collocations(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


OP11_SQL = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')),
                                      '[^\x20\x09]+') AS w FROM t),
g AS (
  SELECT lang, k, array_to_string(w[i + 1 : i + k], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(len(w) - k + 1)) AS i
        FROM p, (VALUES (1), (2), (3)) x(k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, phrase, k AS size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 10),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
s AS (
  SELECT c.lang, c.phrase, c.a, c.k, u.f AS l, v.f AS r,
         (1000000::HUGEINT * c.a * c.a // (u.f::HUGEINT * v.f))::BIGINT AS score
  FROM cuts c JOIN f u ON u.lang = c.lang AND u.phrase = c.x JOIN f v ON v.lang = c.lang AND v.phrase = c.y),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM c WHERE size = 3)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a, l, r, n, score
FROM b JOIN n USING (lang)
WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.lang = b.lang AND o.phrase = b.phrase AND 100 * o.a >= 50 * b.a)
QUALIFY row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
