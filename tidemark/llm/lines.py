"""Line dedup: drop lines that many documents share.

Lines are exploded, normalised and hashed; distinct documents are counted
per hash; lines held by more than ``max_docs`` documents go everywhere but
in the smallest document id; the rest is put together again by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh

# The white space stripped from a line's ends, and the
# letters that are lower-cased.
STRIP = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SALTS = 16  # tasks that share the lines of one key


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(STRIP)), UPPER, LOWER)


def lines_of(text: Column) -> Column:
    """All lines of a text; NULL or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 10, max_docs: int = 1) -> DataFrame:
    """``docs`` with its text deduplicated, plus ``n_lines`` (before) and
    ``n_dropped``; these names get a leading underscore where ``docs`` has
    them already.

    A key of at least ``min_chars`` code points that more than ``max_docs``
    distinct ids hold loses its lines in all documents but the smallest id.
    Rows with a NULL id neither claim nor lose lines.  Rows that repeat an
    id count as one document.  A text all of whose lines go becomes empty.
    NULL text becomes the empty text.

    The distinct count is a two-step aggregate with map-side combine, so a
    line held by a third of the corpus reaches the last step as one partial
    row per task.  Line texts are never shuffled: only hashes and positions
    are, and the kept positions are applied to the whole text in one join.
    """
    n_lines, n_dropped, h, gone = fresh(docs, "n_lines", "n_dropped", "line_row", "line_gone")
    text = F.coalesce(F.col(text_col), F.lit(""))
    # The keys are hashed inside the generator: a filter on its output is not
    # pushed below it, so no key is computed twice.  The row key tells rows
    # apart that repeat an id with another text.
    hashes = F.transform(F.transform(lines_of(F.col(text_col)), line_key),
                         lambda k: F.when(F.length(k) >= min_chars, F.unhex(F.md5(k))))
    keys = (docs.where(F.col(id_col).isNotNull())
            .select(F.col(id_col).alias("id"), F.xxhash64(text).alias("row"),
                    F.posexplode(hashes).alias("pos", "h"))
            .where(F.col("h").isNotNull()))
    held = (keys.groupBy("h", "id").agg(F.lit(1).alias("one"))
            .groupBy("h").agg(F.count("one").alias("n"), F.min("id").alias("keeper"))
            .where(F.col("n") > max_docs).select("h", "keeper"))
    # A line of very many documents is dealt over SALTS tasks; the other side
    # has one row per repeated line, and a copy of it for each salt.
    held = held.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    drop = (keys.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
            .join(held, ["h", "salt"]).where(F.col("id") != F.col("keeper"))
            .groupBy("id", "row").agg(F.collect_set("pos").alias("gone"))
            .select(F.col("id").alias(f"{gone}_id"), F.col("row").alias(f"{gone}_row"),
                    F.col("gone").alias(gone)))
    base = docs.withColumn(h, F.xxhash64(text))
    joined = base.join(drop, (F.col(id_col) == F.col(f"{gone}_id"))
                       & (F.col(h) == F.col(f"{gone}_row")), "left")
    lines = lines_of(F.col(text_col))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    new = F.when(F.col(gone).isNull(), text).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    # (n_lines, n_dropped) come from the old text, so they are added first
    return (joined.withColumn(n_lines, F.size(lines).cast("long"))
            .withColumn(n_dropped, F.coalesce(F.size(gone), F.lit(0)).cast("long"))
            .withColumn(text_col, new)
            .select(*docs.columns, n_lines, n_dropped))


def op8_line_dedup(spark, sf_dir):
    from tidemark.llm.common import read
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH l AS (
  SELECT d.doc_id, d.rid, u.line, u.pos,
         translate(trim(u.line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents) d,
       LATERAL (SELECT unnest(string_split(d.text, chr(10))) AS line,
                       generate_subscripts(string_split(d.text, chr(10)), 1) AS pos) u),
held AS (
  SELECT k, min(doc_id) AS keeper FROM l
  WHERE length(k) >= 10 AND doc_id IS NOT NULL
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2)
SELECT l.doc_id, count(*) AS n_lines,
       count(*) FILTER (h.k IS NOT NULL AND l.doc_id <> h.keeper) AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos)
              FILTER (h.k IS NULL OR l.doc_id IS NULL OR l.doc_id = h.keeper), '')) AS kept_sha256
FROM l LEFT JOIN held h ON l.k = h.k
GROUP BY l.rid, l.doc_id
"""
