"""Fill-in-the-middle transformation by one counted regular expression.

``regexp_count`` gives the number n of units of a text; two cuts between units
are drawn from a hash of the id.  The row's own pattern has two possessive
counted groups, ``unit{a}`` and ``unit{b-a}``, and takes the rest as third:
one match captures prefix, middle and suffix, and the replacement puts them in
the order of the form.  All of it are Spark's functions on one row; nothing is
shuffled.  (Possessive counts are matched in a loop, so long texts need no
stack.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, read

# A unit (a word with the white space before it, or white space
# at the end of a text), the markers, and the shares in percent.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FIM_SHARE = 50
SPM_SHARE = 80
SEED = 42

PLAIN, PSM, SPM = "plain", "psm", "spm"
_ORDER = {PSM: f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", SPM: f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"}


def draws(key: Column, seed: int = SEED, count: int = 4) -> list[Column]:
    """The first ``count`` 32-bit numbers of sha256("seed:key"), as longs."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(count)]


def restored(output: Column, form: Column) -> Column:
    """The text from an output and its form: every marker stands in it once."""
    p, s, m = (F.instr(output, x) for x in (PREFIX, SUFFIX, MIDDLE))
    end = F.length(output) + 1
    return (F.when(form == PSM, F.concat(F.substr(output, p + 3, s - p - 3), F.substr(output, m + 3, end - m - 3),
                                         F.substr(output, s + 3, m - s - 3)))
            .when(form == SPM, F.concat(F.substr(output, p + 3, m - p - 3), F.substr(output, m + 3, end - m - 3),
                                        F.substr(output, s + 3, p - s - 3)))
            .otherwise(output))


def infill(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fim_share: int = FIM_SHARE,
           spm_share: int = SPM_SHARE, seed: int = SEED) -> DataFrame:
    """``docs`` with ``n`` (units of the whole text), ``form`` (``plain``,
    ``psm`` or ``spm``), ``output`` (the text in that form) and
    ``prefix_chars`` and ``middle_chars`` (code points, NULL where plain).
    Columns of ``docs`` that have one of these names keep it; the new one gets
    a leading underscore.

    The prefix ends after the smaller and the middle after the larger of two
    numbers of units drawn from 0 to n.  A text is plain if it is empty or
    NULL (then ``output`` is empty), holds one of the markers, or is not among
    the ``fim_share`` percent drawn; of the others ``spm_share`` percent are
    ``spm``.  A NULL id is drawn like the empty string; rows that repeat an id
    have the same draws.  An empty table gives no rows.
    """
    n, form, output, pre, mid = fresh(docs, "n", "form", "output", "prefix_chars", "middle_chars")
    text_, n_, a_, b_, f3, f4 = fresh(docs.withColumns({c: F.lit(None) for c in (n, form, output, pre, mid)}),
                                      "text_of", "n_of", "cut_a", "cut_b", "draw_form", "draw_order")
    h = draws(F.col(id_col), seed)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = (docs.withColumns({text_: text, n_: F.regexp_count(text, F.lit(UNIT)).cast("long")})
            .withColumns({a_: h[0] % (F.col(n_) + 1), b_: h[1] % (F.col(n_) + 1), f3: h[2] % 100, f4: h[3] % 100}))
    marked = F.lit(False)
    for m in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(F.col(text_), F.lit(m))
    lo, hi = F.least(a_, b_), F.greatest(a_, b_)
    pattern = F.concat(F.lit(rf"(?s)\A((?:{UNIT}){{"), lo, F.lit(rf"}}+)((?:{UNIT}){{"), hi - lo, F.lit(r"}+)(.*)\z"))
    shape = (F.when((F.col(text_) == "") | marked | (F.col(f3) >= fim_share), PLAIN)
             .when(F.col(f4) < spm_share, SPM).otherwise(PSM))
    out = F.col(output)
    p, s, m = (F.instr(out, x) for x in (PREFIX, SUFFIX, MIDDLE))
    return (rows.withColumn(form, shape)
            .withColumn(output, F.when(F.col(form) == PLAIN, F.col(text_)).otherwise(F.regexp_replace(
                F.col(text_), pattern, F.when(F.col(form) == PSM, _ORDER[PSM]).otherwise(_ORDER[SPM]))))
            .withColumn(pre, F.when(F.col(form) == PSM, s - p - 3).when(F.col(form) == SPM, m - p - 3).cast("long"))
            .withColumn(mid, F.when(F.col(form) != PLAIN, F.length(out) - m - 2).cast("long"))
            .withColumn(n, F.col(n_)).select(*docs.columns, n, form, output, pre, mid))


def op12_infill(spark, sf_dir):
    out = infill(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP12_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
d AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
s AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
         array_to_string(u[b + 1:], '') AS s FROM c)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM s
"""
