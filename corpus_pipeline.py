"""Corpus pipeline: language ID, line dedup, near-copy removal, benchmark
decontamination, encoding.

Every stage takes (spark, docs, sf_dir) and works on all rows the stage
before kept.  All but the last return the columns of ``documents``; the last
adds ``token_ids``, ``n_tokens`` and ``round_trip``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read, written
from tidemark.llm.decontam import contaminated
from tidemark.llm.langid import UNKNOWN, identify, learned
from tidemark.llm.lines import line_dedup
from tidemark.llm.nearcopy import near_copies
from tidemark.llm.pieces import encode

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

# A hit on fewer words of an item than this may be chance; it drops nothing.
LEAST_WINDOW = 8


def _own(docs: DataFrame) -> DataFrame:
    """The columns of ``documents``, with the length of the text as it is."""
    return docs.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long")).select(*COLUMNS)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts that are in no learned language: NULL, or without a letter.
    The label becomes the predicted language where there is none."""
    named = identify(docs, learned(docs)).where(F.col("lang_pred") != UNKNOWN)
    return named.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that an earlier document holds.  A document that nothing is
    left of stays, empty; the next stage keeps one of these."""
    return _own(line_dedup(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the least id of every class of near copies; rows that repeat an
    id stay or go together."""
    classes = near_copies(docs).where("class_id <> doc_id").select("doc_id")
    return docs.join(classes, "doc_id", "left_anti").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item of LEAST_WINDOW words or more."""
    found = (contaminated(docs, read(spark, sf_dir, "benchmark")).where(F.col("n_window") >= LEAST_WINDOW)
             .select("doc_id").distinct())
    return docs.join(found, "doc_id", "left_anti").select(*COLUMNS)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    return encode(docs.select(*COLUMNS))


STAGES = [
    ("language_id", keep_languages),
    ("line_dedup", drop_lines),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("encoding", encode_texts),
]

# Language ID, near copies and encoding have no SQL; the tests hold the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
