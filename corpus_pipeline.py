"""Corpus pipeline: five stages over ``documents``, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns the rows that the next
one works on; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakefold.llm import decontam, mixing, near_dup, pii, toxicity
from lakefold.llm.common import stored, table
from lakefold.llm.queries import MIX_WEIGHTS


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go.  Learnt from the labelled documents
    among those that the stage gets.  Null and empty texts score by the bias
    alone and stay; repeated rows stay or go together; no rows give none."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the smallest id.
    Texts without words and rows without id are no copies; of rows that repeat
    an id and its text one stays."""
    return near_dup.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a ten-word window of a benchmark item go.  Null and
    empty texts hold none; null and empty items have none."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked by its kind; ``n_chars`` follows the text.
    Null texts stay null, all rows stay."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights: one row a copy taken.  A null
    source is a source; texts without words are not taken."""
    return mixing.mix(docs, MIX_WEIGHTS)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", deduplicate),
    ("decontamination", decontaminate),
    ("pii", redact),
    ("mixing", mix),
]

# A trained classifier and a trained tagger decide what stays and what it
# reads: SQL cannot express them.  tests/llm holds every stage against a plain
# version (near_dedup: all pairs; toxicity: a plain forward pass of its model).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other; each one's rows are written to the
    shared folder and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
