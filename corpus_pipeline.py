"""The corpus pipeline: stages over `documents`, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from campusweave.llm import decontam, near_dedup, quality, secrets, sentencepiece
from campusweave.llm.common import cut, table

#: The encoding, the near-duplicate and the Hamming stages have no SQL form.
ORACLE_SQL = None


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.first_of_each(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced."""
    return secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document."""
    return sentencepiece.encoded(docs)


STAGES = [("quality", good), ("near_dedup", distinct), ("decontamination", unseen), ("secrets", redacted), ("encoding", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, over all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
