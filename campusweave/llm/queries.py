"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campusweave.llm import ann, brown_lm, decontam, fim, main_text, near_dedup, quality, secrets, sentencepiece, sharding, substring_dedup, toxicity, vector_codes
from campusweave.llm.common import table

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op9_near_dedup"] = near_dedup.ORACLE


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = toxicity.held_out(3, 1)
    grammar = toxicity.learn(docs.where(~held), labels.where(~held))
    return toxicity.scored(docs, grammar).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shards(table(spark, sf_dir, "documents"), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "linked")


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated(table(spark, sf_dir, "documents"))


@query
def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


@query
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encoded(table(spark, sf_dir, "documents"))


@query
def op2_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = toxicity.held_out(7, 2)
    return brown_lm.learnt_and_scored(docs, ~held).withColumn("held_out", held)


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.sampled(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extracted(table(spark, sf_dir, "pages"))


ORACLES["op11_main_text"] = main_text.ORACLE


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encoded(table(spark, sf_dir, "embeddings"))


ORACLES["op12_vector_codes"] = vector_codes.oracle()


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


ORACLES["op13_fill_in_middle"] = fim.ORACLE
