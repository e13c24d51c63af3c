"""A corpus pipeline of five stages: quality rules, exact dedup, near dedup, substring dedup, packing.

A stage's operator deletes its own scratch tables, but for those that the stage's result reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, jaccard_join, packing, quality_rules, substring_dedup
from tidemark.llm.common import SMALL_BATCH_BYTES, free_names, materialize, small_side, table

#: No SQL can express the divergence verdict, the packing or the tokens.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; null text counts as empty and goes.

    Rows whose identifier is null or stands for different verdicts are numbered, written with their
    numbers, and judged one by one.
    """
    judged = materialize(quality_rules.quality_rules(docs), "pipeline-quality", SMALL_BATCH_BYTES)
    twice = judged.groupBy("id").agg(F.min("kept").alias("lo"), F.max("kept").alias("hi")).where("lo <> hi OR id IS NULL")
    if not twice.isEmpty():
        (number,) = free_names(docs, "row_number")
        docs = materialize(docs.withColumn(number, F.monotonically_increasing_id()), "pipeline-numbered")
        judged = materialize(quality_rules.quality_rules(docs, id_col=number), "pipeline-quality", SMALL_BATCH_BYTES)
        return docs.join(small_side(judged.where("NOT kept").select(F.col("id").alias(number))), number, "left_anti").drop(number)
    return docs.join(small_side(judged.where("NOT kept").select(F.col("id").alias("doc_id"))), "doc_id", "left_anti").select(docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays; null counts as empty, and repeated identifiers are told apart by their text."""
    return exact_dedup.keep_first(docs).select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest identifier stays.

    Rows without identifier or words stay; rows that share an identifier are one document, and all stay or go.
    """
    found = jaccard_join.near_duplicates(docs, jaccard_join.JaccardParams(k=5, num=4, den=5))
    gone = materialize(found.where("id <> component_id").select(F.col("id").alias("doc_id")).distinct(), "pipeline-near")
    return docs.join(small_side(gone), "doc_id", "left_anti").select(docs.columns)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a document with a smaller identifier has are cut out; n_chars follows the text."""
    out = substring_dedup.remove_repeats(docs, substring_dedup.SubstringParams(k=50))
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row is packed, null text as empty, repeated rows each."""
    return packing.pack(docs, capacity=2048, end_id=0)


STAGES = [("quality rules", quality), ("exact dedup", exact), ("n-gram jaccard join", near), ("substring dedup", substrings), ("best-fit packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{k}")
    return docs
