"""From raw documents to training windows: five stages, each of them one operator of fieldloom.llm.

Every stage but the last returns the columns of its input. A stage reads what its predecessor kept as a
table, so `run` writes each stage to the shared scratch folder before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm.common import Scratch
from fieldloom.llm.jaccard_join import keep_one
from fieldloom.llm.line_dedup import keep_first
from fieldloom.llm.mixing import sample
from fieldloom.llm.packing import pack
from fieldloom.llm.quality import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed quality rules keep."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; n_chars follows; documents that lost every line go."""
    left = keep_first(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else left


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group linked by n-gram Jaccard similarity of 0.8 or more."""
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that source, language and topic meet their target shares of tokens."""
    return sample(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of at most 2048 tokens, one row per piece."""
    return pack(docs)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("near duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]

#: The stages train, hash and tokenise; SQL cannot express them. tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole documents table: one row per piece of a training window.

    Nulls, empty and very long texts, ties, repeated rows and columns of any name are treated as the
    operators' docstrings say: null and empty texts fail the quality rules, and of rows of one doc_id all go
    or stay together in near duplicates. An empty table gives no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.keep(docs, f"stage-{k}")
    return docs
