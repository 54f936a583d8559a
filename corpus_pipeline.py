"""A corpus pipeline: language, near copies, personal data, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. Between stages the table is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plateworks.llm import langid, mixing, near_dup, packing, pii
from plateworks.llm.common import materialize


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known.

    Rows are judged one by one: of rows that share an id, or have none, each stays or goes by
    its own text; equal rows share their fate. Null and empty texts are in no known language and go.
    """
    row = F.xxhash64(*(docs[c].cast("string") for c in ("doc_id", "text", "lang", "source")))
    # Written first, so that its size is known: a small table is broadcast and the texts are not shuffled.
    rejected = langid.identify_documents(docs, key=row).where("not accepted").select(F.col("key").alias("_rejected")).distinct()
    rejected = materialize(rejected, "pipeline-rejected")
    return docs.join(rejected, row == rejected["_rejected"], "left_anti")


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id.

    Null and blank texts, and rows without id, are in no group and stay; rows that repeat a kept id all stay.
    """
    return near_dup.keep_first(docs)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; n_chars follows the text.

    Null texts stay null, with null n_chars; every row stays, repeated ones alike; other columns are as they were.
    """
    done = pii.replace(docs).select(*docs.columns)
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else done


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights.

    Null and unnamed sources and languages are one more category, null texts weigh one token,
    rows that repeat an id share their fate, rows without id are drawn by their text.
    """
    return mixing.sample(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences.

    Null texts are packed as the end id alone, rows that repeat an id as often as they come, rows without id with a null id.
    """
    return packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_copy_stage),
    ("pii_surrogates", personal_data_stage),
    ("mixing", mixture_stage),
    ("packing", packing_stage),
]

#: SQL cannot express sketches, surrogates or token ids; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
