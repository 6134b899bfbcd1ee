"""A corpus made ready for training: five stages, each on what the one before kept.

Quality rules drop documents; of each group of near copies (five-word shingles,
Jaccard 0.8 or more) the one with the smallest id stays; contaminated documents
go; personal data is masked in the text; the rest is packed into windows of
token ids. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayer.llm.decontaminate import clean_documents
from lakelayer.llm.jaccard import one_per_group
from lakelayer.llm.packing import pack_documents
from lakelayer.llm.pii import masked
from lakelayer.llm.quality_rules import kept_documents
from lakelayer.llm.tokens import public_path
from lakelayer.session import work_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_per_group(docs, words=5, num=4, den=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a large share of benchmark words."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked; n_chars follows the text."""
    return masked(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids and their places in windows of 2048."""
    placed = pack_documents(docs, public_path("word_bpe_49k.json"))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Token ids are beyond SQL; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
