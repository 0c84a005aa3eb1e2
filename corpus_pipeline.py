"""The corpus pipeline: toxic documents and near-duplicates go, leaked benchmark items go, sources are mixed, tokens are written.

Every stage works on all rows that its predecessor kept; its rows are written as Parquet and read again by the next.
All but the last return the columns of ``documents``. Mixing repeats a row for every copy that it takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, mixing, neardup, tokens, toxicity
from tidemark.llm.common import ready, table
from tidemark.llm.files import new_folder
from tidemark.llm.queries import TOKENIZER
from tidemark.session import stage_folders


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7 by a model fitted on the labels."""
    ready(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ready(spark)
    return neardup.without_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The records of the token files, read back."""
    ready(spark)
    return tokens.token_records(docs, TOKENIZER)


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_files", token_files),
]
#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage wrote for itself is removed when its rows are written."""
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for name, stage in STAGES:
        with stage_folders():
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
