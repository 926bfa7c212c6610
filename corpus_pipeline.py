"""From raw documents to token ids: good texts, one per group of near copies, no benchmark
passages, no personal data, encoded.

Every stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes each stage's result
as Parquet and reads it back as the next one's documents, so that a lost executor repeats tasks
of one stage at most. A null text counts as an empty one in every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm import bpe, decontaminate, pii, quality, simhash
from tillmark.session import work_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. It learns from the labels."""
    return quality.good_only(docs, docs, _table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id."""
    return simhash.one_per_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages."""
    return decontaminate.clean_only(docs, _table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the new text."""
    cleaned = pii.redacted(docs, pii.trained(pii.training_texts(docs)))
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document."""
    coded = bpe.encoded(docs.select("doc_id", "lang", "source", "text"))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_texts),
    ("near_duplicates", without_copies),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("encoding", token_ids),
]

# SQL can express none of the learned stages, nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last one."""
    docs, folder = _table(spark, sf_dir, "documents"), work_folder(spark, "corpus")
    for place, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{place}-{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
