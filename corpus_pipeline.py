"""A training corpus from raw documents, in five stages.

Every stage takes the documents that the one before kept and returns documents; the last returns
the mix, a row for each time that a document is taken.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderlake.llm import decontaminate, language, mixing, near_dedup, pii
from larderlake.llm.tables import keep, ship

#: Percent of common five-word shingles from which two documents are near copies.
NEAR = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that labelled documents teach; those that the models reject go.

    Without any labelled document there is no language to know, and all documents stay.
    """
    model = language.learn(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    return language.keep_known(docs, model) if model.languages else docs


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of each group of near copies."""
    return near_dedup.drop_near_copies(docs, NEAR)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to target weights; ``copy`` numbers the times that a document is taken."""
    return mixing.take(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("near_dedup", without_near_copies),
    ("decontaminate", without_benchmark),
    ("pii", without_personal_data),
    ("mix", mixed),
]

#: Language models and balanced sampling have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written before the next."""
    docs = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
