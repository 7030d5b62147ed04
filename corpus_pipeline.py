"""A corpus from documents: known language, no copies, no near copies, no benchmark items, as tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes every stage's rows below
the shared folder and gives them to the next one. All stages but the last return the columns of
``documents``. Documents without a text, or with one that has no letter, have no language and go;
the near-duplicate stage links five-word shingle sets of a similarity of 0.8 or more.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strataflux.llm import bpe, byte_cnn, decontamination, exact_dedup, jaccard_join
from strataflux.llm.common import staged, table, workers_find_package

# How far above equal chances for all learned languages the probability of a document's must lie.
LEAST_MARGIN = 0.05
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the byte network recognises."""
    workers_find_package(spark)
    return byte_cnn.identified(docs, byte_cnn.fit(docs), LEAST_MARGIN)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one that stays."""
    return exact_dedup.without_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    workers_find_package(spark)
    return jaccard_join.one_of_each(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and the text decoded from them."""
    workers_find_package(spark)
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("near_copies", without_near_copies),
    ("decontamination", without_benchmark),
    ("bpe", encoded),
]

# A trained network decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
