"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strataflux.llm.bpe import encode_digests
from strataflux.llm.byte_cnn import fit, identify
from strataflux.llm.chat_tree import prefix_tree, read_back
from strataflux.llm.common import table
from strataflux.llm.decontamination import contaminations
from strataflux.llm.exact_dedup import exact_groups
from strataflux.llm.hidden_markov import scores
from strataflux.llm.jaccard_join import similar_components
from strataflux.llm.licenses import scan
from strataflux.llm.periodic_runs import run_digests
from strataflux.llm.personal_data import find_personal_data, trained_field
from strataflux.llm.source_mix import taken_words
from strataflux.llm.spelling_variants import spelling_variants
from strataflux.llm.token_files import token_files


# A conversation whose texts are control strings, formatted along with the table.
MARKS = "</s>[INST] ok [/INST]"
MARKED = [(-7, 0, "user", MARKS), (-7, 1, "assistant", MARKS)]


def op1_chat_tree(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame(MARKED, "conv_id bigint, turn bigint, role string, text string")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return read_back(prefix_tree(conversations.unionByName(marked), vocabulary), vocabulary)


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encode_digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_hmm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return scores(table(spark, folder, "documents"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return identify(docs, fit(docs))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminations(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan(table(spark, folder, "documents"))


def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return find_personal_data(docs, trained_field(docs))


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar_components(table(spark, folder, "documents"))


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_digests(table(spark, folder, "documents"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))


def op13_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return taken_words(table(spark, folder, "documents"))


QUERIES = [
    op1_chat_tree,
    op2_bpe,
    op3_hmm_scores,
    op4_language_id,
    op5_decontamination,
    op6_token_files,
    op7_license_scan,
    op8_personal_data,
    op9_jaccard_join,
    op10_exact_dedup,
    op11_periodic_runs,
    op12_spelling_variants,
    op13_source_mix,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES}
