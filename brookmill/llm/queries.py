"""Each operator of this subpackage as a query over a folder of tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmill.llm import byte_tokens, centroids, chat, decontaminate, jaccard_join, language, quality, simhash, substring_dedup, suffix_dedup, toxicity, whitening
from brookmill.llm.common import remainder, table
from brookmill.llm.pieces import encoding_digests
from brookmill.session import materialise

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def held_out(modulus: int, fold: int) -> Column:
    """Is a row kept from learning? A null id has no fold: it is held out."""
    return F.coalesce(remainder("doc_id", modulus) == fold, F.lit(True))


def op1_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    languages = language.learn(docs.where(~held_out(3, 1)))
    return language.identify(docs, languages, keep={"held_out": held_out(3, 1)})


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs, tests = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.match_digests(decontaminate.match_documents(docs, tests))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.edited_fingerprints(table(spark, folder, "documents"))


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.repeat_digests(table(spark, folder, "documents"))


def fitted_toxicity(spark: SparkSession, folder: str, docs: DataFrame) -> toxicity.FactorizationMachine:
    return toxicity.fit(docs, table(spark, folder, "labels").where(~held_out(3, 1)))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fitted_toxicity(spark, folder, docs)
    return toxicity.score(docs, model, keep={"held_out": held_out(3, 1)})


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    rows = materialise(quality.with_statistics(docs, keep={"held_out": held_out(5, 0)}), "statistics")
    model = quality.fit(rows.where("NOT held_out").join(labels, "doc_id"), "quality")
    return quality.score(rows, model, keep=["doc_id", "held_out"])


def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, folder, "documents"))


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeat_digests(table(spark, folder, "documents"))


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    hard = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], rows.schema)
    return chat.read_back(chat.format_turns(rows.union(added)))


def op9_pieces(spark: SparkSession, folder: str, vocabulary: str = VOCABULARY) -> DataFrame:
    return encoding_digests(table(spark, folder, "documents"), Path(vocabulary).read_bytes())


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened_components(table(spark, folder, "embeddings"))


def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster_digests(table(spark, folder, "embeddings"), k=40, length=64, rounds=5, salt="2")


def op13_byte_tokens(spark: SparkSession, folder: str, ranks: str = RANKS) -> DataFrame:
    docs = table(spark, folder, "documents")
    return byte_tokens.encoding_digests(docs, Path(ranks).read_bytes(), public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_mixture": op1_language_mixture,
    "op2_decontaminate": op2_decontaminate,
    "op3_simhash": op3_simhash,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_chat": op8_chat,
    "op9_pieces": op9_pieces,
    "op10_quality": op10_quality,
    "op11_whitening": op11_whitening,
    "op12_centroids": op12_centroids,
    "op13_byte_tokens": op13_byte_tokens,
}
