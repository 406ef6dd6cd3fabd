"""From raw to training documents: five stages over the table of documents.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of the documents.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmill.llm import decontaminate, jaccard_join, pieces, suffix_dedup, toxicity
from brookmill.llm.common import table
from brookmill.llm.queries import VOCABULARY, fitted_toxicity
from brookmill.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores below 0.7; it learns from the labelled ones among them."""
    return toxicity.drop_toxic(docs, fitted_toxicity(spark, sf_dir, docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of Jaccard similarity 0.75 or more over five-word shingles connect."""
    return jaccard_join.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without bytes covered by 50-byte strings of earlier documents; ``n_chars`` follows.

    A cut may part a character; its remaining bytes go too. Documents of which nothing is left stay, as empty
    texts; a null text stays null.
    """
    cut = suffix_dedup.remove_repeats(docs, readable=True)
    changed = F.col("_n_removed") > 0
    text = F.when(changed, F.col("_text")).otherwise(F.col("text"))
    out = cut.withColumn("text", text)
    if "n_chars" in docs.columns:
        n = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(changed, n).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: every remaining text as piece ids and decoded again."""
    return pieces.encoding_digests(docs, Path(VOCABULARY).read_bytes())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]

# No stage but the window search could be put into SQL; tests compare each with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
