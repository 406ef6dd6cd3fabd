"""Features of the review texts: rule hits, character TF-IDF, and their fusion with other columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brookmill.functions.numbers import rounded
from brookmill.functions.text import char_grams, words
from brookmill.operators.cleaning import EMAIL, PHONE
from brookmill.operators.skew import BROADCAST_BYTES, lookup
from brookmill.session import materialise
from brookmill.sources.tables import FEW_SPLITS

SLICE_BYTES = 1 << 20

@dataclass(frozen=True)
class Rule:
    """A named pattern; a text that matches it adds ``weight`` to its score.

    ``needs`` is a literal that every match contains: a text without it is not tried.
    """

    rule_id: str
    pattern: str
    weight: float
    needs: str = ""


RULES = (
    Rule("email", EMAIL, 1.0, needs="@"),
    Rule("phone", PHONE, 1.0),
    Rule("licence", r"(?i)licen[sc]e|copyright", 0.5),
    Rule("symbols", r"[%*#]{3,}", 2.0),
)


def rule_columns(rules: Sequence[Rule] = RULES) -> list[Column]:
    """One 0/1 flag per rule over ``text``, and the weighted ``score``.

    The rules are part of the program, so each is a column expression: a scan with no join, in place
    of a documents x rules product.
    """
    text = F.col("text")
    hits = [
        (text.contains(r.needs) & text.rlike(r.pattern) if r.needs else text.rlike(r.pattern)).cast("int")
        for r in rules
    ]
    score = sum((hit * F.lit(r.weight) for r, hit in zip(rules, hits)), F.lit(0.0))
    return [*[hit.alias(r.rule_id) for r, hit in zip(rules, hits)], score.alias("score")]


def number_columns() -> list[Column]:
    """Numeric columns of the whole ``text``."""
    return [
        F.col("n_chars"),
        F.size(words(F.col("text"))).cast("bigint").alias("n_words"),
        F.char_length(F.regexp_replace("text", "[^0-9]+", "")).cast("bigint").alias("n_digits"),
    ]


def rule_features(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    return docs.select("doc_id", *rule_columns(rules))


def text_numbers(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", *number_columns())


def feature_sample(docs: DataFrame, n: int = 1000) -> DataFrame:
    """A repeatable sample: the ``n`` documents with the smallest hash of their id."""
    return docs.select("doc_id").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(n)


def feature_fusion(numbers: DataFrame, labels: DataFrame, rules: DataFrame) -> DataFrame:
    """Labels, text numbers and rule features in one row per labelled document.

    All three are keyed by ``doc_id`` and hold no text, so the joins shuffle narrow rows, once each.
    """
    return labels.join(numbers, "doc_id").join(rules, "doc_id")


def text_slices(docs: DataFrame) -> int:
    """How many slices of about ``SLICE_BYTES`` the texts make; a small table is dealt out all the same."""
    taken = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(FEW_SPLITS, -(-taken // SLICE_BYTES))


def gram_counts(docs: DataFrame, n: int = 2) -> DataFrame:
    """``doc_id, gram, tf`` of the whole texts.

    The texts are shuffled by document, not the far more numerous grams; the counts need no other shuffle. A task counts the grams of one slice, so
    their number grows with the texts and not the memory of one. Slices stay small as files, too: a scan packs at most some thirty into a task.
    """
    grams = F.explode(char_grams(F.col("text"), n)).alias("gram")
    return (
        docs.repartition(text_slices(docs), "doc_id")
        .select("doc_id", grams)
        .groupBy("doc_id", "gram")
        .agg(F.count("*").alias("tf"))
    )


def document_frequency(counts: DataFrame) -> DataFrame:
    """``gram, df`` from the gram counts; the map tasks combine, so a common gram is cheap."""
    return counts.groupBy("gram").agg(F.count("*").alias("df"))


def char_tfidf(
    docs: DataFrame, n: int = 2, top: int = 20, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The ``top`` character grams of each document by ``tf * ln((N + 1) / (df + 1))``.

    The texts are taken apart once. Before the ranking shuffles anything, each task cuts its documents to
    their ``top`` grams.
    """
    counts = materialise(gram_counts(docs, n), "gram-counts")
    frequency = materialise(document_frequency(counts), "gram-frequency")
    total = docs.agg(F.count("*")).scalar()
    idf = F.log((total + F.lit(1.0)) / (F.col("df") + F.lit(1.0)))
    weights = frequency.withColumn("idf", idf)
    scored = lookup(counts, weights, ["gram"], "df", ["doc_id"], broadcast_bytes)
    ranked = scored.select(
        "doc_id",
        "gram",
        "tf",
        rounded(F.col("tf") * F.col("idf")).alias("tfidf"),
    )
    order = W.partitionBy("doc_id").orderBy(F.desc("tfidf"), "gram")
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).drop("rank")


def hashed_counts(df: DataFrame, features: int = 2**16) -> DataFrame:
    """``grams`` as a vector of counts; hashing needs no vocabulary on the driver."""
    return HashingTF(inputCol="grams", outputCol="tf", numFeatures=features).transform(df).drop("grams")


def idf_pipeline(output: str = "tfidf") -> Pipeline:
    """Hashed counts to unit-length TF-IDF vectors."""
    return Pipeline(stages=[IDF(inputCol="tf", outputCol="_idf"), Normalizer(inputCol="_idf", outputCol=output)])


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``label, n, w`` with ``w = N / (K * n)``, from the class counts alone; a null label is no class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    rows = counts.agg(F.sum("n")).scalar()
    classes = counts.agg(F.count("*")).scalar()
    return counts.withColumn("w", rounded(rows / (classes * F.col("n"))))
