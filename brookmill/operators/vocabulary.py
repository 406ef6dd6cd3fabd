"""TF-IDF vectors over a distributed vocabulary: every gram has an index of its own, without hashing and without a list on the driver."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brookmill.operators.features import document_frequency, gram_counts
from brookmill.operators.skew import BROADCAST_BYTES, lookup, number_rows
from brookmill.session import materialise, shared_path


def vocabulary(frequency: DataFrame, size: int | None = None) -> DataFrame:
    """``gram, df, index``: grams numbered from 0 by falling document frequency, then by the gram; the first ``size`` of them."""
    ordered = number_rows(frequency.withColumn("_rare", -F.col("df")), [], ["_rare", "gram"], "_place")
    numbered = ordered.select("gram", "df", (F.col("_place") - 1).cast("int").alias("index"))
    return numbered if size is None else numbered.where(F.col("index") < size)


def tfidf_entries(docs: DataFrame, n: int = 2, size: int | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, index, weight`` of every gram of every document, with the weights of ``features.char_tfidf``."""
    counts = materialise(gram_counts(docs, n), "gram-counts")
    total = docs.agg(F.count("*")).scalar()
    known = materialise(vocabulary(document_frequency(counts), size), "vocabulary")
    weights = known.withColumn("_idf", F.log((total + F.lit(1.0)) / (F.col("df") + F.lit(1.0))))
    found = lookup(counts, weights, ["gram"], "df", ["doc_id"], broadcast_bytes).where(F.col("index").isNotNull())
    return found.select("doc_id", "index", (F.col("tf") * F.col("_idf")).alias("weight"))


def sparse_vectors(rows: DataFrame, entries: DataFrame, size: int, id: str = "doc_id", name: str = "tfidf") -> DataFrame:
    """``rows``, narrow ones, with one sparse vector of ``size`` entries each, for Spark ML; without entries an empty one.

    A document's entries are one row of its own, and are sorted there. The parts of a vector are written as plain columns and read
    back as the vector type, which stores the same parts: no Python takes part.
    """
    sorted_ = F.array_sort(F.collect_list(F.struct("index", "weight")))
    packed = entries.groupBy(id).agg(sorted_.alias("_e"))
    found = F.coalesce("_e", F.array().cast(packed.schema["_e"].dataType))
    parts = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).cast("int").alias("size"),
        found["index"].alias("indices"),
        found["weight"].alias("values"),
    )
    path = shared_path(entries.sparkSession, "sparse-vectors")
    rows.join(packed, id, "left").select(*rows.columns, parts.alias(name)).write.parquet(path)
    return entries.sparkSession.read.schema(StructType(rows.schema.fields[:]).add(name, VectorUDT())).parquet(path)
