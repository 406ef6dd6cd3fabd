"""Declared schemas of the input tables and their Parquet scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
    "props STRING"
)
DOCUMENTS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
LABELS = "doc_id BIGINT, quality INT, toxic INT"

SCHEMAS = {"events": EVENTS, "documents": DOCUMENTS, "labels": LABELS}


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan one table with its declared schema, so that no footer is read to infer it."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


FEW_SPLITS = 8


def spread(scan: DataFrame, by: str) -> DataFrame:
    """Deal out a table of few splits, for work that is heavy per row.

    Only a small table has fewer than ``FEW_SPLITS``; any other is read as it is, without a shuffle, on
    a cluster of any size. For more tasks there, lower ``spark.sql.files.maxPartitionBytes``.
    """
    return scan if scan.rdd.getNumPartitions() >= FEW_SPLITS else scan.repartition(FEW_SPLITS, by)
