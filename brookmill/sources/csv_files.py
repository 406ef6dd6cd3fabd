"""CSV scans with a declared schema; malformed rows are kept, not dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

CORRUPT = "_corrupt"


def read_log(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """Scan a log CSV; a short row or a bad cast leaves its raw text in ``_corrupt``.

    Column pruning is off: a pruned scan does not parse the other fields, and would miss their errors.
    """
    return (
        spark.read.schema(f"{schema}, {CORRUPT} STRING")
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)
        .option("enforceSchema", False)
        .csv(path)
    )


def read_features(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Scan a feature-batch CSV: one row per document, numeric columns."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_reviews(spark: SparkSession, paths: Sequence[str], schema: str) -> DataFrame:
    """Scan the first of several accepted locations that exists."""
    for path in paths:
        try:
            return read_log(spark, path, schema)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"none of these exists: {', '.join(paths)}")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
