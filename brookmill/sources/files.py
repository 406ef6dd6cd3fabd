"""File inventory, the storage-format comparison and the day-partitioned Parquet store."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmill.functions.numbers import mib
from brookmill.session import shared_path

FORMATS = ("csv", "json", "parquet", "orc")

# Text formats cut times to milliseconds unless told otherwise.
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TEXT_OPTIONS = {"timestampNTZFormat": MICROS, "timestampFormat": f"{MICROS}XXX"}
OPTIONS = {"csv": {"header": "true", **TEXT_OPTIONS}, "json": TEXT_OPTIONS}


def file_inventory(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``name, mib`` of every file below ``path``; only the listing is read, never the content.

    Spark's file source leaves out files of zero bytes.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.regexp_extract("path", "[^/]+$", 0).alias("name"), mib("length").alias("mib"))
    )


def any_file_available(spark: SparkSession, paths: Sequence[str]) -> bool:
    """True as soon as one of the accepted files exists; Spark looks a path up when it is named."""
    for path in paths:
        try:
            file_inventory(spark, path)
            return True
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return False


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of the paths that exist; nothing is listed or read."""
    conf, found = spark.sparkContext._jsc.hadoopConfiguration(), []
    for name in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        if path.getFileSystem(conf).exists(path):
            found.append(name)
    return found


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that may be missing."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _fingerprint(df: DataFrame) -> DataFrame:
    """``rows, print``: row count and order-free checksum of all rows, by one partial aggregate.

    The sums take 20 bits of the row hash each, so they stay exact up to 2**43 rows.
    """
    row = F.xxhash64(*df.columns, *[F.col(c).isNull() for c in df.columns])
    parts = [F.sum(F.shiftrightunsigned(row, bits).bitwiseAND(0xFFFFF)) for bits in (0, 20, 40)]
    return df.agg(
        F.count("*").alias("rows"), F.struct(*parts, F.bit_xor(row)).alias("print")
    )


def write_formats(df: DataFrame, formats: Sequence[str] = FORMATS) -> dict[str, str]:
    """Write ``df`` once per format; the path of each."""
    paths = {name: shared_path(df.sparkSession, f"as-{name}") for name in formats}
    for name, path in paths.items():
        df.write.format(name).options(**OPTIONS.get(name, {})).save(path)
    return paths


def format_sizes(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """``format, mib`` of each written copy, from the file listing."""
    return _union(
        [
            spark.read.format("binaryFile")
            .load(path)
            .agg(mib(F.sum("length")).alias("mib"))
            .select(F.lit(name).alias("format"), "mib")
            for name, path in paths.items()
        ]
    )


def format_compare(df: DataFrame, formats: Sequence[str] = FORMATS) -> DataFrame:
    """Write ``df`` in each format, read it back, and report ``format, rows, same``.

    Each copy is read once, for its fingerprint; rows are never compared by a join.
    """
    expected = _fingerprint(df).select(F.struct("rows", "print")).scalar()
    results = []
    for name, path in write_formats(df, formats).items():
        reader = df.sparkSession.read.format(name).schema(df.schema)
        back = reader.options(**OPTIONS.get(name, {})).load(path)
        results.append(
            _fingerprint(back).select(
                F.lit(name).alias("format"),
                "rows",
                F.struct("rows", "print").eqNullSafe(expected).alias("same"),
            )
        )
    return _union(results)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def write_daily(df: DataFrame, path: str, ts: str = "ts", day: str = "dt") -> None:
    """Write the log as Parquet partitioned by day.

    The rebalance hint gathers a day into few files; adaptive execution splits a day that is too
    large for one task and merges small ones.
    """
    (
        df.withColumn(day, F.to_date(ts))
        .hint("rebalance", day)
        .write.mode("overwrite")
        .partitionBy(day)
        .parquet(path)
    )


def read_daily(spark: SparkSession, path: str, schema: str, day: str = "dt") -> DataFrame:
    """Scan the store; a filter on ``day`` prunes folders before any file is opened."""
    return spark.read.schema(f"{schema}, {day} DATE").parquet(path)
