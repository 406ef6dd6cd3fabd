"""What the document operators share: tables, folds of ids, and Arrow batches in and out."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from brookmill.sources.tables import DOCUMENTS, LABELS

SCHEMAS = {
    "documents": DOCUMENTS,
    "labels": LABELS,
    "benchmark": "item_id BIGINT, text STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
}

SLICE_ROWS = 1_000

Rows = Iterator[dict[str, list]]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def remainder(id: str, n: int) -> Column:
    """crc32 of the id's decimal text modulo ``n``: the fold of a row. A null id has a null fold."""
    return F.crc32(F.col(id).cast("string")) % n


def give_back() -> None:
    """Return freed memory to the system: a worker lives on after its task, and would keep its largest size."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # not this C library
    _trim = None


def hexdigest(data: bytes) -> str:
    return sha256(data).hexdigest()


def map_batches(df: DataFrame, work: Callable[[Rows], Rows], schema: str | StructType) -> DataFrame:
    """Run ``work`` over each task's batches, as columns of Python lists, without a shuffle."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = (batch.slice(at, SLICE_ROWS) for batch in batches for at in range(0, batch.num_rows, SLICE_ROWS))
        columns = ({f: batch.column(i).to_pylist() for i, f in enumerate(batch.schema.names)} for batch in slices)
        for out in work(columns):
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], f.type) for f in arrow], schema=arrow
            )
        give_back()

    return df.mapInArrow(run, kind)
