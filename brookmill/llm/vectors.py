"""Columns of vectors as matrices: which rows are whole, and work on Arrow batches of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def common_length(df: DataFrame, vector: str) -> int | None:
    """The commonest length of the non-empty vectors (the larger one of equals); None if there are none."""
    sizes = df.select(F.size(df[vector]).alias("size")).where("size > 0").groupBy("size").count()
    row = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return row and row["size"]


def whole_rows(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows with exactly ``length`` entries, none null or non-finite, and those entries as doubles."""
    sizes = pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False)
    places = np.flatnonzero(sizes == length)
    flat = column.take(pa.array(places)).flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, length)  # null entries become NaN
    good = np.isfinite(values).all(axis=1)
    return places[good], values[good]


def lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The rows of a matrix as a column of lists."""
    rows, width = matrix.shape
    offsets = pa.array(np.arange(rows + 1) * width, pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel(), kind))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists of ``width`` entries each, as written by ``lists``."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def map_arrow(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[list[pa.Array]]], schema: str | StructType
) -> DataFrame:
    """Run ``work`` over each task's batches, without a shuffle; it yields the columns of ``schema``."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in work(batches):
            columns = [c if c.type == f.type else c.cast(f.type) for c, f in zip(columns, arrow)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(run, kind)
