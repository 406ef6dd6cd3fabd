"""Asking about a whole corpus from chunks of documents, without moving the texts.

The documents are written once as chunks: some megabytes of rows each, compressed, in a table bucketed by chunk. A
*census* is a question that every chunk puts about its own items (hashes of windows, say), and that only all
chunks together can answer:

1. Each chunk sends its distinct items, packed as arrays, to the slices of the hash range. What repeats within a
   chunk is sent once, so a very common item costs a slice one entry per chunk.
2. A slice answers each entry with a small number; the answers go back to the chunks.
3. A later pass works out the same items again and reads the answers beside them.

Texts are not shuffled: the answers are, to the buckets of the table. The number of slices follows the size of
the input, so that a slice's entries are bounded.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

from brookmill.llm.common import give_back
from brookmill.session import shared_path

CHUNK_BYTES = 2 << 20
BYTES_PER_WORD = 5  # about: sets the number of slices, not the results
ANSWER = "chunk BIGINT, slice INT, answer BINARY"

Arrays = dict[str, np.ndarray]
Ask = Callable[[pa.Table, list[np.ndarray]], Arrays]
Answer = Callable[[Arrays], np.ndarray]


def packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all().combine_chunks()


def texts_of(table: pa.Table, column: str) -> list[bytes]:
    """A text column as UTF-8; null as empty."""
    return [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in table.column(column).combine_chunks()]


def order_keys(table: pa.Table, column: str) -> np.ndarray:
    """Ids as numbers to compare; a null id is smaller than all others."""
    return np.array([-(1 << 63) if i is None else i for i in table.column(column).to_pylist()], np.int64)


@dataclass
class Chunks:
    """A bucketed table ``chunk, bytes, body``; ``body`` holds a chunk's rows with all their columns."""

    table: DataFrame
    schema: StructType  # of the rows
    total: int

    def joined(self, answers: Sequence[DataFrame]) -> DataFrame:
        out = self.table.select("chunk", "body")
        for i, df in enumerate(answers):
            small = df.groupBy("chunk").agg(F.collect_list(F.struct("slice", "answer")).alias(f"_{i}"))
            out = out.join(small.hint("SHUFFLE_HASH"), "chunk", "left")
        return out

    def map(
        self, work: Callable[[int, pa.Table, list[bytes]], Iterator[pa.RecordBatch]], schema: StructType, answers: Sequence[DataFrame] = ()
    ) -> DataFrame:
        """``work`` on every chunk: its number, rows, and per census the answers in the order of its slices."""
        count = len(answers)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    replies = []
                    for i in range(count):
                        got = batch.column(2 + i)[row].as_py() or []
                        replies.append(b"".join(g["answer"] for g in sorted(got, key=lambda g: g["slice"])))
                    yield from work(batch.column(0)[row].as_py(), unpacked(batch.column(1)[row].as_py()), replies)
                    del replies
                    give_back()

        return self.joined(answers).mapInArrow(run, schema)


def pack(rows: DataFrame, text: str, size: int = CHUNK_BYTES) -> Chunks:
    """Write ``rows`` as chunks of about ``size`` bytes of ``text``, split by tasks and batches as they come."""
    schema = rows.schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch]).cast(arrow)
            lengths = pa.compute.fill_null(pa.compute.binary_length(table.column(text)), 0).to_numpy()
            ends = np.cumsum(lengths)
            start = 0
            while start < len(table):
                before = int(ends[start - 1]) if start else 0
                stop = min(len(table), max(start + 1, int(np.searchsorted(ends, before + size)) + 1))
                body = packed(table.slice(start, stop - start))
                number = uuid.uuid4().int >> 65
                yield pa.RecordBatch.from_pydict(
                    {"chunk": [number], "bytes": [int(ends[stop - 1]) - before], "body": [body]}, schema=CHUNK
                )
                start = stop
            del table
            give_back()

    buckets = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(rows.mapInArrow(run, from_arrow_schema(CHUNK)), schema, buckets)


def stored(packed_rows: DataFrame, schema: StructType, buckets: int) -> Chunks:
    """Write rows of ``chunk, bytes, body`` as a bucketed table in the shared folder.

    Only the catalog knows the buckets, so the table is registered, looked up, and taken out of the catalog again;
    its files stay, and the lookup keeps what it needs.
    """
    spark = packed_rows.sparkSession
    name = f"chunks_{uuid.uuid4().hex}"
    (
        packed_rows.write.bucketBy(buckets, "chunk")
        .option("path", shared_path(spark, name))
        .saveAsTable(name, format="parquet")
    )
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return Chunks(table, schema, table.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0])


CHUNK = pa.schema([("chunk", pa.int64()), ("bytes", pa.int64()), ("body", pa.binary())])


def by_slice(keys: np.ndarray, slices: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts items by slice, and where each slice begins in it."""
    part = ((keys >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)
    order = np.argsort(part.astype(np.uint32), kind="stable")
    return order, np.searchsorted(part[order], np.arange(slices + 1, dtype=np.uint64))


def census(
    chunks: Chunks, ask: Ask, answer: Answer, columns: dict[str, str], slices: int, earlier: Sequence[DataFrame] = ()
) -> DataFrame:
    """Put a question and collect its answers; see the module. Lazy, but for what ``pack`` wrote.

    ``ask`` gets a chunk's rows and the answers of earlier censuses and returns arrays of equal length, ``key`` (uint64)
    among them. ``columns`` names those to be sent, with their dtypes; a dtype like ``(76)u1`` is a fixed row of bytes.
    ``answer`` gets the sent arrays of one slice and returns an array with one element per entry.
    """
    sent = pa.schema([("chunk", pa.int64()), ("slice", pa.int32()), *[(c, pa.binary()) for c in columns]])

    def question(number: int, rows: pa.Table, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
        items = ask(rows, replies)
        order, starts = by_slice(items["key"], slices)
        out: dict[str, list] = {c: [] for c in sent.names}
        for part in range(slices):
            chosen = order[starts[part] : starts[part + 1]]
            if len(chosen):
                out["chunk"].append(number)
                out["slice"].append(part)
                for c, kind in columns.items():
                    out[c].append(np.ascontiguousarray(items[c][chosen]).astype(_base(kind), copy=False).tobytes())
        yield pa.RecordBatch.from_pydict(out, schema=sent)

    def reply(group: pa.Table) -> pa.Table:
        arrays = {}
        for c, kind in columns.items():
            joined = np.frombuffer(b"".join(group.column(c).to_pylist()), _base(kind))
            arrays[c] = joined.reshape(-1, _width(kind)) if kind.startswith("(") else joined
        first, kind = next(iter(columns.items()))
        unit = np.dtype(_base(kind)).itemsize * (_width(kind) if kind.startswith("(") else 1)
        sizes = [len(b) // unit for b in group.column(first).to_pylist()]
        result = answer(arrays)
        del arrays
        give_back()
        ends = np.cumsum(sizes)
        return pa.table(
            {
                "chunk": group.column("chunk"),
                "slice": group.column("slice"),
                "answer": pa.array([result[e - n : e].tobytes() for e, n in zip(ends, sizes)], pa.binary()),
            }
        )

    # By number, so that slices are not merged into few tasks where they are small but costly to answer.
    asked = chunks.map(question, from_arrow_schema(sent), earlier).repartition(slices, "slice")
    return asked.groupBy("slice").applyInArrow(reply, ANSWER)


def _base(kind: str) -> str:
    return kind.rpartition(")")[2]


def _width(kind: str) -> int:
    return int(kind[1 : kind.index(")")])


def aligned(reply: bytes, kind: str, keys: np.ndarray, slices: int) -> np.ndarray:
    """The answers to a census in the order of the items that were asked about."""
    order, _ = by_slice(keys, slices)
    out = np.empty(len(keys), kind)
    out[order] = np.frombuffer(reply, kind)
    return out


def count_min(remainders: np.ndarray, counts: np.ndarray, depth: int = 3, load: int = 2, most: int = 1 << 17) -> np.ndarray:
    """Estimated totals by count-min sketches: never below the true ones.

    Each chunk's counts are its sketch in sparse form; adding them up in ``depth`` rows of counters merges the
    sketches. A row has at least ``load`` counters per entry. Beyond ``most`` entries, the range is cut and each
    part has a sketch of its own, to be small in memory.
    """
    if len(remainders) > most:
        parts = len(remainders) // most + 1
        part = (remainders.astype(np.uint64) * np.uint64(parts)) >> np.uint64(32)
        out = np.empty(len(remainders))
        for i in range(parts):
            own = np.flatnonzero(part == i)
            out[own] = count_min(remainders[own], counts[own], depth, load, len(remainders))
        return out
    width = 1 << max(4, int(load * len(remainders)).bit_length())
    shift = np.uint64(64 - width.bit_length() + 1)
    estimate = None
    for multiplier in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)[:depth]:
        cells = (remainders.astype(np.uint64) * np.uint64(multiplier) >> shift).astype(np.int64)
        row = np.bincount(cells, counts, minlength=width)
        estimate = row[cells] if estimate is None else np.minimum(estimate, row[cells])
    return estimate
