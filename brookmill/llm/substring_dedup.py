"""Repeated word windows across documents, with a count-min sketch as the filter.

A first census adds the sparse sketches of all chunks, slice by slice, into estimates of how often each window occurs:
too high at times, never too low. A second one groups exactly, by 128-bit digests, only the windows that
are estimated to repeat, and finds the smallest document of each. A last pass cuts the words out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from brookmill.llm.census import BYTES_PER_WORD, Arrays, aligned, census, count_min, order_keys, pack, texts_of
from brookmill.llm.words import Words, class_table, split_words, window_hashes

WINDOW = 13
SLICE_ITEMS = 1 << 20
INSIDE = class_table(bytes(b for b in range(256) if b != 32 and not 9 <= b <= 13))


@dataclass
class Windows:
    """The windows of a chunk: where they begin, their hash, document (as its place) and the chunk's distinct ones."""

    words: Words
    begin: np.ndarray
    hashes: np.ndarray
    document: np.ndarray
    distinct: np.ndarray
    which: np.ndarray  # the distinct hash of each window

    @classmethod
    def of(cls, texts: list[bytes], n: int) -> Windows:
        words = split_words(texts, INSIDE)
        hashes = window_hashes(words.hashes, n)
        document = np.repeat(np.arange(len(texts)), np.diff(words.first))
        inside = np.flatnonzero(document[: len(hashes)] == document[n - 1 :]) if len(hashes) else np.zeros(0, np.int64)
        distinct, which = np.unique(hashes[inside], return_inverse=True)
        return cls(words, inside, hashes[inside], document[inside], distinct, which)


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, chunk_bytes: int | None = None, slice_items: int = SLICE_ITEMS
) -> DataFrame:
    """``docs`` with all columns and, of each row: ``_n_words``, ``_n_removed`` and ``_kept`` (words joined by a space).

    A word goes if it lies in a window of ``window`` words whose sequence also starts in a row with a smaller id. A
    null text has no words, and neither it nor a text of fewer words than a window loses any. Rows with
    equal ids take nothing from each other. A null id is smaller than all others.
    """
    chunks = pack(docs, text, **({"size": chunk_bytes} if chunk_bytes else {}))
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(least, chunks.total // BYTES_PER_WORD // slice_items + 1)

    def occurring(rows: pa.Table, _: list[bytes]) -> Arrays:
        found = Windows.of(texts_of(rows, text), window)
        counts = np.bincount(found.which, minlength=len(found.distinct)).clip(max=2)
        key = found.distinct
        return {"key": key, "cell": key & np.uint64(0xFFFFFFFF), "count": counts}

    estimates = census(
        chunks, occurring, lambda sent: count_min(sent["cell"], sent["count"]) >= 2, {"cell": "u4", "count": "u1"}, slices
    )

    def suspects(rows: pa.Table, replies: list[bytes]) -> tuple[Windows, np.ndarray, np.ndarray, np.ndarray]:
        """Windows, the distinct ones estimated to repeat, their smallest ids, and the ids of all rows."""
        found = Windows.of(texts_of(rows, text), window)
        repeats = np.flatnonzero(aligned(replies[0], "?", found.distinct, slices))
        ids = order_keys(rows, id)
        smallest = np.full(len(found.distinct), np.iinfo(np.int64).max)
        np.minimum.at(smallest, found.which, ids[found.document])
        return found, repeats, smallest, ids

    def asked(rows: pa.Table, replies: list[bytes]) -> Arrays:
        found, repeats, smallest, _ = suspects(rows, replies)
        first = np.zeros(len(found.distinct), np.int64)
        first[found.which] = found.begin
        second = window_hashes(found.words.hashed(1), window)
        second = second[first[repeats]] if len(repeats) else np.zeros(0, np.uint64)
        return {"key": found.distinct[repeats], "second": second, "id": smallest[repeats]}

    def smaller(sent: Arrays) -> np.ndarray:
        """Does a smaller id have the window?"""
        order = np.lexsort((sent["id"], sent["second"], sent["key"]))
        key, second, ids = (sent[c][order] for c in ("key", "second", "id"))
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (second[1:] != second[:-1])])
        least = ids[new][np.cumsum(new) - 1]
        out = np.empty(len(order), bool)
        out[order] = least < ids
        return out

    exact = census(chunks, asked, smaller, {"key": "u8", "second": "u8", "id": "i8"}, slices, [estimates])

    added = StructType(docs.schema.fields[:]).add("_n_words", "long").add("_n_removed", "long").add("_kept", "string")
    out = to_arrow_schema(added)

    def cut(number: int, rows: pa.Table, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
        found, repeats, smallest, ids = suspects(rows, replies)
        elsewhere = np.zeros(len(found.distinct), bool)
        elsewhere[repeats] = aligned(replies[1], "?", found.distinct[repeats], slices)
        covered = elsewhere[found.which] | (ids[found.document] > smallest[found.which])
        words = found.words
        depth = np.zeros(len(words.starts) + 1, np.int64)
        begins = found.begin[covered]
        depth[begins] += 1
        np.subtract.at(depth, begins + window, 1)
        kept = np.cumsum(depth[:-1]) == 0
        columns: dict[str, list] = {"_n_words": [], "_n_removed": [], "_kept": []}
        data = words.data
        for a, b in zip(words.first[:-1], words.first[1:]):
            stay = np.flatnonzero(kept[a:b]) + a
            columns["_n_words"].append(int(b - a))
            columns["_n_removed"].append(int(b - a - len(stay)))
            pieces = zip(words.starts[stay].tolist(), words.ends[stay].tolist())
            columns["_kept"].append(b" ".join([data[s:e] for s, e in pieces]).decode())
        arrays = [c.combine_chunks() for c in rows.columns]
        arrays += [pa.array(columns[f.name], f.type) for f in list(out)[-3:]]
        yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return chunks.map(cut, added, [estimates, exact])


def repeat_digests(docs: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``id, n_words, n_removed, kept_sha256`` of each row; see ``remove_repeats``."""
    done = remove_repeats(docs.select(F.col(id), F.col(text)), id, text, **how)
    return done.select(
        id, F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), F.sha2("_kept", 256).alias("kept_sha256")
    )
