"""Byte-level merge encoding by ranks, and decoding to raw bytes.

The ``tiktoken`` library encodes; its ranks come from a local file. Two things keep long texts cheap and safe:

* A text is cut at *safe* places: before a space or line end that follows a character that is no white space. No match of
  the pattern crosses such a place, and none looks back, so the parts are encoded apart, one at a time.
* A long run of white space would exhaust the library's backtracking. Its one long match is known without the pattern (all
  of the run but its last character, or all of it at the end of the text), and is encoded as a single match.

Ids are decoded to bytes, not to characters: a token may end inside a character.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StructType

from brookmill.llm.common import Rows, map_batches

PART_CHARS = 1 << 16
LONG_RUN = 1 << 10
# The characters of Unicode's White_Space property.
WHITE = "".join(map(chr, [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_SAFE = re.compile(rf"(?<=[^{WHITE}])[ \n]")
_LONG = re.compile(rf"[{WHITE}]{{{LONG_RUN},}}")


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Ranks by token from a rank file: lines of a token in base 64 and its rank."""
    lines = (line.split() for line in content.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in lines}


def parts(text: str, size: int = PART_CHARS) -> Iterator[tuple[str, bool]]:
    """``text`` in consecutive parts that no match crosses, and whether a part is one match by itself."""
    start = 0
    for run in _LONG.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        yield from _short_parts(text, start, run.start(), size)
        yield text[run.start() : end], True
        start = end
    yield from _short_parts(text, start, len(text), size)


def _short_parts(text: str, start: int, end: int, size: int) -> Iterator[tuple[str, bool]]:
    while end - start > size:
        cut = _SAFE.search(text, start + size, end)
        if cut is None:
            break
        yield text[start : cut.start()], False
        start = cut.start()
    if start < end:
        yield text[start:end], False


class ByteCodec:
    """Encoder and decoder of one rank file and pattern, without special tokens."""

    def __init__(self, ranks: bytes, pattern: str):
        table = read_ranks(ranks)
        if any(bytes([b]) not in table for b in range(256)):
            raise ValueError("the ranks must hold every single byte")
        self._matches = tiktoken.Encoding("matches", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self._single = tiktoken.Encoding("single", pat_str=r"[\s\S]+", mergeable_ranks=table, special_tokens={})

    def pieces(self, text: str, size: int = PART_CHARS) -> Iterator[list[int]]:
        """Ids of ``text``, part by part."""
        for part, single in parts(text, size):
            yield (self._single if single else self._matches).encode_ordinary(part)

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.pieces(text) for i in ids]

    def decode(self, ids: list[int]) -> bytes:
        return self._matches.decode_bytes(ids)

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, digest of the ids as little-endian unsigned 32-bit integers, digest of the decoded bytes."""
        n, coded, decoded = 0, sha256(), sha256()
        for ids in self.pieces(text):
            n += len(ids)
            coded.update(np.array(ids, "<u4").tobytes())
            decoded.update(self.decode(ids))
        return n, coded.hexdigest(), decoded.hexdigest()


@lru_cache(maxsize=2)
def codec(ranks: bytes, pattern: str) -> ByteCodec:
    """One codec for each worker process."""
    return ByteCodec(ranks, pattern)


def encode_documents(docs: DataFrame, ranks: bytes, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, ids, decoded`` of every row: token ids, and the bytes decoded from them. No shuffle.

    A null text counts as empty: no ids, no bytes. Repeated rows, null ids and other columns, of whatever name, are of no
    consequence: one output row for each input row. ``ranks`` (a file's content) is sent with the tasks.
    """
    schema = StructType().add(id, docs.schema[id].dataType).add("ids", ArrayType(IntegerType())).add("decoded", "binary")

    def work(batches: Rows) -> Rows:
        tokens = codec(ranks, pattern)
        for batch in batches:
            ids = [tokens.encode(t or "") for t in batch["_text"]]
            yield {id: batch[id], "ids": ids, "decoded": [tokens.decode(i) for i in ids]}

    return map_batches(docs.select(docs[id], docs[text].alias("_text")), work, schema)


def decode_documents(encoded: DataFrame, ranks: bytes, pattern: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``id, decoded`` of every row of token ids; null ids give no bytes. An unknown id fails."""
    schema = StructType().add(id, encoded.schema[id].dataType).add("decoded", "binary")

    def work(batches: Rows) -> Rows:
        tokens = codec(ranks, pattern)
        for batch in batches:
            yield {id: batch[id], "decoded": [tokens.decode(i or []) for i in batch["_ids"]]}

    return map_batches(encoded.select(encoded[id], encoded[ids].alias("_ids")), work, schema)


def encoding_digests(docs: DataFrame, ranks: bytes, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` of every row; see ``encode_documents``.

    The digests grow part by part in the same tasks, so that neither ids nor bytes of a long text are held whole.
    """
    kind = docs.schema[id].dataType
    schema = StructType().add(id, kind).add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    def work(batches: Rows) -> Rows:
        tokens = codec(ranks, pattern)
        for batch in batches:
            n, coded, decoded = zip(*[tokens.digests(t or "") for t in batch["_text"]]) if batch[id] else ((), (), ())
            yield {id: batch[id], "n_tokens": n, "ids_sha256": coded, "decoded_sha256": decoded}

    return map_batches(docs.select(docs[id], docs[text].alias("_text")), work, schema)
