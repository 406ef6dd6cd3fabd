"""Words of many texts at once, as arrays: their places and 64-bit hashes.

A word is a run of bytes of a class. Its hash adds up its lanes of eight bytes, each mixed nonlinearly together with its number, so
that no exchange of bytes or lanes cancels out as it does in a polynomial modulo 2**64. Equal words have equal
hashes; for different ones that were not made to collide, chance is the only reason to, about 2**-64. Hashes of two
seeds are independent of each other.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

SHARD = 2 << 20
SLICE = 1 << 20
BASE = 0x9E3779B97F4A7C15
VALUES = np.random.default_rng(1).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


@lru_cache(maxsize=4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to n."""
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for factor in (BASE, inverse):
        steps = np.full(n + 1, factor, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def class_table(kept: bytes) -> np.ndarray:
    """A 256-entry table: true for the bytes of ``kept``."""
    found = np.zeros(256, bool)
    found[list(kept)] = True
    return found


@dataclass
class Words:
    """Words of a shard: byte places, hashes, and the first word of each text (one more entry for the end)."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    data: bytes
    offsets: np.ndarray
    folded: np.ndarray  # the bytes that are hashed

    def hashed(self, seed: int) -> np.ndarray:
        """Hashes of another seed, from the bytes."""
        return word_hashes(self.folded, self.starts, self.ends, seed)


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed random-like permutation of the 64-bit numbers, in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the words ``raw[start:end]``, none of them empty."""
    hashes = np.empty(len(starts), np.uint64)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    at_any = np.ndarray(len(padded) - 7, "<u8", padded.data, strides=(1,))  # eight bytes from every place on
    key = np.uint64((seed * 0x632BE59BD9B4E019 + 0x5851F42D4C957F2D) % (1 << 64))
    done = 0
    while done < len(starts):  # in slices that end between words, so that the arrays stay short
        upto = max(done + 1, int(np.searchsorted(ends, starts[done] + SLICE, "right")))
        begin, length = starts[done:upto], ends[done:upto] - starts[done:upto]
        lanes = (length + 7) >> 3
        first = np.cumsum(lanes) - lanes
        number = np.arange(int(lanes.sum())) - np.repeat(first, lanes)
        lane = at_any[np.repeat(begin, lanes) + 8 * number].astype(np.uint64)
        last, rest = first + lanes - 1, ((8 - (length & 7)) & 7).astype(np.uint64) * np.uint64(8)
        lane[last] &= np.uint64(0xFFFFFFFFFFFFFFFF) >> rest  # nothing of the next word
        lane = mixed(lane + key + number.astype(np.uint64) * np.uint64(BASE))
        lane ^= key >> np.uint64(7)
        total = np.add.reduceat(mixed(lane), first)
        hashes[done:upto] = mixed(total + length.astype(np.uint64) * np.uint64(BASE))
        done = upto
    return hashes


def shards(texts: Sequence[str | None], size: int = SHARD) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts as UTF-8 (null: empty) in lists of about ``size`` bytes, each with its first index."""
    start, held, total = 0, [], 0
    for i, text in enumerate(texts):
        held.append((text or "").encode())
        total += len(held[-1]) + 1
        if total >= size:
            yield start, held
            start, held, total = i + 1, [], 0
    if held:
        yield start, held


def split_words(texts: list[bytes], inside: np.ndarray, fold: np.ndarray | None = None) -> Words:
    """All words of ``texts``; ``fold`` maps bytes before they are hashed. No word crosses a text's end."""
    data = b"\n".join(texts)
    raw = np.frombuffer(data, np.uint8)
    lengths = np.array([len(t) + 1 for t in texts])
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    if fold is not None:
        raw = fold[raw]
    member = np.zeros(len(raw) + 2, np.int8)
    member[1:-1] = inside[raw]
    edges = np.flatnonzero(member[1:] != member[:-1])
    starts, ends = edges[::2], edges[1::2]
    hashes = word_hashes(raw, starts, ends)
    return Words(starts, ends, hashes, np.searchsorted(starts, offsets), data, offsets, raw)


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` consecutive hashes (empty if there are fewer)."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(size, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out *= np.uint64(BASE)
            out += hashes[i : i + size]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(29)
    return out
