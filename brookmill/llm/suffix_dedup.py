"""Repeated byte strings across documents, found by suffix arrays that are built in two stages.

A corpus-wide array is not built: most text repeats nowhere. Each window of ``n`` bytes has an anchor, the
gram in it with the least hash, so that equal windows have equal anchors at equal places. All consecutive windows with one
anchor form a block. The steps, each a census over all chunks (see ``census``):

1. Which anchors may occur in two documents? A count-min sketch of all anchors; it loses none.
2. Which of them do? Exactly, and with how many blocks.
3. The blocks of these are sent, and their suffix array brings equal windows together: adjacent common prefixes of ``n``
   bytes or more make runs, each run has its smallest document, and this decides about every byte. Blocks
   of the same bytes stand in an array once. A chunk sends one of them for its smallest document and one for the
   next, whose answer holds for its others.

Hashes only bring blocks together: bytes decide which are equal.

The array (``two_stage_suffix_array``) sorts only the suffixes that are smaller than their successors; scanning the
buckets of first bytes induces the others.
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

from brookmill.llm.census import Arrays, aligned, census, count_min, order_keys, pack, texts_of
from brookmill.llm.words import BASE, VALUES, powers

WINDOW = 50
SLICE_ITEMS = 1 << 20
BYTES_PER_ANCHOR = 13  # about: sets the number of slices, not the results
SORTED_BYTES = 1 << 19
CONTEXTS = 20_000
STRIDE = 1 << 16
NOTHING, COMPARE, COMPARE_WINDOWS = range(3)
_LOW = np.uint64((1 << 24) - 1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


@dataclass
class Blocks:
    """Blocks of a chunk: first window, number of windows, document (as its place), and two hashes."""

    data: bytes
    offsets: np.ndarray
    begin: np.ndarray
    windows: np.ndarray
    document: np.ndarray
    anchor: np.ndarray  # hash of the anchor gram, spread over all numbers
    content: np.ndarray  # hash of the block's bytes and of the anchor's place

    @classmethod
    def of(cls, texts: list[bytes], n: int) -> Blocks:
        gram = max(1, n // 2 - 1)
        reach = n - gram + 1  # grams in a window
        data = b"\n".join(texts)
        raw = np.frombuffer(data, np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        up, down = powers(STRIDE + 2 * n)
        parts: list[tuple[np.ndarray, ...]] = []
        for base in range(0, max(0, len(raw) - n + 1), STRIDE):
            piece = raw[base : base + STRIDE + n - 1]
            sums = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(VALUES[piece] * up[: len(piece)], out=sums[1:])
            grams = sums[gram:] - sums[:-gram]
            grams *= down[: len(grams)]
            grams = mixed(grams)
            least = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
            width = 1
            while 2 * width <= reach:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
            place = (least & _LOW).astype(np.int64)  # of the anchor of each window
            new = np.concatenate([[True], place[1:] != place[:-1]])
            ends = offsets[np.searchsorted(offsets, [base, base + len(place)], "right")[0] : np.searchsorted(offsets, base + len(place) + n, "right")]
            local = ends - base
            new[local[(local >= 0) & (local < len(new))]] = True
            begin = np.flatnonzero(new)
            count = np.diff(np.concatenate([begin, [len(place)]]))
            # A window that reaches beyond its document's last byte is none.
            stop = offsets[np.searchsorted(offsets, begin + base, "right")] - 1 - base
            count = np.minimum(count, stop - n + 1 - begin)
            good = count > 0
            begin, count = begin[good], count[good]
            anchor = place[begin]
            content = (sums[begin + count + n - 1] - sums[begin]) * down[begin]
            content ^= ((anchor - begin) << 8 | count).astype(np.uint64) * np.uint64(BASE)
            # Least hashes are small numbers: mixed again, they fall into all slices alike.
            parts.append((begin + base, count, mixed(grams[anchor]), mixed(content)))
        if not parts:
            parts = [tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))]
        begin, count, anchor, content = (np.concatenate(c) for c in zip(*parts))
        return cls(data, offsets, begin, count, np.searchsorted(offsets, begin, "right") - 1, anchor, content)


def two_stage_suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """The order of all suffixes of ``text`` by their first ``depth`` bytes at least.

    ``text`` (uint16) ends with 0, its least symbol. Stage one sorts the suffixes that are smaller than their
    successor, by 8 bytes at a time and then only those that still tie. Stage two walks through the buckets of first
    symbols in ascending order: a suffix found there puts its predecessor, if that is larger than its successor, at the
    front of the predecessor's bucket. Symbols over 0 that stand for ends make no run of their own.
    """
    size = len(text)
    rises = np.empty(size, bool)  # smaller than the successor
    rises[-1] = True
    step = np.sign(text[1:].astype(np.int32) - text[:-1])
    # In a run of equal symbols the next different one decides.
    change = np.where(step != 0, np.arange(size - 1), size)
    following = np.minimum.accumulate(change[::-1])[::-1]
    rises[:-1] = np.append(step, 1)[np.minimum(following, size - 1)] > 0

    small = np.flatnonzero(rises)
    order = small[sorted_by_prefix(text, small, depth)]
    starts = np.searchsorted(np.sort(text), np.arange(int(text.max()) + 2))
    out = np.full(size, -1, np.int64)
    first = text[order]
    counts = np.bincount(first, minlength=len(starts) - 1)
    ends = np.cumsum(counts)
    for symbol in np.flatnonzero(counts):  # at the back of their buckets
        n = counts[symbol]
        out[starts[symbol + 1] - n : starts[symbol + 1]] = order[ends[symbol] - n : ends[symbol]]
    front = starts[:-1].copy()

    for symbol in range(len(starts) - 1):
        if starts[symbol] == starts[symbol + 1]:
            continue
        # Suffixes that begin with a run of this symbol are induced from within the bucket, round by round.
        done = starts[symbol]
        while done < front[symbol]:
            before = out[done : front[symbol]] - 1
            done = front[symbol]
            same = before[(before >= 0) & (text[before] == symbol) & ~rises[before]]
            out[done : done + len(same)] = same
            front[symbol] += len(same)
        before = out[starts[symbol] : starts[symbol + 1]] - 1
        before = before[before >= 0]
        before = before[~rises[before] & (text[before] > symbol)]
        if len(before):
            target = text[before]
            by = np.argsort(target, kind="stable")
            before, target = before[by], target[by]
            new = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
            for a, b in zip(new, [*new[1:], len(target)]):
                at = front[target[a]]
                out[at : at + b - a] = before[a:b]
                front[target[a]] += b - a
    return out


def sorted_by_prefix(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """A permutation that sorts the suffixes at ``places`` by their first ``depth`` symbols or more."""
    padded = np.concatenate([text, np.zeros(8, text.dtype)]).astype(np.uint64)
    words = np.zeros(len(text), np.uint64)  # seven symbols of nine bits at every place
    for i in range(7):
        words = words << np.uint64(9) | padded[i : i + len(text)]
    order = np.argsort(words[places], kind="stable")
    key = words[places[order]]
    group = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    for offset in range(7, depth, 7):
        tied = np.flatnonzero(~(group & np.append(group[1:], True)))
        if not len(tied):
            break
        rank = np.cumsum(group)[tied]
        at = places[order[tied]] + offset
        key = np.where(at < len(text), words[np.minimum(at, len(text) - 1)], 0)
        by = np.lexsort((key, rank))
        order[tied] = order[tied][by]
        key = key[by]
        group[tied] |= np.concatenate([[True], (rank[1:] != rank[:-1]) | (key[1:] != key[:-1])])
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    """Whether each suffix of ``order`` shares its first ``n`` symbols with the one before it."""
    same = np.zeros(len(order), bool)
    live = np.arange(1, len(order))
    for offset in range(n):
        live = live[text[order[live] + offset] == text[order[live - 1] + offset]]
    same[live] = True
    return same


def representatives(
    keys: tuple[np.ndarray, ...], ids: np.ndarray, rows: np.ndarray, begin: np.ndarray, length: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """An order of byte strings by ``keys``, bytes and id, and where a representative stands in it.

    A string is the first ``length`` bytes of row ``begin`` of ``rows``. Of equal strings the one with the smallest id
    represents all with this id, and the first with a greater id all others. Keys are hashes, the last one first in
    the order: where different strings share them, there are more representatives, never too few.
    """
    order = np.lexsort((ids, *keys))
    after, before = order[1:], order[:-1]
    same = length[after] == length[before]
    for key in keys:
        same &= key[after] == key[before]
    at = np.flatnonzero(same)
    beyond = np.arange(rows.shape[1])
    for start in range(0, len(at), STRIDE):
        some = at[start : start + STRIDE]
        equal = rows[begin[after[some]]] == rows[begin[before[some]]]
        same[some] = (equal | (beyond >= length[after[some], None])).all(axis=1)
    new = np.ones(len(order), bool)
    new[1:] = ~same
    own = ids[order]
    later = own > own[new][np.cumsum(new) - 1]
    lead = new.copy()
    lead[1:] |= later[1:] & ~later[:-1]
    return order, lead


def window_keys(rows: np.ndarray) -> np.ndarray:
    """A hash of each row of bytes."""
    return mixed((VALUES[rows] * powers(rows.shape[1])[0][: rows.shape[1]]).sum(axis=1, dtype=np.uint64))


def covered_windows(blocks: np.ndarray, lengths: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """For each block (a row of bytes) a bit per window: does a block with a smaller id hold the same bytes?

    Blocks of the same bytes enter the array once, with their smallest id.
    """
    width = blocks.shape[1]
    inside = np.arange(width) < lengths[:, None]
    padded = np.where(inside, blocks, 0)
    order = np.lexsort((lengths, window_keys(padded)))
    new = np.ones(len(order), bool)
    new[1:] = (lengths[order[1:]] != lengths[order[:-1]]) | (padded[order[1:]] != padded[order[:-1]]).any(axis=1)
    kind = np.empty(len(order), np.int64)  # the distinct block of each
    kind[order] = np.cumsum(new) - 1
    sizes = lengths[order[new]]
    smallest = np.full(len(sizes), np.iinfo(np.int64).max)
    np.minimum.at(smallest, kind, ids)

    # Symbols are shifted by one; 0 ends the text and every block.
    text = np.zeros((len(sizes), width + 1), np.uint16)
    text[:, :width] = np.where(inside[order[new]], blocks[order[new]].astype(np.uint16) + 1, 0)
    flat = text[np.arange(width + 1) <= sizes[:, None]]
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    order = two_stage_suffix_array(flat, n)
    place = order - starts[owner[order]]
    order = order[place + n <= sizes[owner[order]]]
    run = np.cumsum(~common_prefixes(flat, order, n)) - 1
    least = np.full(run[-1] + 1 if len(run) else 0, np.iinfo(np.int64).max)
    holder = owner[order]
    np.minimum.at(least, run, smallest[holder])
    earliest = np.full((len(sizes), max(0, width - n + 1)), np.iinfo(np.int64).max)  # by block and window
    earliest[holder, order - starts[holder]] = least[run]
    out = np.zeros(len(blocks), np.uint64)
    for i in range(earliest.shape[1]):
        out |= (ids > earliest[kind, i]).astype(np.uint64) << np.uint64(i)
    return out


def collapse(sent: Arrays, contexts: int) -> np.ndarray:
    """What to do about each anchor of a chunk (its smallest and greatest id, its number of blocks); see the codes."""
    order = np.argsort(sent["key"], kind="stable")
    key = sent["key"][order]
    new = np.ones(len(order), bool)
    new[1:] = key[1:] != key[:-1]
    start = np.flatnonzero(new)
    lowest, highest = np.minimum.reduceat(sent["low"][order], start), np.maximum.reduceat(sent["high"][order], start)
    blocks = np.add.reduceat(sent["blocks"][order].astype(np.int64), start)
    code = np.where(lowest < highest, np.where(blocks > contexts, COMPARE_WINDOWS, COMPARE), NOTHING)
    out = np.empty(len(order), np.uint8)
    out[order] = code[np.cumsum(new) - 1]
    return out


def compared(sent: Arrays, n: int, sorted_bytes: int) -> np.ndarray:
    """Bits of covered windows for each sent block: suffix arrays over whole groups, some megabytes at a time."""
    order = np.argsort(sent["key"], kind="stable")
    key = sent["key"][order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.cumsum(sent["length"][order].astype(np.int64))
    out = np.zeros(len(order), np.uint64)
    start = 0
    while start < len(order):
        limit = (size[start - 1] if start else 0) + sorted_bytes
        stop = int(np.searchsorted(size, limit, "right"))
        at = np.searchsorted(first, stop, "right") - 1  # back to the beginning of a group, or on to its end
        stop = len(order) if stop >= len(order) else int(first[at])
        if stop <= start:
            following = np.searchsorted(first, start, "right")
            stop = int(first[following]) if following < len(first) else len(order)
        part = order[start:stop]
        out[part] = covered_windows(sent["bytes"][part], sent["length"][part].astype(np.int64), sent["id"][part], n)
        start = stop
    return out


def remove_repeats(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    chunk_bytes: int | None = None,
    slice_items: int = SLICE_ITEMS,
    contexts: int = CONTEXTS,
    sorted_bytes: int = SORTED_BYTES,
    readable: bool = False,
) -> DataFrame:
    """``docs`` with all columns and, of each row: ``_n_bytes``, ``_n_removed``, ``_n_spans`` and ``_kept`` (binary).

    A byte goes if it is covered by ``window`` bytes that also start in a row with a smaller id; matches lie within
    one document each. A null text counts as empty; texts shorter than a window lose nothing. Rows with equal ids take
    nothing from each other; a null id is smaller than all others. ``window`` is 4 to 120.

    With ``readable`` there is also ``_text``: the kept bytes as a string, without the rest of characters that were cut.

    An anchor for which over ``contexts`` blocks would be sent makes a large group: there each window is sent as a
    block of its own, keyed by its own hash, so that the group falls apart, with the same result. A window that very many
    documents share is sent at most twice by a chunk, and stands in the array once.
    """
    if not 4 <= window <= 120:
        raise ValueError("window must be 4 to 120")
    chunks = pack(docs, text, **({"size": chunk_bytes} if chunk_bytes else {}))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(partitions, chunks.total // BYTES_PER_ANCHOR // slice_items + 1)
    gram = max(1, window // 2 - 1)
    width = window + (window - gram)  # of the longest block

    def read(rows: pa.Table) -> tuple[Blocks, np.ndarray, np.ndarray]:
        """Blocks, the chunk's distinct anchors, and which one each block has."""
        found = Blocks.of(texts_of(rows, text), window)
        return found, *np.unique(found.anchor, return_inverse=True)

    def occurring(rows: pa.Table, _: list[bytes]) -> Arrays:
        found, distinct, which = read(rows)
        pairs = np.unique(which * np.int64(len(found.offsets)) + found.document)
        counts = np.bincount(pairs // len(found.offsets), minlength=len(distinct)).clip(max=2)  # documents
        return {"key": distinct, "cell": distinct & np.uint64(0xFFFFFFFF), "count": counts}

    repeated = census(
        chunks, occurring, lambda sent: count_min(sent["cell"], sent["count"]) >= 2, {"cell": "u4", "count": "u1"}, slices
    )

    def suspects(rows: pa.Table, replies: list[bytes]):
        """Blocks whose anchors may repeat, in order of anchors (as indices), and which of them are representatives."""
        found, distinct, which = read(rows)
        chosen = np.flatnonzero(aligned(replies[0], "?", distinct, slices)[which])
        ids = order_keys(rows, id)[found.document]
        view = np.lib.stride_tricks.sliding_window_view(np.frombuffer(found.data + bytes(width), np.uint8), width)
        order, lead = representatives(
            (found.content[chosen], found.anchor[chosen]), ids[chosen], view, found.begin[chosen], found.windows[chosen] + window - 1
        )
        order = chosen[order]
        anchor = found.anchor[order]
        new = np.ones(len(order), bool)
        new[1:] = anchor[1:] != anchor[:-1]
        return found, ids, view, order, lead, new

    def collapsing(rows: pa.Table, replies: list[bytes]) -> Arrays:
        found, ids, _, order, lead, new = suspects(rows, replies)
        start, own = np.flatnonzero(new), ids[order]
        if not len(start):
            return {c: np.zeros(0, np.uint64) for c in ("key", "low", "high", "blocks")}
        return {
            "key": found.anchor[order[start]],
            "low": np.minimum.reduceat(own, start),
            "high": np.maximum.reduceat(own, start),
            "blocks": np.add.reduceat(lead.astype(np.int64), start),
        }

    codes = census(
        chunks, collapsing, lambda sent: collapse(sent, contexts), {"key": "u8", "low": "i8", "high": "i8", "blocks": "u4"}, slices, [repeated]
    )

    def comparing(rows: pa.Table, replies: list[bytes]):
        """What is sent to be compared, blocks or single windows, and whom each answer concerns.

        The latter is three arrays: a representative block, a shift in it, and the place of the answer.
        """
        found, ids, view, order, lead, new = suspects(rows, replies)
        first = order[lead]
        code = aligned(replies[1], "u1", found.anchor[order[new]], slices)[(np.cumsum(new) - 1)[lead]]
        whole, split = np.flatnonzero(code == COMPARE), np.flatnonzero(code == COMPARE_WINDOWS)
        counts = found.windows[first[split]]
        shift = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        source = np.repeat(first[split], counts)
        begin, length = found.begin[source] + shift, np.full(len(source), window)
        key = window_keys(view[begin, :window])
        by, sent = representatives((key,), ids[source], view, begin, length)
        answer = np.empty(len(by), np.int64)
        answer[by] = np.cumsum(sent) - 1 + len(whole)
        sent = by[sent]

        length = np.concatenate([found.windows[first[whole]] + window - 1, length[sent]])
        text_rows = view[np.concatenate([found.begin[first[whole]], begin[sent]])]
        text_rows[np.arange(width) >= length[:, None]] = 0
        asked = {
            "key": np.concatenate([found.anchor[first[whole]], key[sent]]),
            "id": np.concatenate([ids[first[whole]], ids[source[sent]]]),
            "length": length,
            "bytes": text_rows,
        }
        concerns = (
            np.concatenate([whole, np.repeat(split, counts)]),
            np.concatenate([np.zeros(len(whole), np.int64), shift]).astype(np.uint64),
            np.concatenate([np.arange(len(whole)), answer]),
        )
        return found, order, lead, concerns, asked

    columns = {"key": "u8", "id": "i8", "length": "u1", "bytes": f"({width})u1"}
    bits = census(
        chunks,
        lambda rows, replies: comparing(rows, replies)[-1],
        lambda sent: compared(sent, window, sorted_bytes),
        columns,
        slices,
        [repeated, codes],
    )

    added = StructType(docs.schema.fields[:])
    for name in ("_n_bytes", "_n_removed", "_n_spans"):
        added = added.add(name, "long")
    added = added.add("_kept", "binary")
    if readable:
        added = added.add("_text", "string")
    names = added.names[len(docs.columns) :]
    out = to_arrow_schema(added)

    def cut(number: int, rows: pa.Table, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
        found, order, lead, (block, shift, place), asked = comparing(rows, replies)
        answers = aligned(replies[2], "u8", asked["key"], slices)
        covered = np.zeros(int(lead.sum()), np.uint64)
        np.bitwise_or.at(covered, block, answers[place] << shift)
        covered = covered[np.cumsum(lead) - 1]
        begin, windows = found.begin[order], found.windows[order]
        depth = np.zeros(len(found.data) + window + 1, np.int32)
        whole = covered == (np.uint64(1) << windows.astype(np.uint64)) - np.uint64(1)
        np.add.at(depth, begin[whole], 1)
        np.subtract.at(depth, begin[whole] + windows[whole] + window - 1, 1)
        begin, covered = begin[~whole], covered[~whole]
        for i in range(int(windows.max(initial=0))):
            places = begin[(covered >> np.uint64(i) & np.uint64(1)).astype(bool)] + i
            np.add.at(depth, places, 1)
            np.subtract.at(depth, places + window, 1)
        gone = np.cumsum(depth)[: len(found.data)] > 0
        raw = np.frombuffer(found.data, np.uint8)
        columns: dict[str, list] = {name: [] for name in names}
        for a, b in zip(found.offsets[:-1], found.offsets[1:] - 1):
            cut_ = gone[a:b]
            columns["_n_bytes"].append(int(b - a))
            columns["_n_removed"].append(int(cut_.sum()))
            columns["_n_spans"].append(int(np.count_nonzero(cut_[1:] & ~cut_[:-1]) + (len(cut_) > 0 and cut_[0])))
            columns["_kept"].append(raw[a:b][~cut_].tobytes())
            if readable:
                columns["_text"].append(columns["_kept"][-1].decode("utf-8", "ignore"))
        arrays = [c.combine_chunks() for c in rows.columns]
        arrays += [pa.array(columns[name], out.field(name).type) for name in names]
        yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return chunks.map(cut, added, [repeated, codes, bits])


def repeat_digests(docs: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256`` of each row; see ``remove_repeats``."""
    done = remove_repeats(docs.select(F.col(id), F.col(text)), id, text, **how)
    return done.select(
        id,
        F.col("_n_bytes").alias("n_bytes"),
        F.col("_n_removed").alias("n_removed"),
        F.col("_n_spans").alias("n_spans"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )
