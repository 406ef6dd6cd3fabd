"""Benchmark decontamination by suffix arrays of the documents.

Each task sorts the word suffixes of its documents, shard by shard. Every suffix of the test set is then looked up by
binary search: its neighbours give the longest verbatim match, and the range of equal prefixes all its
places. Sorting leaves out suffixes that cannot match two words: those whose first two words stand nowhere in
the test set side by side (one word, if an item has only one).

The test set is broadcast in blocks of bounded size, one at a time; with several, each is a pass over the documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmill.llm.words import class_table, shards, split_words, window_hashes
from brookmill.session import materialise

BLOCK_BYTES = 8 << 20
LOOKUPS = 4_096
_BYTES = np.arange(256, dtype=np.uint8)
FOLD = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
INSIDE = class_table(b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))

END = np.uint64(0)  # after the last word of a text; no hash is zero
FOUND = "n_words BIGINT, spans ARRAY<STRUCT<start: INT, stop: INT>>, items ARRAY<STRING>, longest INT"


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, each text followed by ``END``; and where each text starts."""
    words = split_words(texts, INSIDE, FOLD)
    counts = np.diff(words.first)
    starts = np.concatenate([[0], np.cumsum(counts + 1)])
    out = np.zeros(starts[-1], np.uint64)
    text_of = np.repeat(np.arange(len(texts)), counts)
    out[np.arange(len(words.hashes)) + text_of] = np.maximum(words.hashes, np.uint64(1))
    return out, starts


@dataclass
class TestSet:
    """Suffixes of the items of one block."""

    __test__ = False

    names: list[str]
    hashes: np.ndarray
    place: np.ndarray  # of each suffix in ``hashes``
    item: np.ndarray
    left: np.ndarray  # words from the suffix to the item's end
    window: np.ndarray  # words of the item's windows
    seed: int
    seeds: np.ndarray  # sorted hashes of the first ``seed`` words

    @classmethod
    def of(cls, items: list[tuple[str, str]], window: int) -> TestSet:
        hashes, starts = hashed_words([text.encode() for _, text in items])
        counts = np.diff(starts) - 1
        place = np.flatnonzero(hashes != END)
        item = np.searchsorted(starts, place, "right") - 1
        left = starts[item + 1] - 1 - place
        windows = np.minimum(counts, window)[item]
        seed = int(min(2, windows.min(initial=2)))
        whole = left >= windows  # only these begin a window
        seeds = np.unique(seed_hashes(hashes, place[whole], seed))
        return cls([name for name, _ in items], hashes, place[whole], item[whole], left[whole], windows[whole], seed, seeds)


def seed_hashes(hashes: np.ndarray, places: np.ndarray, seed: int) -> np.ndarray:
    return hashes[places] if seed == 1 else window_hashes(hashes, 2)[places]


def suffix_array(hashes: np.ndarray, places: np.ndarray, deepest: int) -> np.ndarray:
    """``places`` in the order of the suffixes that begin there, words compared by hash, up to their ``END``.

    Sorted by the first word; then, again and again, only suffixes that tie so far are sorted by their next
    word, up to ``deepest`` words: no lookup compares more. Equal ones stay in the order of their places.
    """
    order = places[np.argsort(hashes[places], kind="stable")]
    group = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]) if len(order) else np.zeros(0, bool)
    for depth in range(1, deepest):
        open_ = np.flatnonzero(~(group & np.concatenate([group[1:], [True]])))  # members of ties
        if not len(open_):
            break
        rank = np.cumsum(group)[open_]
        word = hashes[order[open_] + depth]
        by = np.lexsort((word, rank))
        order[open_] = order[open_][by]
        word = word[by]
        fresh = np.concatenate([[True], (rank[1:] != rank[:-1]) | (word[1:] != word[:-1])])
        group[open_] |= fresh | (word == END)
    return order


def common_words(hashes: np.ndarray, places: np.ndarray, test: TestSet, suffix: np.ndarray, limit: np.ndarray):
    """Equal leading words of document and test suffixes (at most ``limit``), and whether the former is smaller there."""
    length = np.zeros(len(places), np.int64)
    smaller = np.zeros(len(places), bool)
    live = np.arange(len(places))
    while len(live):
        on = length[live] < limit[live]
        live = live[on]
        mine = hashes[places[live] + length[live]]
        other = test.hashes[test.place[suffix[live]] + length[live]]
        same = (mine == other) & (mine != END)
        smaller[live[~same]] = mine[~same] < other[~same]
        live = live[same]
        length[live] += 1
    return length, smaller


def search(hashes: np.ndarray, order: np.ndarray, test: TestSet, suffix: np.ndarray, limit: np.ndarray, after: bool):
    """First index of the suffix array not below each test suffix cut to ``limit`` words (``after``: above all equal ones)."""
    low, high = np.zeros(len(suffix), np.int64), np.full(len(suffix), len(order))
    while True:
        live = np.flatnonzero(low < high)
        if not len(live):
            return low
        middle = (low[live] + high[live]) // 2
        length, smaller = common_words(hashes, order[middle], test, suffix[live], limit[live])
        right = smaller | (after & (length >= limit[live]))
        low[live[right]] = middle[right] + 1
        high[live[~right]] = middle[~right]


def look_up(hashes: np.ndarray, order: np.ndarray, test: TestSet) -> tuple[np.ndarray, ...]:
    """For every place where a window occurs: place, words matched there, item, window length."""
    out: list[tuple[np.ndarray, ...]] = []
    for start in range(0, len(test.place) if len(order) else 0, LOOKUPS):
        suffix = np.arange(start, min(start + LOOKUPS, len(test.place)))
        at = search(hashes, order, test, suffix, test.left[suffix], after=False)
        longest = np.zeros(len(suffix), np.int64)
        for neighbour in (np.maximum(at - 1, 0), np.minimum(at, len(order) - 1)):
            length, _ = common_words(hashes, order[neighbour], test, suffix, test.left[suffix])
            longest = np.maximum(longest, length)
        hit = suffix[longest >= test.window[suffix]]
        first = search(hashes, order, test, hit, test.window[hit], after=False)
        counts = search(hashes, order, test, hit, test.window[hit], after=True) - first
        each = np.repeat(np.arange(len(hit)), counts)
        index = np.arange(len(each)) - np.repeat(np.cumsum(counts) - counts, counts) + first[each]
        places, found = order[index], hit[each]
        length, _ = common_words(hashes, places, test, found, test.left[found])
        out.append((places, length, test.item[found], test.window[found]))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(column) for column in zip(*out))


def match_shard(texts: list[bytes], test: TestSet) -> list[tuple[int, list[tuple[int, int]], list[str], int]]:
    """For each text: words, hit word spans, names of items with an occurring window, longest match."""
    hashes, starts = hashed_words(texts)
    if test.seed == 1:
        keys = hashes
    else:
        keys = window_hashes(hashes, 2)
    at = np.minimum(np.searchsorted(test.seeds, keys), max(0, len(test.seeds) - 1))
    places = np.flatnonzero((test.seeds[at] == keys) & (hashes[: len(keys)] != END)) if len(test.seeds) else np.zeros(0, np.int64)
    places, length, item, window = look_up(hashes, suffix_array(hashes, places, int(test.left.max(initial=0))), test)
    text = np.searchsorted(starts, places, "right") - 1
    out: list[tuple[int, list[tuple[int, int]], list[str], int]] = [(int(n) - 1, [], [], 0) for n in np.diff(starts)]
    for t in np.unique(text):
        own = text == t
        begin = places[own] - starts[t]
        spans = merged([*zip(begin.tolist(), (begin + window[own]).tolist())])
        out[t] = out[t][0], spans, sorted({test.names[i] for i in np.unique(item[own]).tolist()}), int(length[own].max())
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans as maximal runs, in order."""
    runs: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if runs and start <= runs[-1][1]:
            runs[-1] = runs[-1][0], max(stop, runs[-1][1])
        else:
            runs.append((start, stop))
    return runs


def blocks(tests: DataFrame, id: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The test set's items as (name, text) in blocks; each is collected alone, when its turn comes. At least one, which may be empty."""
    items = tests.select(F.col(id).cast("string").alias("name"), F.col(text).alias("text")).dropna()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("name")), F.lit(0))).first()[0]
    n = int(total // block_bytes) + 1
    if n > 1:  # read once, not once per block
        items = materialise(items.repartition(F.pmod(F.xxhash64("name", "text"), F.lit(n))), "test-items")
    parts = F.pmod(F.xxhash64("name", "text"), F.lit(n))
    for i in range(n):
        yield [tuple(r) for r in items.where(parts == i).sort("name", "text").collect()]


def matched_blocks(
    docs: DataFrame, tests: DataFrame, window: int, text: str, block_bytes: int, keep: Callable[[DataFrame, Column], DataFrame]
) -> Iterator[DataFrame]:
    """``keep(docs, found)`` for each block of the test set, where ``found`` (see ``FOUND``) looks the block up in ``docs[text]``.

    If there are several, each result is written before the next block is collected, and its broadcast is dropped: the driver and the workers hold
    one block, whatever the size of the test set.
    """
    context, held = docs.sparkSession.sparkContext, None
    for block in blocks(tests, "item_id", text, block_bytes):
        if held is not None:  # there are several: write the one before
            yield materialise(held[0], "block-matches")
            held[1].destroy()
        sent = context.broadcast(TestSet.of(block, window))
        held = keep(docs, matcher(sent)(F.col(text))), sent
    yield held[0]


def matcher(sent: Broadcast) -> Callable[[Column], Column]:
    """The Pandas function that looks up one broadcast block in the texts of each batch."""

    @F.pandas_udf(FOUND)
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = [row for _, shard in shards(texts) for row in match_shard(shard, sent.value)]
        spans = [[{"start": a, "stop": b} for a, b in r[1]] for r in rows]
        return pd.DataFrame(
            {"n_words": [r[0] for r in rows], "spans": spans, "items": [r[2] for r in rows], "longest": [r[3] for r in rows]}
        )

    return found


def match_documents(docs: DataFrame, tests: DataFrame, window: int = 10, id: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``id, n_words, spans, items, longest`` of each document over the whole test set.

    ``n_words``: words of the document; ``spans``: its words inside any occurrence of a window, as
    maximal runs; ``items``: ids of the items with an occurring window; ``longest``: words of the longest
    match. Null and empty texts have no words and no match; items without words, with a null text
    or a null id are left out. Repeated documents are matched each alone; repeated items count once.

    Over one block of the test set nothing is shuffled. Over several, documents get numbers, and only the matches, which are few, meet by number.
    """
    several = int(tests.agg(F.coalesce(F.sum(F.octet_length("text") + F.lit(20)), F.lit(0))).first()[0]) >= block_bytes
    if not several:
        found = matched_blocks(docs, tests, window, "text", 1 << 62, lambda df, c: df.select(id, c.alias("_0")))
        return next(found).select(id, "_0.*")

    rows = materialise(docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id).alias("_id"), "text"), "numbered-texts")
    each = list(matched_blocks(rows, tests, window, "text", block_bytes, lambda df, c: df.select("_row", "_id", c.alias("_0")).select("_row", "_id", "_0.*")))
    hits = reduce(DataFrame.unionAll, [e.where(F.size("items") > 0).drop("_id", "n_words") for e in each])

    @F.pandas_udf("ARRAY<STRUCT<start: INT, stop: INT>>")
    def union(spans: pd.Series) -> pd.Series:
        return spans.map(lambda s: [{"start": a, "stop": b} for a, b in merged([(x["start"], x["stop"]) for x in s])])

    of_row = hits.groupBy(F.col("_row").alias("_hit")).agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max("longest").alias("longest"),
    )
    counted = each[0].select("_row", "_id", "n_words").join(of_row, F.col("_row") == F.col("_hit"), "left")
    return counted.select(
        F.col("_id").alias(id),
        "n_words",
        union(F.coalesce("spans", F.array().cast(of_row.schema["spans"].dataType))).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("longest", F.lit(0)).alias("longest"),
    )


def match_digests(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """``match_documents`` as counts and a digest of the sorted item ids."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + (s["stop"] - s["start"]).cast("bigint"))
    names = F.sha2(F.array_join(F.array_sort("items"), ","), 256)
    return found.select(
        id, "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), names.alias("items_sha256")
    ).withColumn("contaminated", F.col("n_hit") > 0)


def decontaminate(docs: DataFrame, tests: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no window of the test set. Over several blocks, what one leaves is written for the next."""
    context, sent = docs.sparkSession.sparkContext, None
    for block in blocks(tests, "item_id", "text", block_bytes):
        if sent is not None:
            docs = materialise(docs, "clean-so-far")
            sent.destroy()
        sent = context.broadcast(TestSet.of(block, window))
        docs = docs.where(F.size(matcher(sent)(F.col("text"))["items"]) == 0)
    return docs
