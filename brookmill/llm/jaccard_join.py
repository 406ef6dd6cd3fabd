"""N-gram Jaccard join by a token-group matrix.

A document is the set of hashes of its word shingles. Two documents link if their sets' Jaccard similarity reaches a
threshold. Steps, all exact:

1. A census estimates for every shingle (count-min, never too low) whether other documents have it. A document
   with fewer repeated shingles than a link needs cannot link, and goes no further.
2. Equal sets become one class.
3. Classes are partitioned into groups of similar ones: of several min-hash keys, a class takes the most common one.
   Groups are stored in containers, with the groups' token unions; the members of a group are linked there. A key with
   too many classes makes several groups, parts of one family: a few members of each linked part meet in rounds, so
   that a family of near copies is linked before the matrix is asked, and carries one label.
4. The matrix of tokens, groups and labels is spread over slices by token. Each class sends its rarest tokens that also
   stand under other labels, as many as make a miss impossible, and learns which groups share one. Of two labels
   only the smaller one's classes ask: what one label already ties is never paired.
5. The class goes to the containers of these groups. A group is opened only if its union holds as many tokens of
   the class as a link needs; its members are then compared.

Links are edges between classes; connected components give each document its class of near-duplicates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from brookmill.llm.census import (
    ANSWER, BYTES_PER_WORD, Arrays, Chunks, aligned, by_slice, census, count_min, pack, packed, stored, texts_of, unpacked,
)
from brookmill.llm.components import components
from brookmill.llm.decontaminate import FOLD
from brookmill.llm.words import class_table, split_words, window_hashes
from brookmill.session import materialise

SHINGLE = 5
PERCENT = 75
SLICE_ITEMS = 1 << 20
GROUP_LIMIT = 1_024
SPEAKERS = 4  # members of a linked part that meet those of the family's other parts
CONTAINER_TOKENS = 1 << 18
KEYS = 8
INSIDE = class_table(bytes(b for b in range(256) if b != 32 and not 9 <= b <= 13))
_MULTIPLIERS = np.random.default_rng(11).integers(1, 1 << 62, KEYS).astype(np.uint64) * np.uint64(2) + np.uint64(1)

ROWS = pa.schema(
    [
        ("chunk", pa.int64()), ("row", pa.int32()), ("id", pa.int64()), ("n", pa.int64()),
        ("sig", pa.binary()), ("tokens", pa.binary()), ("keys", pa.list_(pa.int64())),
    ]
)
MEMBERS = pa.schema(
    [
        ("class", pa.int64()), ("n", pa.int64()), ("group", pa.int32()), ("comp", pa.int32()), ("tokens", pa.binary()),
        ("family", pa.int64()), ("parts", pa.int32()),
    ]
)
MATCH = np.dtype([("row", "u4"), ("group", "u4"), ("chunk", "i8")])


def needed(n: int, percent: int) -> int:
    """Common tokens that a set of ``n`` needs at least for any link."""
    return -(-percent * n // 100)


def linked(common: np.ndarray, n: int, others: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (n + others - common)


def token_sets(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; of fewer words than a shingle, one hash of them all."""
    words = split_words(texts, INSIDE, FOLD)
    hashes = window_hashes(words.hashes, shingle)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= shingle:
            out.append(np.unique(hashes[a : b - shingle + 1]))
        elif b > a:
            out.append(window_hashes(np.append(words.hashes[a:b], np.uint64(b - a)), b - a + 1))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def min_hashes(tokens: np.ndarray) -> list[int]:
    mixed = tokens ^ (tokens >> np.uint64(31))
    return [int((mixed * m).min() >> np.uint64(1)) for m in _MULTIPLIERS]


@dataclass
class Postings:
    """Sets of a group as an inverted index."""

    tokens: np.ndarray
    owner: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, sets: list[np.ndarray]) -> Postings:
        sizes = np.array([len(s) for s in sets])
        every = np.concatenate(sets)
        order = np.argsort(every, kind="stable")
        return cls(every[order], np.repeat(np.arange(len(sets)), sizes)[order], sizes)

    def common(self, query: np.ndarray, need: int) -> np.ndarray | None:
        """Common tokens with each member; None if the union holds fewer than ``need`` tokens of the query."""
        low = np.searchsorted(self.tokens, query)
        high = np.searchsorted(self.tokens, query, "right")
        counts = high - low
        if np.count_nonzero(counts) < need:
            return None
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
        return np.bincount(self.owner[at], minlength=len(self.sizes))


def local_components(sets: list[np.ndarray], percent: int, leaders_at_most: int = 8) -> np.ndarray:
    """The component of each set within its group, as the number of its first member.

    Most members are tied by a comparison with a few leaders. Only if several components remain, each set
    is compared with all others through the index.
    """
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    leaders: list[int] = []
    for i, own in enumerate(sets):
        for other in leaders:
            common = len(np.intersect1d(own, sets[other], assume_unique=True))
            if linked(common, len(own), len(sets[other]), percent):
                parent[i] = other
                break
        else:
            if len(leaders) < leaders_at_most:
                leaders.append(i)
    if len(sets) > 2 and len({root(i) for i in range(len(sets))}) > 1:
        index = Postings.of(sets)
        for i, own in enumerate(sets):
            common = index.common(own, needed(len(own), percent))
            for j in np.flatnonzero(linked(common, len(own), index.sizes, percent)).tolist():
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return np.array([root(i) for i in range(len(sets))], np.int32)


def sets_of(body: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(t.as_buffer(), np.uint64) for t in body.column("tokens").combine_chunks()]


@dataclass
class Groups:
    """A container: its classes, sorted by group, and where each group begins."""

    table: pa.Table
    sets: list[np.ndarray]
    starts: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> Groups:
        group = table.column("group").to_numpy()
        return cls(table, sets_of(table), np.searchsorted(group, np.arange(int(group.max(initial=-1)) + 2)))

    def matrix(self, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct triples of token, group and label, the label as a row that has it."""
        tokens, groups, rows = [], [], []
        for g, (a, b) in enumerate(zip(self.starts[:-1], self.starts[1:])):
            order = a + np.argsort(label[a:b], kind="stable")
            for same in np.split(order, np.flatnonzero(np.diff(label[order])) + 1):
                union = np.unique(np.concatenate([self.sets[i] for i in same]))
                tokens.append(union)
                groups.append(np.full(len(union), g, np.uint32))
                rows.append(np.full(len(union), same[0]))
        if not tokens:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate(tokens), np.concatenate(groups), np.concatenate(rows)


def labels_of(table: pa.Table, replies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of each class of a container: the label of what is linked so far, and the bits of its number of classes."""
    comp = table.column("comp").to_numpy()
    label, size = table.column("class").to_numpy()[comp], np.bincount(comp)[comp]
    if replies and replies[0]:
        named = np.array(replies[0].decode().replace(",", " ").split(), np.int64).reshape(-1, 3)
        named = named[np.argsort(named[:, 0])]
        at = np.minimum(np.searchsorted(named[:, 0], label), len(named) - 1)
        known = named[at, 0] == label
        label, size = np.where(known, named[at, 1], label), np.where(known, named[at, 2], size)
    return label, np.frexp(size)[1].astype(np.uint8)


def speakers(comp: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` members of each component."""
    order = np.argsort(comp, kind="stable")
    place = np.arange(len(comp)) - np.searchsorted(comp[order], comp[order])
    return np.sort(order[place < most])


def family_links(leading: DataFrame, percent: int, group_limit: int, most: int) -> DataFrame | None:
    """``a, b``: links between labels of ``leading`` in one family; None if no family has several parts.

    In each round a family's speakers are dealt into new parts and linked there, and those of each component
    that results go on, as long as there were several parts and they become fewer. Which links are missed
    decides only about the work left to the matrix.
    """
    rest = leading.groupBy("family").agg(F.count("*").alias("members"))
    now, links, number = leading.select("family", "class", "label", "tokens"), None, 0

    def meet(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("class")
        comp = local_components(sets_of(rows), percent)
        label = rows.column("label").to_numpy()
        tokens = rows.column("tokens").combine_chunks()
        on = np.zeros(len(rows), bool)
        on[speakers(comp, most)] = True
        tokens = pa.compute.if_else(pa.array(on), tokens, pa.scalar(None, pa.binary()))
        return pa.table([rows.column("family"), rows.column("class"), rows.column("label"), pa.array(label[comp]), tokens], names=["family", "class", "label", "tied", "tokens"])

    while not rest.isEmpty():
        parts = F.ceil(F.col("members") / group_limit).cast("int")
        dealt = now.join(rest, "family").withColumn("part", F.pmod(F.xxhash64("class", F.lit(number)), parts))
        met = dealt.select("family", "part", "class", "label", "tokens").groupBy("family", "part")
        met = materialise(met.applyInArrow(meet, "family BIGINT, class BIGINT, label BIGINT, tied BIGINT, tokens BINARY"), "met")
        found = met.where("label <> tied").select(F.col("label").alias("a"), F.col("tied").alias("b"))
        links = found if links is None else links.union(found)
        now, number = met.where("tokens IS NOT NULL").select("family", "class", "label", "tokens"), number + 1
        fewer = now.groupBy("family").agg(F.count("*").alias("left")).join(rest, "family")
        rest = fewer.where((F.col("members") > group_limit) & (F.col("left") <= 0.75 * F.col("members")))
        rest = materialise(rest.select("family", F.col("left").alias("members")), "families")
    return links


def link_documents(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    chunk_bytes: int | None = None,
    slice_items: int = SLICE_ITEMS,
    group_limit: int = GROUP_LIMIT,
) -> tuple[Chunks, DataFrame]:
    """The chunks of ``docs``, and for each row ``chunk, row, id, n, component``.

    ``n`` is the size of the row's set, 0 without words or text. ``component`` is the smallest id reachable by
    links, the row's own if it has none. Rows with equal ids count as one document: what links one of them
    links all. A row with a null id links with nothing and has a null component.
    """
    chunks = pack(docs, text, **({"size": chunk_bytes} if chunk_bytes else {}))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(partitions, chunks.total // BYTES_PER_WORD // slice_items + 1)

    def read(rows: pa.Table):
        """Sets, the first row of the chunk with an equal set, the distinct tokens, and which one each token is.

        A row without words or with a null id links with nothing: it has no signature and is nobody's first.
        """
        sets = token_sets(texts_of(rows, text), shingle)
        first: dict[bytes, int] = {}
        able = [len(s) and doc is not None for s, doc in zip(sets, rows.column(id).to_pylist())]
        sigs = [blake2b(s.tobytes(), digest_size=16).digest() if a else None for s, a in zip(sets, able)]
        copy_of = [first.setdefault(s, i) if s else -1 for i, s in enumerate(sigs)]
        single = [s for i, s in enumerate(sets) if copy_of[i] == i]
        distinct, which = np.unique(np.concatenate([*single, np.zeros(0, np.uint64)]), return_inverse=True)
        return sets, sigs, copy_of, distinct, which

    def occurring(rows: pa.Table, _: list[bytes]) -> Arrays:
        *_, distinct, which = read(rows)
        counts = np.bincount(which, minlength=len(distinct)).clip(max=2)
        return {"key": distinct, "cell": distinct & np.uint64(0xFFFFFFFF), "count": counts}

    repeated = census(
        chunks, occurring, lambda sent: count_min(sent["cell"], sent["count"]) >= 2, {"cell": "u4", "count": "u1"}, slices
    )

    def survive(number: int, rows: pa.Table, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
        sets, sigs, copy_of, distinct, which = read(rows)
        again = aligned(replies[0], "?", distinct, slices)[which]
        ends = np.cumsum([len(s) if copy_of[i] == i else 0 for i, s in enumerate(sets)])
        out: dict[str, list] = {c: [] for c in ROWS.names}
        for i, (own, doc) in enumerate(zip(sets, rows.column(id).to_pylist())):
            sent = copy_of[i] == i and np.count_nonzero(again[ends[i] - len(own) : ends[i]]) >= needed(len(own), percent)
            out["chunk"].append(number)
            out["row"].append(i)
            out["id"].append(doc)
            out["n"].append(len(own))
            out["sig"].append(sigs[i])
            out["tokens"].append(own.tobytes() if sent else None)
            out["keys"].append(min_hashes(own) if sent else None)
        yield pa.RecordBatch.from_pydict(out, schema=ROWS)

    rows = materialise(chunks.map(survive, from_arrow_schema(ROWS), [repeated]), "document-sets")
    named = rows.where("sig IS NOT NULL").groupBy("sig").agg(F.min("id").alias("class"))
    classes = rows.where("tokens IS NOT NULL").dropDuplicates(["sig"]).join(named, "sig").select("class", "n", "tokens", "keys")
    classes = materialise(classes, "classes")
    links = class_links(classes, percent, partitions, slice_items, group_limit)

    placed = rows.join(named, "sig", "left").select("chunk", "row", "id", "n", F.coalesce("class", "id").alias("class"), "sig")
    names = placed.select("id", "class").where("id <> class").distinct()
    several = names.groupBy("id").agg(F.min("class").alias("least"))  # ids of rows with different texts
    twice = names.join(several, "id").where("class <> least").select(F.col("class").alias("a"), F.col("least").alias("b"))
    # A row that is its class's smallest id may stand in another class too.
    also = names.join(rows.select("id", "sig").dropna().join(named, "sig").where("id = class").select("id").distinct(), "id")
    found = components(links.union(twice).union(also.select(F.col("id").alias("a"), F.col("class").alias("b"))))
    return chunks, placed.join(found, F.col("class") == F.col("node"), "left").select(
        "chunk", "row", "id", "n", F.coalesce("component", "class").alias("component"), "sig"
    )


def class_links(classes: DataFrame, percent: int, partitions: int, slice_items: int, group_limit: int) -> DataFrame:
    """``a, b``: links that connect all classes that are connected; see the module's steps 3 to 5."""
    spark = classes.sparkSession
    keyed = classes.select("class", "n", F.posexplode("keys").alias("seed", "key"))
    popular = keyed.groupBy("seed", "key").agg(F.count("*").alias("members"))
    # The key is a hash as good as any: it breaks ties.
    chosen = (
        keyed.join(popular, ["seed", "key"])
        .groupBy("class")
        .agg(F.max(F.struct("members", "seed", "key")).alias("k"))
        .select("class", F.xxhash64("k.seed", "k.key").alias("group"), F.col("k.members").alias("members"))
    )
    tokens = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    count = max(partitions, int(tokens) // CONTAINER_TOKENS + 1)
    parts = F.ceil(F.col("members") / group_limit).cast("int")
    grouped = (
        classes.select("class", "n", "tokens")
        .join(chosen, "class")
        .withColumn("part", F.pmod(F.xxhash64("class"), parts))
        .withColumn("container", F.pmod(F.xxhash64("group", "part"), F.lit(count)))
        .select("container", "group", "part", "class", "n", "tokens", parts.alias("parts"))
    )

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("group", "ascending"), ("part", "ascending"), ("class", "ascending")])
        group, part = rows.column("group").to_numpy(), rows.column("part").to_numpy()
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (part[1:] != part[:-1])])
        number = np.cumsum(new) - 1
        sets = sets_of(rows)
        starts = np.append(np.flatnonzero(new), len(rows))
        comp = np.concatenate([local_components(sets[a:b], percent) + a for a, b in zip(starts[:-1], starts[1:])])
        body = pa.table(
            [
                rows.column("class"), rows.column("n"), pa.array(number, pa.int32()), pa.array(comp, pa.int32()), rows.column("tokens"),
                rows.column("group"), rows.column("parts"),
            ],
            schema=MEMBERS,
        )
        return pa.table({"chunk": rows.column("container")[:1], "bytes": pa.array([rows.nbytes]), "body": pa.array([packed(body)], pa.binary())})

    containers = stored(grouped.groupBy("container").applyInArrow(build, "chunk BIGINT, bytes BIGINT, body BINARY"), classes.schema, partitions)
    slices = max(partitions, int(tokens) // slice_items + 1)

    def own_links(number: int, table: pa.Table, _: list[bytes]) -> Iterator[pa.RecordBatch]:
        ids, comp = table.column("class").to_numpy(), table.column("comp").to_numpy()
        tied = np.flatnonzero(comp != np.arange(len(comp)))
        yield pa.RecordBatch.from_pydict({"a": ids[tied], "b": ids[comp[tied]]}, schema=EDGES)

    most = max(1, min(SPEAKERS, group_limit // 8))

    def lead(number: int, table: pa.Table, _: list[bytes]) -> Iterator[pa.RecordBatch]:
        """Of each component of several classes in a family of several parts: its size, and its speakers."""
        ids, comp = table.column("class").to_numpy(), table.column("comp").to_numpy()
        size = np.bincount(comp, minlength=len(comp))
        chosen = speakers(comp, most)
        chosen = chosen[(size[comp[chosen]] > 1) & (table.column("parts").to_numpy()[chosen] > 1)]
        own = table.take(pa.array(chosen))
        first = comp[chosen] == chosen
        fields = {"chunk": np.full(len(chosen), number), "class": ids[chosen], "label": ids[comp[chosen]], "size": np.where(first, size[comp[chosen]], 0)}
        fields |= {c: own.column(c).combine_chunks() for c in ("family", "tokens")}
        yield pa.RecordBatch.from_pydict(fields, schema=LEAD)

    leading = materialise(containers.map(lead, from_arrow_schema(LEAD)), "leading")
    family = family_links(leading, percent, group_limit, most)
    names: list[DataFrame] = []
    if family is not None:
        heads = leading.where("size > 0").select("chunk", "label", "size").join(components(family), F.col("label") == F.col("node"))
        sizes = heads.groupBy("component").agg(F.sum("size").alias("total"))
        name = F.expr("CAST(concat(label, ' ', component, ' ', total, ',') AS BINARY)")
        names = [materialise(heads.join(sizes, "component").select("chunk", F.lit(0).alias("slice"), name.alias("answer")), "names")]

    def in_groups(table: pa.Table, replies: list[bytes]) -> Arrays:
        label, _ = labels_of(table, replies)
        tokens, groups, rows = Groups.of(table).matrix(label)
        order = np.lexsort((groups, tokens))
        tokens, groups, label = tokens[order], groups[order], label[rows[order]]
        new = np.append(True, tokens[1:] != tokens[:-1])[: len(tokens)]
        starts = np.flatnonzero(new)
        counts = np.add.reduceat((new | np.append(True, groups[1:] != groups[:-1])[: len(tokens)]).astype(np.uint32), starts)
        low, high = np.minimum.reduceat(label, starts), np.maximum.reduceat(label, starts)
        return {"key": tokens[starts], "groups": counts | np.where(low < high, SEVERAL, np.uint32(0)), "label": low}

    def total(sent: Arrays) -> np.ndarray:
        """In how many groups a token stands; 1 if all its classes have one label."""
        order = np.argsort(sent["key"], kind="stable")
        key, groups, label = sent["key"][order], sent["groups"][order], sent["label"][order]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        several = np.bitwise_or.reduceat(groups, starts) & SEVERAL > 0
        several |= np.minimum.reduceat(label, starts) < np.maximum.reduceat(label, starts)
        count = np.where(several, np.add.reduceat((groups & ~SEVERAL).astype(np.uint64), starts), 1)
        out = np.empty(len(order), np.uint32)
        out[order] = np.repeat(count, np.diff(np.append(starts, len(key))))
        return out

    frequency = census(containers, in_groups, total, {"key": "u8", "groups": "u4", "label": "i8"}, slices, names)

    def offers(number: int, table: pa.Table, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
        """To each slice: tokens with their groups (kind 0), and the rare tokens of each class (kind 1)."""
        held = Groups.of(table)
        label, bits = labels_of(table, replies[1:])
        tokens, groups, rows = held.matrix(label)
        distinct = np.unique(tokens)
        known = aligned(replies[0], "u4", distinct, slices)
        shared = known[np.searchsorted(distinct, tokens)] > 1
        keys, owners, kinds = [tokens[shared]], [groups[shared]], [np.zeros(np.count_nonzero(shared), np.uint8)]
        holders = [rows[shared]]
        for row, own in enumerate(held.sets):
            rarity = known[np.searchsorted(distinct, own)]
            elsewhere = np.flatnonzero(rarity > 1)
            # Of the tokens, rarest first, any link shares one among the first n - needed + 1; those of one label come first.
            first = len(elsewhere) - needed(len(own), percent) + 1
            if first > 0:
                chosen = own[elsewhere[np.lexsort((own[elsewhere], rarity[elsewhere]))[:first]]]
                keys.append(chosen)
                owners.append(np.full(len(chosen), row, np.uint32))
                kinds.append(np.ones(len(chosen), np.uint8))
                holders.append(np.full(len(chosen), row))
        key, owner, kind, holder = np.concatenate(keys), np.concatenate(owners), np.concatenate(kinds), np.concatenate(holders)
        group_of = table.column("group").to_numpy().astype(np.uint32)
        home = np.where(kind == 1, group_of[owner] if len(group_of) else 0, owner)
        order, starts = by_slice(key, slices)
        for part in range(slices):
            at = order[starts[part] : starts[part + 1]]
            if len(at):
                fields = {"key": key[at], "owner": owner[at], "kind": kind[at], "home": home[at], "bits": bits[holder[at]], "label": label[holder[at]]}
                yield pa.RecordBatch.from_pydict(
                    {"chunk": [number], "slice": [part]} | {c: [np.ascontiguousarray(v).tobytes()] for c, v in fields.items()}, schema=OFFER
                )

    def matched(rows: pa.Table) -> pa.Table:
        def column(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(rows.column(name).to_pylist()), kind)

        sizes = np.array([len(b) // 8 for b in rows.column("key").to_pylist()])
        chunk = np.repeat(rows.column("chunk").to_numpy(), sizes)
        key, owner, kind, home = column("key", "u8"), column("owner", "u4"), column("kind", "u1"), column("home", "u4")
        # A link is found from either side. The classes of a label ask those of larger ones, so that a large label is not spread.
        place, rank = ranked(key, column("bits", "u1"), column("label", "i8"))
        store = np.flatnonzero(kind == 0)
        store = store[np.argsort(place[store], kind="stable")]
        ask = np.flatnonzero(kind == 1)
        low, high = np.searchsorted(place[store], place[ask], "right"), np.searchsorted(place[store], place[ask] + rank[ask])
        found: dict[int, list[np.ndarray]] = {}
        for a in range(0, len(ask), 4_096):  # bounded expansions
            counts = (high - low)[a : a + 4_096]
            query = np.repeat(ask[a : a + 4_096], counts)
            at = np.arange(len(query)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low[a : a + 4_096], counts)
            group = store[at]
            other = (chunk[query] != chunk[group]) | (home[query] != home[group])
            query, group = query[other], group[other]
            pairs = np.empty(len(query), MATCH)
            pairs["row"], pairs["group"], pairs["chunk"] = owner[query], owner[group], chunk[group]
            for c in np.unique(chunk[query]).tolist():
                found.setdefault(c, []).append(np.unique(pairs[chunk[query] == c]))
        answers = [np.unique(np.concatenate(p)).tobytes() for p in found.values()]
        part = rows.column("slice")[0].as_py()
        return pa.table({"chunk": pa.array(list(found), pa.int64()), "slice": pa.array([part] * len(found), pa.int32()), "answer": pa.array(answers, pa.binary())})

    candidates = containers.map(offers, from_arrow_schema(OFFER), [frequency, *names]).groupBy("slice").applyInArrow(matched, ANSWER)

    def visit(number: int, table: pa.Table, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
        """Each class, with its tokens, to the containers of the groups that share one."""
        pairs = np.unique(np.frombuffer(replies[0], MATCH))
        for target in np.unique(pairs["chunk"]).tolist():
            own = pairs[pairs["chunk"] == target]
            guests, starts = np.unique(own["row"], return_index=True)  # a class comes once, whatever the groups
            groups = pa.ListArray.from_arrays(pa.array(np.append(starts, len(own)), pa.int32()), pa.array(own["group"]))
            visitors = table.select(["class", "tokens"]).take(pa.array(guests)).append_column("group", groups)
            yield pa.RecordBatch.from_pydict({"chunk": [target], "slice": [0], "answer": [packed(visitors)]}, schema=VISIT)

    visits = containers.map(visit, from_arrow_schema(VISIT), [candidates])

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A container comes first, then its visitors, row by row."""
        held, indexes = None, {}
        for batch in batches:
            a, b = [], []
            for i in range(batch.num_rows):
                body = unpacked(batch.column(1)[i].as_py())
                if batch.column(0)[i].as_py() == 0:
                    held, indexes = Groups.of(body), {}
                    ids, comp = held.table.column("class").to_numpy(), held.table.column("comp").to_numpy()
                    continue
                guests = body
                for guest, groups, own in zip(guests.column("class").to_pylist(), guests.column("group").to_pylist(), sets_of(guests)):
                    for group in groups:
                        start, stop = held.starts[group], held.starts[group + 1]
                        if group not in indexes:
                            indexes[group] = Postings.of(held.sets[start:stop])
                        common = indexes[group].common(own, needed(len(own), percent))
                        if common is None:
                            continue
                        hits = np.flatnonzero(linked(common, len(own), indexes[group].sizes, percent))
                        for first in np.unique(comp[start + hits]).tolist():  # one link to each local component
                            a.append(guest)
                            b.append(int(ids[first]))
            yield pa.RecordBatch.from_pydict({"a": a, "b": b}, schema=EDGES)

    # Streamed in order, not joined: a join would repeat the container for each of its visitors.
    met = containers.table.select("chunk", F.lit(0).alias("visitor"), "body").union(visits.select("chunk", F.lit(1), "answer"))
    met = met.repartition(partitions, "chunk").sortWithinPartitions("chunk", "visitor")
    across = met.select("visitor", "body").mapInArrow(opened, from_arrow_schema(EDGES))
    links = containers.map(own_links, from_arrow_schema(EDGES)).union(across)
    return links if family is None else links.union(family)


def ranked(key: np.ndarray, bits: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that sort entries by key, then by size and label; and from each place the steps to where the next key begins."""
    order = np.lexsort((label, bits))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(np.append(False, (label[order][1:] != label[order][:-1]) | (bits[order][1:] != bits[order][:-1]))[: len(order)])
    width = int(rank.max(initial=0)) + 1
    _, which = np.unique(key, return_inverse=True)
    return which * width + rank, width - rank


EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])
OFFER = pa.schema([("chunk", pa.int64()), ("slice", pa.int32()), *[(c, pa.binary()) for c in ("key", "owner", "kind", "home", "bits", "label")]])
LEAD = pa.schema([(c, pa.int64()) for c in ("chunk", "class", "label", "size", "family")] + [("tokens", pa.binary())])
SEVERAL = np.uint32(1 << 31)  # marks a count of groups with several labels
VISIT = pa.schema([("chunk", pa.int64()), ("slice", pa.int32()), ("answer", pa.binary())])


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``id, n_shingles, component_id`` of each row; see ``link_documents``."""
    _, rows = link_documents(docs.select(F.col(id), F.col(text)), id, text, **how)
    return rows.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, all columns, that are the first of their component: by id, then by set and place.

    Rows without words, and rows with a null id, stay. Texts are not shuffled: the decisions go to the chunks.
    """
    chunks, rows = link_documents(docs, id, text, **how)
    rows = materialise(rows, "linked-rows")
    best = rows.where("n > 0 AND id IS NOT NULL").groupBy("component").agg(F.min(F.struct("id", "sig", "chunk", "row")).alias("best"))
    stay = best.select("best.chunk", "best.row").union(rows.where("n = 0 OR id IS NULL").select("chunk", "row"))
    answers = stay.select("chunk", F.col("row").alias("slice"), F.expr("CAST(concat('', row, ',') AS BINARY)").alias("answer"))
    schema = docs.schema

    def kept(number: int, table: pa.Table, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
        chosen = [int(x) for x in replies[0].decode().split(",") if x]
        yield from table.take(pa.array(chosen, pa.int64())).combine_chunks().to_batches()

    return chunks.map(kept, schema, [answers])
