"""Document fingerprints: SimHash by column functions, and a search for near ones by block tables.

Every distinct word of a text votes with its weight, its length up to 16, for or against each of 128 bits, as the
bits of its hash say. No Python runs here. Two bits are counted in one BIGINT: the weights of a text add up to no
more than its bytes, fewer than 2**31, so that the lower count never reaches the upper one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brookmill.session import materialise

BITS = 128
PAIRED = 0x0000000100000001
HALF = 0xFFFFFFFF
CELL_BITS = 8
LEVEL_BITS = 12
BROADCAST_ROWS = 100_000


def vote_columns(term: Column) -> list[Column]:
    """Sums whose lower and upper halves are the weights for two of the bits, and at last the sum of all weights."""
    weight = F.least(F.length(term), F.lit(16)).cast("bigint")
    votes = []
    for word in range(2):
        hashed = F.xxhash64(F.lit(word), term)
        votes += [
            F.sum(F.shiftrightunsigned(hashed, b).bitwiseAND(F.lit(PAIRED)) * weight).alias(f"_v{word}_{b}") for b in range(32)
        ]
    return [*votes, F.sum(weight).alias("_all")]


def majority(word: int) -> Column:
    """64 bits of a fingerprint from the sums: a bit is set if more than half of the weight is for it."""

    def bit(b: int) -> Column:
        both = F.col(f"_v{word}_{b % 32}")
        part = F.shiftright(both, 32) if b >= 32 else both.bitwiseAND(F.lit(HALF))
        return F.when(part * 2 > F.col("_all"), F.shiftleft(F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))

    return reduce(Column.bitwiseOR, [bit(b) for b in range(64)])


def terms(text: Column) -> Column:
    return F.explode(F.array_distinct(F.split(F.lower(text), r"\s+")))


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys, _hi, _lo``: the fingerprint of each row; ``keys`` must tell the rows apart.

    A null or empty text has the fingerprint 0. If the rows are partitioned by one of the keys, nothing is shuffled.
    """
    exploded = texts.select(*keys, terms(F.coalesce(F.col(text), F.lit(""))).alias("_term"))
    votes = exploded.groupBy(*keys).agg(*vote_columns(F.col("_term")))
    return votes.select(*keys, majority(0).alias("_hi"), majority(1).alias("_lo"))


def as_text(hi: Column, lo: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def likeness(hi: Column, lo: Column, other_hi: Column, other_lo: Column) -> Column:
    """1 less the share of differing bits."""
    return 1 - (F.bit_count(hi.bitwiseXOR(other_hi)) + F.bit_count(lo.bitwiseXOR(other_lo))) / F.lit(float(BITS))


def preceding_cells(cells: DataFrame) -> DataFrame:
    """``cell, before``: the largest ``last`` of all smaller cells, for rows ``cell, last``; null for the smallest cell.

    Cells are ordered within parents of at most 4096; the first of a parent asks the level above. So
    no task orders more than 4096 rows, however many cells there are.
    """
    cells = materialise(cells, "cells")
    if cells.limit((1 << LEVEL_BITS) + 1).count() <= 1 << LEVEL_BITS:
        return cells.select("cell", F.lag("last").over(W.orderBy("cell")).alias("before"))
    parented = cells.withColumn("_parent", F.shiftright("cell", LEVEL_BITS))
    own = W.partitionBy("_parent").orderBy("cell")
    above = preceding_cells(parented.groupBy(F.col("_parent").alias("cell")).agg(F.max("last").alias("last")))
    return (
        parented.withColumn("_left", F.lag("last").over(own))
        .join(above.withColumnsRenamed({"cell": "_parent", "before": "_above"}), "_parent", "left")
        .select("cell", F.coalesce("_left", "_above").alias("before"))
    )


def edited_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each document and of its edited text, whose last half is replaced by the next document's beginning.

    The next document is the one with the next smaller id, after the smallest the largest; repeated ids
    follow each other by text, and a null id comes after all others. One output row for each input row:
    ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    Texts pass one shuffle, by cells of 256 consecutive ids. A cell also gets the last row of the cell before it.
    Everything else, votes included, stays in that partitioning.
    """
    key = F.coalesce(F.col(id).cast("bigint"), F.lit(-(1 << 63)))
    rows = docs.select(
        F.col(id).alias("_id"), key.alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text")
    ).withColumn("_cell", F.shiftright("_key", CELL_BITS))

    cells = rows.groupBy(F.col("_cell").alias("cell")).agg(F.max("_key").alias("last"))
    before = materialise(preceding_cells(cells), "cells-before")
    largest = rows.agg(F.max("_key")).first()[0]
    wanted = before.select(
        F.coalesce("before", F.lit(largest).cast("bigint")).alias("_key"), F.col("cell").alias("_to")
    )
    if wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    guests = rows.join(wanted, "_key").select("_id", "_key", "_text", F.col("_to").alias("_cell"), F.lit(0).alias("_own"))
    both = rows.select("_id", "_key", "_text", "_cell", F.lit(1).alias("_own")).unionByName(guests)

    order = W.partitionBy("_cell").orderBy("_own", "_key", "_text")
    n = F.length("_text").cast("bigint")
    half = F.floor(n / 2).cast("int")
    placed = both.select(
        "*", F.row_number().over(order).alias("_place"), F.lag("_text", 1, "").over(order).alias("_next")
    ).select(
        "_cell", "_place", "_own", "_id", "_text", n.alias("n_chars"),
        F.concat(F.col("_text").substr(F.lit(1), n.cast("int") - half), F.col("_next").substr(F.lit(1), half)).alias("_edited"),
    )
    keys = ["_cell", "_place", "_own", "_id", "n_chars", "edited_sha256", "_which"]
    versions = placed.select(
        "_cell", "_place", "_own", "_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
        F.inline(F.array(
            F.struct(F.lit(0).alias("_which"), F.col("_text").alias("_version")),
            F.struct(F.lit(1).alias("_which"), F.col("_edited").alias("_version")),
        )),
    ).where("_own = 1 OR _which = 0")

    def of(which: int, word: str) -> Column:
        return F.max(F.when(F.col("_which") == which, F.col(word)))

    paired = fingerprints(versions, keys, "_version").groupBy(*keys[:-1]).agg(
        of(0, "_hi").alias("_hi"), of(0, "_lo").alias("_lo"), of(1, "_hi").alias("_ehi"), of(1, "_lo").alias("_elo")
    )
    line = W.partitionBy("_cell").orderBy("_place")
    return (
        paired.select("*", F.lag("_hi").over(line).alias("_nhi"), F.lag("_lo").over(line).alias("_nlo"))
        .where("_own = 1")
        .select(
            F.col("_id").alias(id), "n_chars", "edited_sha256",
            as_text(F.col("_hi"), F.col("_lo")).alias("fingerprint"),
            as_text(F.col("_ehi"), F.col("_elo")).alias("edited_fingerprint"),
            likeness(F.col("_hi"), F.col("_lo"), F.col("_ehi"), F.col("_elo")).alias("near_edited"),
            likeness(F.col("_hi"), F.col("_lo"), F.col("_nhi"), F.col("_nlo")).alias("near_next"),
        )
    )


def near_fingerprints(marked: DataFrame, radius: int = 3) -> DataFrame:
    """``left, right, distance``: all pairs of different fingerprints (``fingerprint``, 32 hex digits) within ``radius`` bits.

    Equal fingerprints are one class and appear once; documents join it by their own fingerprint. The bits are cut
    into ``radius + 1`` blocks: of a pair within the radius, at least one block is equal. Each block has a table whose
    key is that block, put first; the first equal block of a pair reports it. Null fingerprints are left out.
    """
    if not 0 <= radius < 16:
        raise ValueError("radius must be 0 to 15")
    n = radius + 1
    edges = [32 * i // n for i in range(n + 1)]  # in hex digits
    blocks = F.array(*[F.substring("fingerprint", a + 1, b - a) for a, b in zip(edges, edges[1:])])
    classes = marked.select("fingerprint").dropna().distinct()
    tabled = classes.select("fingerprint", blocks.alias("_blocks")).select(
        "*", F.posexplode("_blocks").alias("_no", "_block")
    )
    other = tabled.withColumnsRenamed({"fingerprint": "right", "_blocks": "_others"})
    pairs = tabled.join(other, ["_no", "_block"]).where(F.col("fingerprint") < F.col("right"))
    same = F.transform(F.arrays_zip("_blocks", "_others"), lambda x: x["_blocks"] == x["_others"])

    def bits(column: str, at: int) -> Column:
        return F.conv(F.substring(column, at, 8), 16, 10).cast("bigint")

    distance = sum(
        (F.bit_count(bits("fingerprint", at).bitwiseXOR(bits("right", at))) for at in (1, 9, 17, 25)), F.lit(0)
    )
    return (
        pairs.where(F.array_position(same, True) == F.col("_no") + 1)
        .select(F.col("fingerprint").alias("left"), "right", distance.cast("int").alias("distance"))
        .where(F.col("distance") <= radius)
    )
