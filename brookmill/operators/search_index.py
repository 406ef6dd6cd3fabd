"""Regular-expression search over an index of trigrams.

The index has a row per distinct trigram of 64 documents with neighbouring ids, in lower case, with a bit for each that has it. It is ordered by
trigram, so that a search reads only the row groups of the trigrams it asks for. A pattern asks for those of the literal runs that every match
contains. Only documents that have all of them are tried; a pattern without such a run is tried on all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from brookmill.functions.text import char_grams
from brookmill.operators.dashboard import regex_search
from brookmill.operators.skew import BROADCAST_BYTES, fits
from brookmill.session import materialise

GRAM = 3
BITS = 6
PLACES = 1 << BITS
INTEGERS = (ByteType(), ShortType(), IntegerType(), LongType())
CLASSES = "bBdDsSwWhHvV"  # escapes that stand for a place or one character of a class


def required_runs(pattern: str) -> list[str]:
    """Literal runs, in lower case, that every match contains as they stand; empty if none can be told.

    Reads the common part of the syntax: what is in groups and classes, optional, or repeated is passed over, and anything else that is
    special gives up. Runs hold ASCII only, where lower case is one character for one.
    """
    if pattern.startswith("(?i)"):
        pattern = pattern[4:]
    if any(mark in pattern for mark in (r"\Q", r"\p", r"\P", r"\x", r"\u", r"\c", r"\0", r"\k")) or "(?" in pattern.replace("(?:", ""):
        return []
    runs, run, i, depth = [], "", 0, 0
    while i < len(pattern):
        c, step, literal = pattern[i], 1, ""
        if c == "\\":
            if i + 1 == len(pattern) or (pattern[i + 1].isalnum() and pattern[i + 1] not in CLASSES):
                return []
            literal, step = ("", 2) if pattern[i + 1] in CLASSES else (pattern[i + 1], 2)
        elif c == "[":
            end = pattern.find("]", i + (3 if pattern[i + 1 : i + 2] == "^" else 2))
            body = pattern[i + 1 : end]
            if end < 0 or "[" in body or "\\" in body or "&&" in body:
                return []
            step = end - i + 1
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
        elif c == "|" and depth == 0:
            return []
        elif c not in ".^$?*+{}|":
            literal = c
        if c in "?*+{" and depth == 0:  # of what stands before
            if c != "+":
                run = run[:-1]
            if c == "{":
                end = pattern.find("}", i)
                if end < 0:
                    return []
                step = end - i + 1
        if depth == 0 and literal and literal.isascii():
            run += literal.lower()
        else:
            runs.append(run)
            run = ""
        i += step
    return [r for r in [*runs, run] if len(r) >= GRAM] if depth == 0 else []


def required_grams(pattern: str) -> list[str]:
    return sorted({run[i : i + GRAM] for run in required_runs(pattern) for i in range(len(run) - GRAM + 1)})


def build_index(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``gram, block, bits`` of every distinct trigram of the texts of ids ``64 * block`` to ``64 * block + 63``, written in the order of the trigrams.

    Bit i of ``bits`` is set if the text of id ``64 * block + i`` has the trigram. Null texts have none; ids are whole numbers and a key. Far apart,
    they share no rows, which costs rows but no results. Texts are shuffled by block, so that trigrams are counted once, where they are found.
    """
    if docs.schema[id].dataType not in INTEGERS:
        raise ValueError(f"{id}: ids are whole numbers")
    number = F.col(id).cast("bigint")
    blocks = docs.select(F.shiftright(number, BITS).alias("block"), number.bitwiseAND(PLACES - 1).cast("int").alias("_place"), F.lower(text).alias("_lower")).repartition("block")
    grams = blocks.select("block", F.expr("shiftleft(1L, _place)").alias("_bit"), F.explode(char_grams(F.col("_lower"), GRAM)).alias("gram"))
    rows = materialise(grams.groupBy("gram", "block").agg(F.bit_or("_bit").alias("bits")), "blocks")  # ranges read their rows twice
    return materialise(rows.repartitionByRange("gram", "block").sortWithinPartitions("gram", "block"), "trigrams")


def candidates(index: DataFrame, grams: Sequence[str], id: str = "doc_id") -> DataFrame:
    """Ids of the documents that have all of ``grams``."""
    postings = index.where(F.col("gram").isin(list(grams))).groupBy("block").agg(F.count("*").alias("_n"), F.bit_and("bits").alias("_bits"))
    common = postings.where((F.col("_n") == len(grams)) & (F.col("_bits") != 0))
    places = common.select("block", "_bits", F.explode(F.array(*map(F.lit, range(PLACES)))).alias("_place")).where(F.getbit("_bits", F.col("_place")) == 1)
    return places.select((F.shiftleft("block", BITS) + F.col("_place")).alias(id))


def indexed_search(docs: DataFrame, index: DataFrame, pattern: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of ``dashboard.regex_search``, of documents that the index cannot rule out."""
    grams = required_grams(pattern)
    if not grams:
        return regex_search(docs, pattern)
    found = materialise(candidates(index, grams), "candidates")
    few = F.broadcast(found) if fits(found, broadcast_bytes) else found
    return regex_search(docs.join(few, "doc_id", "left_semi"), pattern)


def page(hits: DataFrame, number: int, size: int) -> DataFrame:
    """Page ``number`` (from 0) of the hits in the order of their ids, and the ``total`` number of hits on each row."""
    total = hits.agg(F.count("*")).scalar()
    return hits.orderBy("doc_id").offset(number * size).limit(size).withColumn("total", total)
