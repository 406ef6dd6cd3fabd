"""Text column functions, all JVM expressions."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


# All characters that count as white space in Python, so that ``strip`` equals ``str.strip``.
WHITE_SPACE = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())


def strip(column: Column) -> Column:
    """Remove white space of every kind on both sides (plain ``trim`` removes blanks only)."""
    return F.btrim(column, F.lit(WHITE_SPACE))


def contains_any(column: Column, keywords: Sequence[str]) -> Column:
    """True if any keyword is a substring, case-sensitive."""
    return reduce(Column.__or__, [column.contains(word) for word in keywords], F.lit(False))


def is_set(column: Column) -> Column:
    """False for null and for the empty string."""
    return F.coalesce(column, F.lit("")) != ""


def join_list(column: Column) -> Column:
    return F.concat_ws(", ", column)


def words(column: Column) -> Column:
    """Lower-case runs of letters and digits of any script."""
    return F.array_remove(F.split(F.lower(column), r"[^\p{L}\p{N}]+"), "")


def char_grams(column: Column, n: int = 2) -> Column:
    """All runs of ``n`` characters in order; empty for a shorter text.

    Each match looks ahead at ``n`` characters and moves on by one, in one pass of generated code.
    """
    return F.regexp_extract_all(column, F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1))


def as_json(columns: Sequence[str]) -> Column:
    """The given columns as one JSON object."""
    return F.to_json(F.struct(*columns))
