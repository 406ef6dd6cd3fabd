"""Numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType


def mib(length: str | Column) -> Column:
    """Bytes to MiB with one decimal; ties go to the even digit, as in ``f"{x:.1f}"``."""
    column = F.col(length) if isinstance(length, str) else length
    return F.bround(column / F.lit(1024 * 1024), 1)


def nearest(size: Column) -> Column:
    """The nearest whole number to a double that is not negative; a half goes up."""
    whole = F.floor(size)
    return whole + F.when(size - whole >= 0.5, 1).otherwise(0)


def rounded(column: Column, digits: int = 6) -> Column:
    """Round a double half away from zero, in double arithmetic as other SQL engines do.

    Spark's ``round`` goes through the printed decimal, which differs where that ends in 5.
    """
    scale = float(10**digits)
    size = F.abs(column) * scale
    return F.when(size < 2.0**52, F.signum(column) * nearest(size) / scale).otherwise(column)


def cents(column: Column) -> Column:
    """An amount in whole cents, rounded likewise."""
    size = nearest(F.abs(column) * 100)
    return F.when(column >= 0, size).otherwise(-size)


def backoff_delay(
    attempt: Column, base: float = 1.0, factor: float = 2.0, cap: float = 60.0
) -> Column:
    """Exponential delay before the next try: ``base * factor ** (attempt - 1)``, at most ``cap``."""
    return F.least(F.lit(float(cap)), F.lit(float(base)) * F.pow(F.lit(float(factor)), attempt - 1))


def slot_seconds(ts: str, data_type: DataType) -> Column:
    """Whole seconds since a fixed origin, rounded down, free of the session time zone."""
    if isinstance(data_type, TimestampNTZType):
        # The first day Spark supports: later times are positive, so the cast rounds down.
        since = F.col(ts) - F.expr("TIMESTAMP_NTZ'0001-01-01 00:00:00'")
        return since.cast("interval second").cast("bigint")
    return F.unix_seconds(ts)


def elapsed(end: Column, start: Column, data_type: DataType) -> Column:
    """Time that passed, as an interval; for zoned times also over a clock change."""
    if isinstance(data_type, TimestampNTZType):
        return end - start
    return F.expr("INTERVAL '0.000001' SECOND") * (F.unix_micros(end) - F.unix_micros(start))


EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def instant(ts: Column) -> Column:
    """A time without a zone as the instant at which clocks in UTC show it, whatever the session's zone."""
    since = (ts - F.expr(EPOCH)).cast("interval second")
    return F.timestamp_micros((since.cast("decimal(18,6)") * F.lit(1_000_000)).cast("bigint"))


def wall_clock(at: Column) -> Column:
    """The inverse of ``instant``."""
    return F.expr(EPOCH) + F.expr("INTERVAL '0.000001' SECOND") * F.unix_micros(at)
