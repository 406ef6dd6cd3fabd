"""Sessions of a user's events, split where the pause exceeds a gap.

Two events in the same slot of ``gap`` seconds are less than a gap apart, so no session starts inside a
slot. Sessions therefore follow from the first and last time of each (user, slot), which the map tasks
combine: a user with a third of all rows shrinks to one row per slot of the covered time. Only
these slot rows are ordered by a window.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from brookmill.functions.numbers import elapsed, slot_seconds
from brookmill.operators.skew import BROADCAST_BYTES, lookup, number_rows
from brookmill.session import materialise

SIX_HOURS = 6 * 3600


def _slot(df: DataFrame, ts: str, gap: int) -> Column:
    return F.floor(slot_seconds(ts, df.schema[ts].dataType) / gap)


def _slots(df: DataFrame, user: str, ts: str, gap: int, *totals: Column) -> DataFrame:
    """One row per (user, slot) with its ``session_no``."""
    slots = (
        df.where(F.col(ts).isNotNull() & F.col(user).isNotNull())
        .groupBy(user, _slot(df, ts, gap).alias("_slot"))
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), *totals)
    )
    by_user = W.partitionBy(user).orderBy("_slot")
    pause = elapsed(F.col("_first"), F.lag("_last").over(by_user), df.schema[ts].dataType)
    starts = F.coalesce((pause > F.lit(timedelta(seconds=gap))).cast("bigint"), F.lit(1))
    return slots.withColumn("_starts", starts).withColumn(
        "session_no", F.sum("_starts").over(by_user.rowsBetween(W.unboundedPreceding, 0))
    )


def sessionize(
    events: DataFrame,
    user: str = "user_id",
    ts: str = "ts",
    id: str = "event_id",
    gap: int = SIX_HOURS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add the 1-based ``session_no``; a session starts when the pause is longer than ``gap`` seconds.

    Rows without a user or a time are kept, with a null ``session_no``.
    """
    numbered = materialise(
        _slots(events, user, ts, gap, F.count("*").alias("_n")).select(
            user, "_slot", "_n", "session_no"
        ),
        "session-slots",
    )
    slotted = events.withColumn("_slot", _slot(events, ts, gap))
    return lookup(slotted, numbered, [user, "_slot"], "_n", [id], broadcast_bytes).drop("_slot")


def session_summary(
    events: DataFrame,
    user: str = "user_id",
    ts: str = "ts",
    event_type: str = "event_type",
    gap: int = SIX_HOURS,
) -> DataFrame:
    """``start, end, n, seconds, purchases`` of each session, from the slots alone."""
    slots = _slots(
        events,
        user,
        ts,
        gap,
        F.count("*").alias("_n"),
        F.count_if(F.col(event_type) == "purchase").alias("_purchases"),
    )
    kind = events.schema[ts].dataType
    return (
        slots.groupBy(user, "session_no")
        .agg(
            F.min("_first").alias("start"),
            F.max("_last").alias("end"),
            F.sum("_n").alias("n"),
            F.sum("_purchases").alias("purchases"),
        )
        .withColumn("seconds", _seconds(kind))
    )


def _seconds(kind: DataType) -> Column:
    """The length of a session ``start`` to ``end``."""
    return elapsed(F.col("end"), F.col("start"), kind).cast("interval second").cast("decimal(18,6)").cast("double")


def numbered_sessions(closed: DataFrame, user: str = "user_id") -> DataFrame:
    """Sessions as a stream gives them, in the form of ``session_summary``: numbered by user, with their length."""
    numbered = number_rows(closed, [user], ["start"], "session_no")
    return numbered.withColumn("seconds", _seconds(closed.schema["start"].dataType))
