"""Sessions on a stream."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmill.functions.numbers import instant, wall_clock
from brookmill.streaming.replay import LANES, STATE_PARTS, run_to_end

SESSIONS = "user_id BIGINT, start TIMESTAMP_NTZ, end TIMESTAMP_NTZ, n BIGINT, purchases BIGINT"


def stream_sessions(events: DataFrame, gap: str = "6 hours", lateness: str = "1 hour") -> DataFrame:
    """``user_id, start, end, n, purchases`` of each closed session of a stream (or of a batch).

    A watermark needs an instant: times without a zone are taken as UTC and given back likewise. ``end`` is the time of the
    last event; a pause of exactly ``gap`` goes on, as in ``operators.sessions``. In append mode, a session appears once the watermark
    has passed its end by the gap. Rows without a user move the watermark as well; their sessions are those of a null user.
    """
    timed = events.select("user_id", "event_type", instant(F.col("ts")).alias("_at")).withWatermark("_at", lateness)
    return (
        timed.groupBy("user_id", F.session_window("_at", gap).alias("w"))
        .agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "purchase").alias("purchases"), F.max("_at").alias("_last"))
        .select("user_id", wall_clock(F.col("w.start")).alias("start"), wall_clock(F.col("_last")).alias("end"), "n", "purchases")
    )


def run_sessions(events: DataFrame, out: str, checkpoint: str, gap_s: int, lateness: str = "1 hour", lane: int | None = None) -> None:
    """Write the sessions that close while the source, as it is now, is read to its end; call it again to go on.

    Each batch replaces its own folder; lanes take turns in the numbers, and share the parts of the state. The state holds the open
    sessions only.
    """

    def write(closed: DataFrame, batch_id: int) -> None:
        number = batch_id if lane is None else batch_id * len(LANES) + lane
        # Not a filter of the stream: that would be applied before the watermark is taken.
        closed.where("user_id IS NOT NULL").write.mode("overwrite").parquet(f"{out}/batch_id={number}")

    parts = STATE_PARTS if lane is None else -(-STATE_PARTS // len(LANES))
    run_to_end(stream_sessions(events, f"{gap_s} seconds", lateness), checkpoint, write, state_parts=parts)


def user_lane() -> Column:
    """The lane of an event, from 0: a user's events are all in one, and events without a user, which end no session, are dealt out."""
    return F.pmod(F.xxhash64(F.coalesce("user_id", "event_id")), F.lit(len(LANES))).cast("int")


def newest_row(events: DataFrame, later: timedelta = timedelta()) -> DataFrame:
    """One row without a user at the newest time, or ``later``: with it, a lane's watermark gets as far as that of all events."""
    last = events.agg((F.max("ts") + F.lit(later)).alias("_last"))
    empty = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != "ts" else F.col("_last").alias("ts") for f in events.schema]
    return last.where("_last IS NOT NULL").select(*empty)


def closing_row(events: DataFrame, gap_s: int) -> DataFrame:
    """One row without a user, so late that every session is over: the last thing to stage. Nothing on time can follow it."""
    return newest_row(events, timedelta(days=400, seconds=4 * gap_s))


def closed_sessions(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(f"{SESSIONS}, batch_id INT").parquet(out).drop("batch_id")


def late_events(admitted: DataFrame, closed: DataFrame) -> DataFrame:
    """``user_id, events, late``: admitted events of each user, and those that came after the watermark and are in no session."""
    all_ = admitted.where("user_id IS NOT NULL AND ts IS NOT NULL").groupBy("user_id").agg(F.count("*").alias("events"))
    kept = closed.groupBy(F.col("user_id").alias("_user")).agg(F.sum("n").alias("_n"))
    joined = all_.join(kept, F.col("user_id") == F.col("_user"), "left")
    return joined.select("user_id", "events", (F.col("events") - F.coalesce("_n", F.lit(0))).alias("late"))
