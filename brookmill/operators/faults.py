"""Retries of failed work: numbering, back-off and the final state of each task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, TimestampNTZType

from brookmill.functions.numbers import backoff_delay
from brookmill.operators.skew import BROADCAST_BYTES, lookup, number_rows
from brookmill.session import materialise


def retry_numbers(
    attempts: DataFrame,
    task: Sequence[str],
    order: Sequence[str],
    ok: str = "ok",
    base: float = 1.0,
    factor: float = 2.0,
    cap: float = 60.0,
) -> DataFrame:
    """Number each task's attempts and give the back-off delay that follows a failed one."""
    numbered = number_rows(attempts.select(*task, *order, ok), task, order, "attempt")
    delay = F.when(~F.col(ok), backoff_delay(F.col("attempt"), base, factor, cap))
    return numbered.withColumn("delay_s", delay)


def retry_ledger(
    attempts: DataFrame,
    task: Sequence[str],
    order: Sequence[str],
    ok: str = "ok",
    max_failures: int = 3,
    base: float = 1.0,
    factor: float = 2.0,
    cap: float = 60.0,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``attempts, failures, status, next_delay_s`` of each task.

    Attempts after the first success do not count. ``dlq`` from ``max_failures`` failures on, even if a
    success follows; else ``ok`` after a success, else ``pending`` with the delay before the next try.
    Two aggregates with map-side combine around one balanced lookup replace a window, which
    would sort all attempts of a hot task in one place.
    """
    task = list(task)
    place = packed_order(attempts, order)
    tried = attempts.select(*task, *order, ok)
    firsts = materialise(
        tried.groupBy(*task).agg(
            F.count("*").alias("_n"), F.min(F.when(F.col(ok), place)).alias("_first_ok")
        ),
        "first-success",
    )
    counted = (
        lookup(tried, firsts, task, "_n", order, broadcast_bytes)
        .where(F.col("_first_ok").isNull() | (place <= F.col("_first_ok")))
        .groupBy(*task)
        .agg(
            F.count("*").alias("attempts"),
            F.count_if(~F.col(ok)).alias("failures"),
            F.max(ok).alias("_done"),
        )
    )
    status = (
        F.when(F.col("failures") >= max_failures, "dlq")
        .when(F.col("_done"), "ok")
        .otherwise("pending")
    )
    delay = backoff_delay(F.col("failures"), base, factor, cap)
    return (
        counted.withColumn("status", status)
        .withColumn("next_delay_s", F.when(F.col("status") == "pending", delay))
        .drop("_done")
    )


def packed_order(df: DataFrame, order: Sequence[str]) -> Column:
    """Columns to order by as one value.

    A time and a whole number are packed into one DECIMAL(38, 0), which has a fixed width: its minimum needs
    no sort, unlike that of a struct. Other columns become a struct.
    """
    kinds = [df.schema[c].dataType for c in order]
    if len(kinds) != 2 or not isinstance(kinds[0], TimestampNTZType) or not isinstance(kinds[1], LongType):
        return F.struct(*order)
    since = (F.col(order[0]) - F.expr("TIMESTAMP_NTZ'0001-01-01 00:00:00'")).cast("interval second")
    micros = (since.cast("decimal(18,6)") * F.lit(1_000_000)).cast("decimal(18,0)")
    number = F.col(order[1]).cast("decimal(20,0)") + F.expr("9223372036854775808BD")
    return (micros * F.expr("100000000000000000000BD") + number).cast("decimal(38,0)")


def dead_tasks(ledger: DataFrame) -> DataFrame:
    """Tasks that go to the dead-letter store."""
    return ledger.where("status = 'dlq'")


def retried_to_death(
    records: DataFrame, task: Sequence[str], order: Sequence[str], ok: str = "ok", max_failures: int = 3
) -> DataFrame:
    """The failed records of tasks that are out of retries, with all columns and the number of their ``attempt``.

    Attempts after a task's first success do not count, as in ``retry_ledger``.
    """
    task = list(task)
    numbered = number_rows(records, task, order, "attempt").where(~F.col(ok))
    dead = dead_tasks(retry_ledger(records, task, order, ok, max_failures)).select(*task, F.col("attempts").alias("_counted"))
    failures = numbered.groupBy(*task).agg(F.count("*").alias("_n"))
    same = reduce(Column.__and__, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in task])
    sized = dead.alias("a").join(failures.alias("b"), same).select(*[f"a.{c}" for c in task], "_n", "_counted")  # a row per task
    found = lookup(numbered, materialise(sized, "dead-tasks"), task, "_n", order)
    return found.where(F.col("attempt") <= F.col("_counted")).drop("_counted")
