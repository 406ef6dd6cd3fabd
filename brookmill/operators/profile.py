"""Aggregates of the behaviour log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmill.functions.numbers import cents, rounded
from brookmill.operators.skew import lookup, percentiles_of_counts, range_counts
from brookmill.session import materialise

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def money_sum(column: str) -> Column:
    """Sum of amounts, each rounded to cents, in whole cents: exact, and the same in any order."""
    return F.sum(cents(F.col(column))) / 100


def etl_daily(events: DataFrame) -> DataFrame:
    """``dt, event_type, n, users, amount``.

    Spark shuffles the distinct count by (day, type, user) first, so a busy day is spread by user.
    """
    return events.groupBy(F.to_date("ts").alias("dt"), "event_type").agg(
        F.count("*").alias("n"),
        F.countDistinct("user_id").alias("users"),
        money_sum("value").alias("amount"),
    )


def log_stats(events: DataFrame, by: str = "event_type", value: str = "value") -> DataFrame:
    """``n, min, max, avg, sd`` and the exact ``p25, p50, p95`` of each group.

    The log is scanned once, for the counts of its distinct values; all else comes from these. The squared
    deviations are summed around the mean, which is known by then.
    """
    counted = range_counts(events, by, value)
    n = F.when(F.col(value).isNotNull(), F.col("_n"))
    sums = counted.groupBy(by).agg(
        F.count("*").alias("_values"),
        F.coalesce(F.sum(n), F.lit(0)).alias("n"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        (F.sum(F.col(value) * n) / F.sum(n)).alias("avg"),
    )
    sums = materialise(sums, "group-sums")
    means = sums.select(by, "_values", F.col("avg").alias("_mean"))
    deviation = F.sum(n * F.pow(F.col(value) - F.col("_mean"), 2)).alias("_squares")
    squares = lookup(counted, means, [by], "_values", [value]).groupBy(F.col(by).alias("_group")).agg(deviation)
    moments = sums.join(squares, F.col(by).eqNullSafe(F.col("_group")), "left").select(
        by,
        "n",
        "min",
        "max",
        rounded(F.col("avg")).alias("avg"),
        rounded(F.when(F.col("n") > 1, F.sqrt(F.col("_squares") / (F.col("n") - 1)))).alias("sd"),
    )
    shares = {"p25": 0.25, "p50": 0.5, "p95": 0.95}
    ranks = percentiles_of_counts(counted.where(F.col(value).isNotNull()), by, value, shares)
    ranks = ranks.select(F.col(by).alias("_by"), *[rounded(F.col(c)).alias(c) for c in shares])
    return moments.join(ranks, F.col(by).eqNullSafe(F.col("_by")), "left").drop("_by")


def user_features(events: DataFrame, event_types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """One row per user: activity, one count per event type, mean value, share of night events.

    Shuffled by (user, day) before (user), because of the distinct day count.
    """
    night = F.sum((F.hour("ts") < 6).cast("bigint"))
    return events.groupBy("user_id").agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col("event_type") == t).alias(f"n_{t}") for t in event_types],
        F.countDistinct(F.to_date("ts")).alias("active_days"),
        rounded(money_sum("value") / F.count("value")).alias("mean_value"),
        rounded(night / F.count("*")).alias("night_share"),
    )
