"""Cleaning, de-identification and dead-letter split of the behaviour log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

EMAIL = r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+\.[A-Za-z]+"
PHONE = r"\+?\d[\d ()-]{7,}\d"

# (reason, condition) in order of precedence: the first that holds names the reason.
LOG_RULES = (
    ("null_user", "user_id IS NULL OR try_cast(user_id AS BIGINT) IS NULL"),
    ("bad_value", "try_cast(value AS DOUBLE) IS NULL"),
    ("bad_id", "try_cast(event_id AS BIGINT) IS NULL"),
    ("bad_time", "try_cast(ts AS TIMESTAMP_NTZ) IS NULL"),
)


def clean_log(raw: DataFrame) -> DataFrame:
    """Typed log from an all-text one: rows that break a rule out, event type trimmed, one row per event.

    What is left out here is what ``dlq_split`` sends to the dead letters, by the same rules, or a copy. Exact
    copies are combined in the map tasks. Of different rows with one id the smallest is kept, so the
    result does not depend on task order; they are sorted once, by the reading side.
    """
    typed = classify(raw).where("status = 'ok'").select(
        F.expr("try_cast(event_id AS BIGINT)").alias("event_id"),
        F.expr("try_cast(ts AS TIMESTAMP_NTZ)").alias("ts"),
        F.expr("try_cast(user_id AS BIGINT)").alias("user_id"),
        F.trim("event_type").alias("event_type"),
        F.expr("try_cast(value AS DOUBLE)").alias("value"),
        "props",
        F.expr("try_cast(get_json_object(props, '$.k') AS INT)").alias("k"),
    ).distinct()
    rest = [c for c in typed.columns if c != "event_id"]
    ordered = W.partitionBy("event_id").orderBy(*rest)
    # Not a row number: a filter on one would sort in the map tasks as well.
    first = F.lag("event_id").over(ordered).isNull()
    return typed.withColumn("_first", first).where("_first").drop("_first")


def deidentify(df: DataFrame, column: str, salt: str, name: str = "user_token") -> DataFrame:
    """Replace an identifier by a salted hash; equal ids get equal tokens.

    The salt must be secret: who knows it can hash all numbers and so read a token back.
    """
    token = F.sha2(F.concat(F.lit(salt), F.col(column).cast("string")), 256)
    return df.select(token.alias(name), *[c for c in df.columns if c != column])


def mask_text(df: DataFrame, column: str = "text") -> DataFrame:
    """Replace e-mail addresses and phone-like numbers in free text."""
    masked = F.regexp_replace(F.regexp_replace(column, EMAIL, "<email>"), PHONE, "<phone>")
    return df.withColumn(column, masked)


def classify(raw: DataFrame, rules: Sequence[tuple[str, str]] = LOG_RULES) -> DataFrame:
    """Add ``status`` (ok or dlq) and ``reason`` (empty for ok): a projection, no shuffle."""
    reason: Column = F.coalesce(
        *[F.when(F.expr(condition), F.lit(name)) for name, condition in rules], F.lit("")
    )
    return raw.withColumn("reason", reason).withColumn(
        "status", F.when(F.col("reason") == "", F.lit("ok")).otherwise(F.lit("dlq"))
    )


def dlq_split(
    raw: DataFrame, rules: Sequence[tuple[str, str]] = LOG_RULES
) -> tuple[DataFrame, DataFrame]:
    """Good records, and failed ones as dead letters: a record that breaks a rule fails at its first attempt."""
    marked = classify(raw, rules)
    ok = marked.where("status = 'ok'").drop("status", "reason")
    return ok, dead_letters(marked.where("status = 'dlq'"), raw.columns, F.col("reason"), F.lit(1))


def dead_letters(records: DataFrame, columns: Sequence[str], reason: Column, attempt: Column) -> DataFrame:
    """``reason, payload, attempt``: the whole record as JSON text, and the number of the attempt that failed."""
    payload = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]))
    return records.select(reason.alias("reason"), payload.alias("payload"), attempt.cast("bigint").alias("attempt"))


def split_counts(marked: DataFrame) -> DataFrame:
    """``status, reason, n``: the counts behind "in = ok + dlq"."""
    return marked.groupBy("status", "reason").agg(F.count("*").alias("n"))
