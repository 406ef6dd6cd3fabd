"""Retries inside a stream: failed records come back after a delay, and only then become dead letters.

The feedback is a table. A micro-batch writes the records that failed in it to a folder named by the batch in which they are due; that
batch reads the folder and tries them again beside its new records. Every pending record is so written once and read once,
however long the stream. Good records, dead letters and pending ones of a batch are one write that replaces the batch's folder, and a batch reads only
folders of earlier, committed ones: repeated after a failure, it does the same again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmill.operators.cleaning import LOG_RULES, classify
from brookmill.sources.files import existing
from brookmill.streaming.replay import run_to_end

SPENT = "out_of_retries"


def delays(max_attempts: int, base: float = 1.0, factor: float = 2.0, cap: float = 60.0) -> list[int]:
    """Batches to wait after each failed attempt but the last: exponential back-off in whole batches, one at least."""
    return [max(1, ceil(min(cap, base * factor**n))) for n in range(max_attempts - 1)]


def outcomes(
    tried: DataFrame, batch_id: int, columns: Sequence[str], works: Column, waits: Sequence[int], rules: Sequence[tuple[str, str]]
) -> DataFrame:
    """``columns, attempt, reason, payload, kind, due`` of every record tried in a batch.

    ``kind`` is ``ok``, ``retry`` (with the batch in which it is ``due``) or ``dead``: a record that breaks a rule is dead at its first attempt, one
    that never ``works`` after its last.
    """
    marked = classify(tried, rules)
    broken, last = F.col("reason") != "", F.col("attempt") > len(waits)
    kind = F.when(broken, "dead").when(F.coalesce(works, F.lit(False)), "ok").when(last, "dead").otherwise("retry")
    wait = F.get(F.array(*map(F.lit, [*waits, 0])), F.col("attempt") - 1)
    named = marked.select(
        *columns,
        "attempt",
        F.when(broken, F.col("reason")).when((kind == "dead"), F.lit(SPENT)).otherwise("").alias("reason"),
        kind.alias("kind"),
        F.when(kind == "retry", F.lit(batch_id) + wait).otherwise(0).alias("due"),
    )
    letter = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]))
    return named.withColumn("payload", F.when(F.col("kind") == "dead", letter))


def result_schema(schema: str) -> str:
    return f"{schema}, attempt INT, reason STRING, payload STRING"


def due_records(spark: SparkSession, out: str, batch_id: int, schema: str, waits: Sequence[int]) -> DataFrame | None:
    """Records that failed in an earlier batch and are due now, with the number of the attempt that is next."""
    folders = existing(spark, [f"{out}/batch_id={batch_id - w}/kind=retry/due={batch_id}" for w in sorted(set(waits)) if w <= batch_id])
    if not folders:
        return None
    found = spark.read.schema(result_schema(schema)).parquet(*folders)
    return found.drop("reason", "payload").withColumn("attempt", F.col("attempt") + 1)


def run_with_retries(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    schema: str,
    works: Callable[[Column], Column],
    max_attempts: int = 3,
    rules: Sequence[tuple[str, str]] = LOG_RULES,
) -> None:
    """Try every record of ``stream``, up to ``max_attempts`` times; ``works`` says by the attempt whether one succeeds.

    Reads the source as it is now to its end; call it again, with the same folders, to go on. What is still pending then waits for its batch: see
    ``replay.tick`` and ``delays``.
    """
    waits, columns = delays(max_attempts), stream.columns

    def step(batch: DataFrame, batch_id: int) -> None:
        tried = batch.withColumn("attempt", F.lit(1))
        back = due_records(batch.sparkSession, out, batch_id, schema, waits)
        if back is not None:
            tried = tried.unionByName(back)
        done = outcomes(tried, batch_id, columns, works(F.col("attempt")), waits, rules)
        done.write.mode("overwrite").partitionBy("kind", "due").parquet(f"{out}/batch_id={batch_id}")

    run_to_end(stream, checkpoint, step)


def finished(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """The records that are done: good ones and dead letters, with the batch that ended them."""
    found = spark.read.schema(f"{result_schema(schema)}, batch_id INT, kind STRING, due INT").parquet(out)
    return found.where("kind <> 'retry'").drop("due")


def dead_letter_rows(done: DataFrame) -> DataFrame:
    """``reason, payload, attempt`` of the dead ones, as the batch form stores them; see ``cleaning.dead_letters``."""
    return done.where("kind = 'dead'").select("reason", "payload", F.col("attempt").cast("bigint").alias("attempt"))
