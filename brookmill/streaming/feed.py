"""A live feed for a dashboard: counts that a stream keeps up to date.

The counts are the state of a streaming aggregation, so a batch costs by its own rows and not by those before. In update mode a batch gives
just the groups that it changed. They are merged into a snapshot of the feed, which is one folder per batch, made from the snapshot
before: repeated after a failure, a batch writes the same again. Only the two latest snapshots are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from brookmill.functions.numbers import instant, rounded, wall_clock
from brookmill.sources.files import existing, remove
from brookmill.streaming.replay import run_to_end


def run_feed(counts: DataFrame, by: Sequence[str], out: str, checkpoint: str) -> StructType:
    """Keep the feed of ``counts``, a streaming aggregation to ``n`` by ``by``, up to the end of its source as it is now.

    Call it again with the same folders to go on. Returns the schema of the snapshots, for ``read_feed``.
    """
    by = list(by)
    schema = StructType([counts.schema[c] for c in [*by, "n"]]).add("updated", LongType())

    def upsert(changed: DataFrame, batch_id: int) -> None:
        rows = changed.select(*by, "n", F.lit(batch_id).cast("long").alias("updated"))
        before = existing(changed.sparkSession, [f"{out}/batch_id={batch_id - 1}"])
        if before:
            rows = rows.unionAll(changed.sparkSession.read.schema(schema).parquet(*before).select(*rows.columns))
        latest = rows.groupBy(*by).agg(F.max_by("n", "updated").alias("n"), F.max("updated").alias("updated"))
        latest.coalesce(1).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        remove(changed.sparkSession, f"{out}/batch_id={batch_id - 2}")

    run_to_end(counts, checkpoint, upsert, "update")
    return schema


def read_feed(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """The latest snapshot: the columns of ``by``, ``n``, and the batch that changed the group last."""
    rows = spark.read.schema(StructType(schema.fields[:]).add("batch_id", LongType())).parquet(out)
    return rows.where(F.col("batch_id") == rows.agg(F.max("batch_id")).scalar()).drop("batch_id")


def charts(feed: DataFrame, by: str, label: str) -> DataFrame:
    """``chart, key, label, n, share``: the two charts of a feed by category and label.

    ``category`` has a row per category with its share of all records; ``label`` a row per category and label, without unlabelled records.
    """
    by_category = feed.groupBy(by).agg(F.sum("n").alias("n"))
    total = by_category.agg(F.sum("n")).scalar()
    kind = feed.schema[label].dataType
    first = by_category.select(
        F.lit("category").alias("chart"), F.col(by).alias("key"), F.lit(None).cast(kind).alias("label"), "n", rounded(F.col("n") / total).alias("share")
    )
    none = F.lit(None).cast("double").alias("share")
    second = feed.where(F.col(label).isNotNull()).select(F.lit("label").alias("chart"), F.col(by).alias("key"), F.col(label).alias("label"), "n", none)
    return first.unionAll(second)


def windowed_counts(events: DataFrame, by: str, length: str = "1 day", lateness: str = "2 days") -> DataFrame:
    """``start, by, n``: streaming counts per window of event time; windows that the watermark has passed are closed.

    The state holds open windows only. A record for a closed window is late and not counted; ``with_late`` tells how many.
    """
    timed = events.select(instant(F.col("ts")).alias("_at"), by).withWatermark("_at", lateness)
    return timed.groupBy(F.window("_at", length).alias("_w"), by).agg(F.count("*").alias("n")).select(
        wall_clock(F.col("_w.start")).alias("start"), by, "n"
    )


def with_late(admitted: DataFrame, feed: DataFrame, start: Column, by: str) -> DataFrame:
    """``start, by, n, late``: of all admitted records of a window and group, those in the feed and those that came too late."""
    all_ = admitted.groupBy(start.alias("start"), by).agg(F.count("*").alias("_all"))
    counted = feed.select("start", F.col(by).alias("_by"), F.col("start").alias("_start"), F.col("n").alias("_n")).drop("start")
    joined = all_.join(counted, (F.col("start") == F.col("_start")) & F.col(by).eqNullSafe(F.col("_by")), "left")
    n = F.coalesce("_n", F.lit(0))
    return joined.select("start", by, n.alias("n"), (F.col("_all") - n).alias("late"))
