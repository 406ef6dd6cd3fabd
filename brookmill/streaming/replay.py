"""Replay of stored records as a rate-limited stream, with one idempotent sink per batch.

The file source is pulled: a batch admits a fixed number of files, and the next is not read before the last
one is committed. That bounds the rate and gives back-pressure without a queue.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmill.operators.skew import number_rows

TAKEN = 100_000
STATE_PARTS = 16
LANES = ("05", "16", "27", "38", "49")  # last digits of the numbers of a lane's parts
TICK = "tick-"
_starting = Lock()
PART = re.compile(r"part-(\d+)-(.+)-c(\d+)\.")


def rows_per_file(qps: float, interval_s: float, files_per_trigger: int = 1) -> int:
    """File size for a rate: rows/file x files/trigger / interval = records per second."""
    return max(1, int(qps * interval_s / files_per_trigger))


def replay_cap(df: DataFrame, order: Sequence[str], n: int = 10_000) -> DataFrame:
    """The first ``n`` records in replay order.

    Up to ``TAKEN``, each task keeps only its own first ``n``, and one task merges them. Beyond that, ranges of the order are numbered and cut,
    so that no task holds all of them; ``order`` must be unique then.
    """
    if n <= TAKEN:
        return df.orderBy(*order).limit(n)
    return number_rows(df, [], order, "_place").where(F.col("_place") <= n).drop("_place")


def stage(df: DataFrame, path: str, order: Sequence[str], rows: int, mode: str = "overwrite") -> None:
    """Write records in replay order as files of at most ``rows`` rows, by balanced ranges; ``append`` adds to those there."""
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode(mode)
        .option("maxRecordsPerFile", rows)
        .parquet(path)
    )


def _admission(spark: SparkSession, schema: str, files: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Files (place, time) one write after the other, each in the order of its parts; a first part without rows comes last in its write."""
    writes: dict[str, list[tuple[int, int, str, int]]] = {}
    for place, time in files:
        named = PART.match(place.rsplit("/", 1)[1])
        part, write, piece = (int(named[1]), named[2], int(named[3])) if named else (0, place, 0)
        writes.setdefault(write, []).append((part, piece, place, time))
    first = [parts[0][2] for parts in map(sorted, writes.values()) if len(parts) > 1 and parts[0][0] == 0]
    # Of an empty partition Spark writes a file only for part 0.
    filled = {r[0].rsplit("/", 1)[1] for r in spark.read.schema(schema).parquet(*first).select("_metadata.file_path").distinct().collect()} if first else set()
    bare = {place for place in first if place.rsplit("/", 1)[1] not in filled}
    in_time = sorted(writes.values(), key=lambda parts: min(p[3] for p in parts))
    return [(p[2], p[3]) for parts in in_time for p in sorted(parts, key=lambda p: (p[2] in bare, p))]


def keep_order(spark: SparkSession, path: str, schema: str) -> None:
    """Give the staged files modification times in replay order, which is the order in which the file source admits them.

    The tasks of a write end in any order, and so do the times of their files: a later range admitted first moves the watermark past the records of an
    earlier one. Only times that are out of order are changed. A file system that keeps no times set by hand is refused.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return
    found = [f for f in system.listStatus(folder) if f.isFile() and f.getPath().getName()[0] not in "_."]
    last, changed = -1, None
    for place, time in _admission(spark, schema, [(f.getPath().toString(), f.getModificationTime()) for f in found]):
        last = max(last + 1, time)
        if last != time:
            changed = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place), last
            system.setTimes(*changed, -1)
    if changed and system.getFileStatus(changed[0]).getModificationTime() != changed[1]:
        raise ValueError(f"{path}: this file system does not keep the order of staged files")


def read_stream(
    spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None, bytes_per_trigger: int | None = None, lane: str | None = None
) -> DataFrame:
    """Staged records as a stream that admits so many files, or files of so many bytes, to a batch.

    By bytes, a batch of wide records holds fewer of them; one file is always admitted, so stage files below the bound. Either limit may differ when
    the stream is started again from its checkpoint: it holds for what is admitted from then on. Files are admitted in replay order, see ``keep_order``.
    With ``lane``, only the files of its parts are: see ``run_lanes``.
    """
    if (files_per_trigger is None) == (bytes_per_trigger is None):
        raise ValueError("limit batches by files or by bytes")
    keep_order(spark, path, schema)
    limit = ("maxFilesPerTrigger", files_per_trigger) if bytes_per_trigger is None else ("maxBytesPerTrigger", bytes_per_trigger)
    reader = spark.readStream.schema(schema).option(*limit)
    if lane is not None:
        parts = [f"part-{'[0-9]' * digits}[{lane}]-*" for digits in (4, 5)]
        reader = reader.option("pathGlobFilter", "{" + ",".join([*parts, f"{TICK}*"]) + "}")
    return reader.parquet(path)


def side_by_side(spark: SparkSession, work: Callable[[int], None], lanes: Sequence[int]) -> None:
    """``work(lane)`` for all lanes at once, each in a thread of its own."""
    with ThreadPool(len(lanes)) as pool:
        pool.map(inheritable_thread_target(spark)(work), lanes, chunksize=1)


def run_lanes(spark: SparkSession, path: str, schema: str, files_per_trigger: int, run: Callable[[DataFrame, int], None]) -> None:
    """``run(stream, lane)`` for every lane of the staged records, side by side; each needs a checkpoint of its own.

    For work on single records only. A batch of a lane is no larger than that of one stream and costs the driver the same; while it does so for one lane, the
    executors work for the others. A lane is repeated alone after a failure.
    """
    lanes = [(read_stream(spark, path, schema, files_per_trigger, lane=digits), i) for i, digits in enumerate(LANES)]
    with ThreadPool(len(lanes)) as pool:
        pool.starmap(inheritable_thread_target(spark)(run), lanes, chunksize=1)


def tick(spark: SparkSession, path: str, schema: str, batches: int, files_per_trigger: int) -> None:
    """Add files without rows for ``batches`` more batches: work that waits for its batch gets one, in every lane."""
    places = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = places(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for _ in range(batches * files_per_trigger):
        made = f"{path}/_ticks/{uuid.uuid4().hex}"
        spark.createDataFrame([], schema).coalesce(1).write.parquet(made)
        part = next(f.getPath() for f in system.listStatus(places(made)) if f.getPath().getName().startswith("part-"))
        if not system.rename(part, places(f"{path}/{TICK}{part.getName()}")):
            raise OSError(f"{part}: not renamed")


def run_to_end(
    stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None], mode: str = "append", state_parts: int = STATE_PARTS
) -> None:
    """Run ``step`` on each micro-batch until the source as it is now has been read, and stop.

    A batch is bounded, and so is the number of parts that its state needs. Each part is a task of every batch that reports on all parts
    to the driver: two hundred parts would be 8 MB a batch. A stream that goes on keeps the parts it began with.
    """
    writer = stream.writeStream.foreachBatch(step).outputMode(mode).option("checkpointLocation", checkpoint)
    conf, parts = stream.sparkSession.conf, "spark.sql.shuffle.partitions"
    with _starting:
        before = conf.get(parts)
        conf.set(parts, str(min(int(before), state_parts)))
        try:
            query = writer.trigger(availableNow=True).start()  # takes a copy of the settings
        finally:
            conf.set(parts, before)
    try:
        query.awaitTermination()
    finally:
        query.stop()


def run_batches(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    partition_by: Sequence[str] = (),
    interval_s: float | None = None,
    lane: int | None = None,
) -> None:
    """Run ``transform`` on each micro-batch and write it to ``out/batch_id=N``; lanes take turns in the numbers.

    A batch is one Parquet write that replaces its own folder, so a batch repeated after a failure neither
    loses nor doubles records. With ``partition_by`` the kinds of record (say, good and dead) are folders
    of the same write and are committed together. The stored records are read to the end: at once, or
    with ``interval_s`` at the pace of one batch per interval.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        number = batch_id if lane is None else batch_id * len(LANES) + lane
        transform(batch).write.mode("overwrite").partitionBy(*partition_by).parquet(
            f"{out}/batch_id={number}"
        )

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if interval_s is None:
        query = writer.trigger(availableNow=True).start()
    else:
        query = writer.trigger(processingTime=f"{interval_s} seconds").start()
    try:
        if interval_s is None:
            query.awaitTermination()
        else:
            query.processAllAvailable()
    finally:
        query.stop()


def replay_records(
    df: DataFrame,
    schema: str,
    order: Sequence[str],
    path: str,
    transform: Callable[[DataFrame], DataFrame],
    qps: float = 200,
    max_records: int = 10_000,
    interval_s: float = 1.0,
    partition_by: Sequence[str] = (),
) -> str:
    """Replay the first ``max_records`` of ``df`` at ``qps`` records per second; the output path."""
    capped = replay_cap(df, order, max_records)
    stage(capped, f"{path}/in", order, rows_per_file(qps, interval_s))
    stream = read_stream(df.sparkSession, f"{path}/in", schema, files_per_trigger=1)
    run_batches(stream, f"{path}/out", f"{path}/state", transform, partition_by, interval_s)
    return f"{path}/out"
