"""Joins, numbering and percentiles that stay balanced when one key holds a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brookmill.session import materialise

BROADCAST_BYTES = 32 << 20
HOT_SHARE = 1_000
SALTS = 4_096


def _match(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, small: bool = False
) -> DataFrame:
    """Join on ``keys``, with null equal to null, as in a ``groupBy``.

    Only what is ``small`` is broadcast: a table that Parquet packs well may take a hundred times its file's size in the memory of each task.
    """
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    joined = left.join(F.broadcast(renamed) if small else renamed.hint("merge"), same, how)
    return joined.drop(*[f"_right_{k}" for k in keys])


def fits(df: DataFrame, limit: int) -> bool:
    """Do all values of ``df`` take at most ``limit`` bytes? A row counts 16 bytes and the length of its values as text."""
    size = F.lit(16) + sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    return (df.agg(F.sum(size)).first()[0] or 0) <= limit


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    weight: str,
    spread: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left-join the columns of ``dim`` to ``facts`` without sending a hot key to one task.

    ``dim`` has one row per key, is already materialised, and counts in ``weight`` how many rows of
    ``facts`` have that key. If it holds at most ``broadcast_bytes`` it is broadcast. Otherwise only
    the hot keys are: those with more rows than a shuffle partition holds on average, or than 1/1000 of all rows, if
    that is less. There are fewer of them than partitions, or than 1000. Their rows then pass through the second join under a random salt, spread by
    the columns of ``spread``, while all other keys meet in a normal shuffle join.
    """
    keys = list(keys)
    attributes = [c for c in dim.columns if c not in keys and c != weight]
    if fits(dim, broadcast_bytes):
        return _match(facts, dim.select(*keys, *attributes), keys, "left", small=True)

    found = F.struct(*attributes)
    total = dim.agg(F.sum(weight)).scalar()
    parts = max(HOT_SHARE, int(dim.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = dim.where(F.col(weight) * parts > total).select(*keys, found.alias("_hot"))
    salt = F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int") + 1
    )
    cold = dim.select(*keys, found.alias("_cold"), F.lit(0).alias("_salt"))
    salted = _match(facts, hot, keys, "left", small=True).withColumn("_salt", salt)
    joined = _match(salted, cold, [*keys, "_salt"], "left")
    result = F.coalesce("_hot", "_cold")
    return joined.select(*facts.columns, *[result[c].alias(c) for c in attributes])


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "row_no"
) -> DataFrame:
    """1-based number of each row within its key, by a unique order.

    Range partitioning cuts a hot key into as many ranges as its size needs. Each range is numbered
    alone; a key that continues from an earlier range adds the count so far. At most one key
    per range does, so the carried counts are broadcast: their number is below that of the ranges.
    """
    keys, order = list(keys), list(order)
    ranged = materialise(
        df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        ranged.groupBy(*keys, "_range")
        .agg(F.count("*").alias("_size"))
        .select(*keys, "_range", F.sum("_size").over(before).alias("_before"))
        .where("_before > 0")
    )
    local = F.row_number().over(W.partitionBy(*keys, "_range").orderBy(*order))
    number = F.col("_local") + F.coalesce("_before", F.lit(0))
    return _match(
        ranged.withColumn("_local", local), carried, [*keys, "_range"], "left", small=True
    ).select(*df.columns, number.cast("bigint").alias(name))


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[Column], sums: Sequence[str], suffix: str = "_upto") -> DataFrame:
    """Add, for each column of ``sums``, its sum over the rows of the key up to and with each row.

    ``order`` must be unique within a key. As in ``number_rows``, a large key lies in many ranges; each range is
    summed alone, and a key that continues from earlier ranges adds what they hold. At most one key per range does, so what is
    carried is broadcast.
    """
    keys = list(keys)
    ranged = materialise(
        df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    earlier = [F.sum(f"_s_{c}").over(before).alias(f"_before_{c}") for c in sums]
    carried = (
        ranged.groupBy(*keys, "_range")
        .agg(*[F.sum(c).alias(f"_s_{c}") for c in sums])
        .select(*keys, "_range", F.lag("_range").over(W.partitionBy(*keys).orderBy("_range")).alias("_earlier"), *earlier)
        .where("_earlier IS NOT NULL")
        .drop("_earlier")
    )
    local = W.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    summed = ranged.withColumns({f"_local_{c}": F.sum(c).over(local) for c in sums})
    upto = [(F.col(f"_local_{c}") + F.coalesce(f"_before_{c}", F.lit(0))).alias(f"{c}{suffix}") for c in sums]
    return _match(summed, carried, [*keys, "_range"], "left", small=True).select(*df.columns, *upto)


def exact_percentiles(
    df: DataFrame, by: str, value: str, shares: dict[str, float]
) -> DataFrame:
    """Exact, interpolated percentiles per group, one output column for each item of ``shares``.

    See ``range_counts`` and ``percentiles_of_counts``; null values are left out."""
    counted = range_counts(df.where(F.col(value).isNotNull()), by, value)
    return percentiles_of_counts(counted, by, value, shares)


def range_counts(df: DataFrame, by: str, value: str) -> DataFrame:
    """``by, value, _n, _range``: how often each value occurs in its group, in ordered ranges. Null values are kept."""
    return materialise(
        df.groupBy(by, value)
        .agg(F.count("*").alias("_n"))
        .repartitionByRange(by, value)
        .withColumn("_range", F.spark_partition_id()),
        "distinct-values",
    )


def percentiles_of_counts(counted: DataFrame, by: str, value: str, shares: dict[str, float]) -> DataFrame:
    """Percentiles from ``range_counts`` without null values.

    Equal values collapse to a count in the map tasks. The distinct values are then range-partitioned, so
    a large group lies in many ranges; range sizes tell which range holds a wanted rank, and
    only those ranges are sorted.
    """
    group = W.partitionBy(by)
    before = group.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sizes = (
        counted.groupBy(by, "_range")
        .agg(F.sum("_n").alias("_size"))
        .select(
            by,
            "_range",
            "_size",
            F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
            F.sum("_size").over(group).alias("_total"),
        )
    )

    def position(share: float) -> Column:
        return F.lit(share) * (F.col("_total") - 1)

    ranks = [f(position(s)).cast("bigint") for s in shares.values() for f in (F.floor, F.ceil)]
    wanted = sizes.where(
        F.exists(
            F.array(*ranks),
            lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_size")),
        )
    ).drop("_size")
    running = W.partitionBy(by, "_range").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    wanted = materialise(wanted, "wanted-ranges")
    small = fits(wanted, BROADCAST_BYTES)
    placed = _match(counted, wanted, [by, "_range"], "inner", small).withColumn(
        "_upto", F.col("_before") + F.sum("_n").over(running)
    )

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("_upto") > rank.cast("bigint"), F.col(value)))

    picked = placed.groupBy(by).agg(
        F.max("_total").alias("_total"),
        *[at(F.floor(position(s))).alias(f"_lo_{c}") for c, s in shares.items()],
        *[at(F.ceil(position(s))).alias(f"_hi_{c}") for c, s in shares.items()],
    )
    return picked.select(
        by,
        *[
            (
                F.col(f"_lo_{c}")
                + (F.col(f"_hi_{c}") - F.col(f"_lo_{c}"))
                * (position(s) - F.floor(position(s)))
            ).alias(c)
            for c, s in shares.items()
        ],
    )
