"""Clustering of vectors around centroids, with an n-simplex filter before exact distances.

The distances of a vector to a few pivots are worked out once. They make the vector the apex of a simplex over the pivots: its
coordinates are those of its projection into the space of the pivots, and its height over that space. For two
apexes, the distance of the vectors lies between that of the apexes on the same side and that with one of them mirrored to the other side.

So each round compares short apexes first: a centroid whose lower bound exceeds the smallest upper bound cannot be the
nearest. Only the others are compared in exact integers, ties going to the smaller number. Tasks send sums and counts per
centroid, never vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from brookmill.llm.vectors import lists, map_arrow, matrix, whole_rows
from brookmill.session import materialise

SCALE = 256
LARGEST = 1 << 27  # of an integer entry: squared distances over 64 dimensions stay within 64 bits
PIVOTS = 16
FLAT = 1e-4  # pivots lower than this over the others' space, as a share of the longest distance squared, are not used
SLACK = 1e-6
BLOCK = 4_096


def integers(values: np.ndarray) -> np.ndarray:
    """``floor(256 * x)`` of every entry."""
    out = np.floor(SCALE * values)
    if out.size and np.abs(out).max() >= LARGEST:
        raise ValueError(f"entries must be below {LARGEST // SCALE} in absolute value")
    return out.astype(np.int64)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all of ``y``."""
    return np.stack([np.square(x - row).sum(axis=1) for row in y], axis=1) if len(y) else np.zeros((len(x), 0), np.int64)


@dataclass
class Simplex:
    """Pivots in general position, and the map from distances to coordinates over the first pivot."""

    pivots: np.ndarray
    inverse: np.ndarray  # of the triangular matrix of the pivots' own coordinates
    base: np.ndarray  # squared distances of the other pivots to the first

    def apexes(self, x: np.ndarray) -> np.ndarray:
        """Coordinates of each row's projection, then its height, then its squared distance to the first pivot."""
        q = squared(x, self.pivots).astype(float)
        flat = (q[:, :1] + self.base - q[:, 1:]) / 2 @ self.inverse.T
        height = np.sqrt((q[:, 0] - np.square(flat).sum(axis=1)).clip(0))
        return np.column_stack([flat, height, q[:, 0]])


def simplex(candidates: np.ndarray, most: int = PIVOTS) -> Simplex:
    """Up to ``most`` pivots among ``candidates``: the first one, then always the one highest over the space of those before."""
    q = squared(candidates, candidates).astype(float)
    gram = (q[:1] + q[:1].T - q) / 2  # inner products of the differences from the first
    heights, chosen, rows = np.diag(gram).copy(), [], np.zeros((0, len(candidates)))
    longest = max(1.0, heights.max(initial=0))
    while len(chosen) < min(most, len(candidates)) - 1 and heights.max() > FLAT * longest:
        best = int(heights.argmax())
        row = (gram[best] - rows[:, best] @ rows) / np.sqrt(heights[best])
        rows, heights = np.vstack([rows, row]), heights - row * row
        heights[[*chosen, best]] = 0
        chosen.append(best)
    lower = rows[:, chosen].T  # row i: coordinates of pivot i
    return Simplex(candidates[[0, *chosen]], np.linalg.inv(np.tril(lower)), q[0, chosen])


def nearest(x: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, base: Simplex) -> tuple[np.ndarray, np.ndarray]:
    """Number and exact squared distance of each row's nearest centroid; the smaller number among equals.

    The bounds are widened by ``SLACK`` times the lengths involved, far more than rounding can amount to.
    """
    own = base.apexes(centroids)
    number, distance = np.empty(len(x), np.int32), np.empty(len(x), np.int64)
    for at in range(0, len(x), BLOCK):
        part, rows = apexes[at : at + BLOCK], x[at : at + BLOCK]
        flat = np.square(part[:, :-2]).sum(axis=1)[:, None] - 2 * part[:, :-2] @ own[:, :-2].T + np.square(own[:, :-2]).sum(axis=1)
        slack = SLACK * (part[:, -1:] + own[:, -1]) + 1e-3
        high, low = np.square(part[:, -2:-1] + own[:, -2]), np.square(part[:, -2:-1] - own[:, -2])
        reach = (flat + high + slack).min(axis=1)
        near = flat + low - slack <= reach[:, None]
        best = np.full(len(rows), np.iinfo(np.int64).max)
        which = np.zeros(len(rows), np.int32)
        for c in range(len(centroids)):  # rising numbers: only a smaller distance replaces an earlier one
            open_ = np.flatnonzero(near[:, c])
            found = np.square(rows[open_] - centroids[c]).sum(axis=1)
            closer = found < best[open_]
            best[open_[closer]], which[open_[closer]] = found[closer], c
        number[at : at + BLOCK], distance[at : at + BLOCK] = which, best
    return number, distance


def first_centroids(df: DataFrame, k: int, length: int, salt: str, id: str, vector: str) -> np.ndarray:
    """The ``k`` whole vectors with the smallest hashes of ``salt:id``, in that order; null ids last, ties by the vector."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col(id).cast("string")), 256)
    rows = df.select(key.alias("_key"), vector).orderBy(F.asc_nulls_last("_key"), vector).limit(k).collect()
    return integers(np.array([row[vector] for row in rows], float).reshape(-1, length))


def with_apexes(df: DataFrame, base: Simplex, length: int, id: str, vector: str) -> DataFrame:
    """``id, _vector, _apex`` of every whole vector: what all rounds read."""
    schema = StructType().add(id, df.schema[id].dataType).add("_vector", ArrayType(DoubleType())).add("_apex", ArrayType(DoubleType()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            places, values = whole_rows(batch.column(1), length)
            apexes = base.apexes(integers(values))
            yield [batch.column(0).take(pa.array(places)), lists(values, pa.float64()), lists(apexes, pa.float64())]

    return map_arrow(df.select(df[id], df[vector].alias("_vector")), work, schema)


def _looked_up(batch: pa.RecordBatch, centroids: np.ndarray, base: Simplex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Integer vectors of a batch of ``with_apexes``, and the number and distance of their nearest centroids."""
    x = integers(matrix(batch.column("_vector"), centroids.shape[1]))
    apexes = matrix(batch.column("_apex"), len(base.pivots) + 1)
    return x, *nearest(x, apexes, centroids, base)


def moved(rows: DataFrame, centroids: np.ndarray, base: Simplex) -> np.ndarray:
    """The floor of the mean of the vectors nearest to each centroid; a centroid without vectors stays."""
    k, length = centroids.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        sums, counts = np.zeros((k, length), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x, number, _ = _looked_up(batch, centroids, base)
            np.add.at(sums, number, x)
            counts += np.bincount(number, minlength=k)
        used = np.flatnonzero(counts)
        each = np.repeat(used, length), np.tile(np.arange(length), len(used)), sums[used].ravel(), np.repeat(counts[used], length)
        yield [pa.array(c) for c in each]

    parts = map_arrow(rows.select("_vector", "_apex"), work, "cluster INT, place INT, s LONG, n LONG")
    totals = parts.groupBy("cluster", "place").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    out = centroids.copy()
    for row in totals.collect():  # a number per centroid and dimension
        out[row.cluster, row.place] = int(row.s) // row.n
    return out


def assigned(rows: DataFrame, centroids: np.ndarray, base: Simplex, id: str) -> DataFrame:
    """``id, cluster, distance`` of every row of ``with_apexes``, without a shuffle."""
    schema = StructType().add(id, rows.schema[id].dataType).add("cluster", "integer").add("distance", "long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            _, number, distance = _looked_up(batch, centroids, base)
            yield [batch.column(0), pa.array(number), pa.array(distance)]

    return map_arrow(rows, work, schema)


def cluster(
    df: DataFrame, k: int, length: int, rounds: int, salt: str, id: str = "vec_id", vector: str = "embedding"
) -> tuple[DataFrame, np.ndarray]:
    """``id, cluster, distance`` of every whole vector, and the integer centroids after ``rounds`` rounds.

    A vector is whole if it has exactly ``length`` entries, none null or non-finite; others have no row. Repeated rows
    count as often as they stand there; a null id is assigned, but becomes a first centroid last. With fewer than ``k`` whole
    vectors there are as many centroids; with none, none and no rows. Other columns, of whatever name, are of no
    consequence. Entries must be below 524288 in absolute value; otherwise a ``ValueError`` says so.
    """
    entry = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    named = df.select(df[id].alias("_id"), df[vector].alias("_vector"))
    whole = named.where((F.size("_vector") == length) & F.forall("_vector", entry))
    centroids = first_centroids(whole, k, length, salt, "_id", "_vector")
    schema = StructType().add(id, df.schema[id].dataType).add("cluster", "integer").add("distance", "long")
    if not len(centroids):
        return df.sparkSession.createDataFrame([], schema), centroids
    base = simplex(centroids)
    rows = materialise(with_apexes(named, base, length, "_id", "_vector"), "apexes")
    for _ in range(rounds):
        centroids = moved(rows, centroids, base)
    return assigned(rows, centroids, base, "_id").withColumnRenamed("_id", id), centroids


def cluster_digests(
    df: DataFrame, k: int, length: int, rounds: int, salt: str, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every whole vector; see ``cluster``.

    A sum of distances that is too large for a long is null.
    """
    spark = df.sparkSession
    found, centroids = cluster(df, k, length, rounds, salt, id, vector)
    rows = materialise(found, "clusters")
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    per_cluster = {row.cluster: int(row.s) for row in sums}
    total = sum(per_cluster.values())
    digests = [sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    long = lambda n: n if abs(n) < 1 << 63 else None
    facts = [(c, long(n), long(total), digests[c]) for c, n in per_cluster.items()]
    table = spark.createDataFrame(facts, "_cluster INT, cluster_inertia LONG, inertia LONG, centroid_sha256 STRING")
    joined = rows.join(F.broadcast(table), F.col("cluster") == F.col("_cluster"))  # at most k rows
    return joined.select(id, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
