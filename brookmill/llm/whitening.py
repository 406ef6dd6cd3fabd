"""Whitening of vectors by refined eigenvectors of their covariance.

Entries become integers, so that all sums over the vectors are exact, whatever the order in which Spark adds them:

1. One pass adds up the vectors, a second one the products of their differences from the rounded mean. Both are summed in the
   tasks first; the driver gets one number per pair of dimensions.
2. The driver takes eigenvectors of the covariance in single precision and refines them by the iteration of Ogita and
   Aishima: a few matrix products in extended precision double the right digits each time. Where eigenvalues lie too close to be told
   apart, the iteration can only keep their vectors orthogonal; the covariance within the space of such a cluster, shifted by the mean
   eigenvalue, is then solved on its own.
3. A third pass projects every vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, StructType

from brookmill.llm.vectors import common_length, lists, map_arrow, whole_rows
from brookmill.session import materialise

SCALE, SHIFT = 1024, 100_000
LARGEST = 1 << 24
EXACT = 1 << 53  # integers below are exact in doubles
ROUNDS = 30
SUB_SOLVES = 3  # what is still a cluster after so many has equal eigenvalues, as far as the digits tell
MAX_LENGTH = 4_096
Wide = np.longdouble


def integers(values: np.ndarray) -> np.ndarray:
    """``floor(1024 * c) + 100000`` of every entry, as exact doubles."""
    out = np.floor(SCALE * values)
    if out.size and np.abs(out).max() >= LARGEST:
        raise ValueError(f"entries must be below {LARGEST // SCALE} in absolute value")
    return out + SHIFT


def wide(value: int) -> np.longdouble:
    """An integer of any size in extended precision."""
    high = float(value)
    return Wide(high) + Wide(float(value - int(high)))


def products(z: np.ndarray) -> np.ndarray:
    """``z.T @ z`` of integers, exactly, as an array of Python's integers.

    Rows are multiplied in blocks so short that no sum leaves the exact range of doubles.
    """
    size = z.shape[1]
    total = np.zeros((size, size), object)
    largest = max(1, int(np.abs(z).max(initial=0))) ** 2
    block = max(1, EXACT // largest)
    for at in range(0, len(z), block):
        part = z[at : at + block]
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One iteration: better vectors, their eigenvalues, the distance below which these are not told apart, the size of the change."""
    r = np.eye(len(a), dtype=Wide) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    doubt = 2 * (np.linalg.norm((s - np.diag(values)).astype(float)) + np.linalg.norm(a.astype(float)) * np.linalg.norm(r.astype(float)))
    gaps = values[None, :] - values[:, None]
    near = np.abs(gaps) <= doubt
    change = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gaps))
    return x + x @ change, values, doubt, float(np.abs(change).max())


def _clusters(values: np.ndarray, doubt: float) -> list[np.ndarray]:
    """Places of eigenvalues that hang together by gaps of at most ``doubt``; two or more each."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > doubt) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix in extended precision.

    The sign makes a vector's largest entry positive. Equal eigenvalues get some orthonormal basis of their space.
    """
    size = float(np.abs(a).max(initial=0))
    if not size:
        return np.zeros(len(a), Wide), np.eye(len(a), dtype=Wide)
    a = a / Wide(size)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(Wide)
    solved = 0
    for _ in range(ROUNDS):
        x, values, doubt, change = _step(a, x)
        if change > 1e-6:
            continue
        clusters = _clusters(values, doubt) if solved < SUB_SOLVES else []
        if change < 1e-17 * len(a) and not clusters:
            break
        for cluster in clusters:
            own = x[:, cluster]
            middle = values[cluster].mean()
            inner = own.T @ (a @ own - middle * own)
            scale = np.abs(inner).max()
            if scale > 0:
                turned = np.linalg.eigh(((inner + inner.T) / (2 * scale)).astype(float))[1]
                x[:, cluster] = own @ turned.astype(Wide)
        solved += bool(clusters)
    x = x / np.sqrt((x * x).sum(axis=0))
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order], values[order]
    signs = np.sign(x[np.abs(x).argmax(axis=0), np.arange(len(a))])
    return values * Wide(size), x * signs


@dataclass
class Whitening:
    n: int
    sums: list[int]  # of the integer entries, per dimension
    values: np.ndarray  # eigenvalues of the covariance, falling
    vectors: np.ndarray  # dimensions x components
    trace: float

    @property
    def middle(self) -> np.ndarray:
        """The mean rounded to whole numbers: what is subtracted before multiplying."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], float)

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) if self.trace else 0.0 for e in self.values]

    def rows(self, z: np.ndarray) -> tuple[list[Decimal], np.ndarray]:
        """Of differences ``z`` from ``middle``: exact squared deviations times n squared, and whitened components."""
        n = self.n
        rest = np.array([s - n * int(m) for s, m in zip(self.sums, self.middle)], object)
        whole = z.astype(np.int64)
        squares, crossed = (whole * whole).sum(axis=1), whole @ _narrow(rest, whole)
        constant = int((rest * rest).sum())
        exact = [Decimal(n * n * int(q) - 2 * n * int(c) + constant) for q, c in zip(squares, crossed)]
        spread = np.sqrt(self.values.astype(float))
        flat = self.values <= self.values.max(initial=0) * 1e-15
        scale = np.where(flat, 0.0, 1 / np.where(flat, 1.0, spread))
        return exact, (z - (rest / n).astype(float)) @ self.vectors.astype(float) * scale


def _narrow(rest: np.ndarray, z: np.ndarray) -> np.ndarray:
    """``rest`` as 64-bit integers where no sum of products with ``z`` can leave their range."""
    bound = int(np.abs(z).max(initial=0)) * sum(abs(r) for r in rest)
    return rest.astype(np.int64) if bound < 1 << 62 else rest


def _totals(df: DataFrame, keys: list[str], value: str) -> list:
    return df.groupBy(*keys).agg(F.sum(value).alias(value)).collect()


def fit(df: DataFrame, length: int | None = None, components: int = 8, vector: str = "embedding") -> Whitening | None:
    """Mean, covariance and its first eigenvectors over all whole vectors of ``df``; None if there are none.

    A vector is whole if it has ``length`` entries (by default the commonest length), none null or non-finite. Others are left
    out; repeated rows count as often as they stand there. There are at most ``MAX_LENGTH`` dimensions, since the driver
    holds a number per pair of them, and entries must be below 16384 in absolute value; otherwise a ``ValueError`` says so.
    """
    length = length or common_length(df, vector)
    if length is None:
        return None
    if length > MAX_LENGTH:
        raise ValueError(f"{length} dimensions; at most {MAX_LENGTH} are supported")
    column = df.select(df[vector].alias("_vector"))
    whole = pa.decimal128(38, 0)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        n, total = 0, np.zeros(length, object)
        for batch in batches:
            x = integers(whole_rows(batch.column(0), length)[1])
            n, total = n + len(x), total + x.sum(axis=0).astype(np.int64).astype(object)
        if n:
            yield [pa.array([-1, *range(length)], pa.int32()), pa.array(list(map(Decimal, [n, *total])), whole)]

    found = {row.i: int(row.s) for row in _totals(map_arrow(column, sums, "i INT, s DECIMAL(38,0)"), ["i"], "s")}
    if not found:
        return None
    model = Whitening(found[-1], [found[i] for i in range(length)], np.zeros(0), np.zeros((length, 0)), 0.0)
    middle = model.middle
    upper = np.triu_indices(length)

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        total = np.zeros((length, length), object)
        for batch in batches:
            total += products(integers(whole_rows(batch.column(0), length)[1]) - middle)
        places = [pa.array(u, pa.int32()) for u in upper]
        yield [*places, pa.array(list(map(Decimal, total[upper])), whole)]

    n, rest = model.n, [s - model.n * int(m) for s, m in zip(model.sums, middle)]
    covariance = np.zeros((length, length), Wide)
    for row in _totals(map_arrow(column, squares, "i INT, j INT, s DECIMAL(38,0)"), ["i", "j"], "s"):
        covariance[row.i, row.j] = covariance[row.j, row.i] = wide(n * int(row.s) - rest[row.i] * rest[row.j]) / wide(n * n)
    values, vectors = eigenvectors(covariance)
    model.values, model.vectors = values[:components].clip(0), vectors[:, :components]
    model.trace = float(np.trace(covariance))
    return model


def whiten(df: DataFrame, model: Whitening, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id, deviation, whitened`` of every whole vector of ``df``, without a shuffle.

    ``deviation`` is the exact sum of ``(n * x - S) ** 2`` over the dimensions as a DECIMAL(38,0). ``whitened`` has one entry per
    component; it is 0 for a component along which the fitted vectors do not vary. Vectors that are not whole have no row; null and
    repeated ids and other columns are of no consequence.
    """
    schema = StructType().add(id, df.schema[id].dataType).add("deviation", DecimalType(38, 0)).add("whitened", ArrayType(DoubleType()))
    length, middle = len(model.sums), model.middle

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            places, values = whole_rows(batch.column(1), length)
            deviation, projected = model.rows(integers(values) - middle)
            yield [
                batch.column(0).take(pa.array(places)),
                pa.array(deviation, pa.decimal128(38, 0)),
                lists(projected, pa.float64()),
            ]

    return map_arrow(df.select(df[id], df[vector].alias("_vector")), work, schema)


def identity_error(whitened: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity; null-free rows of ``whiten``."""
    w = [F.col("whitened")[i] for i in range(components)]
    means = whitened.agg(*[F.avg(c) for c in w]).first()
    centred = [c - F.lit(m) for c, m in zip(w, means)]
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    found = whitened.agg(*[F.avg(centred[i] * centred[j]) for i, j in pairs]).first()
    return max(abs(value - (i == j)) for (i, j), value in zip(pairs, found))


RESULT = "component INT, n LONG, deviation LONG, whitened DOUBLE, explained DOUBLE, identity_error DOUBLE"


def whitened_components(df: DataFrame, components: int = 8, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per whole vector and component: ``id, component, n, deviation, whitened, explained, identity_error``.

    ``deviation`` is null where it is too large for a long. Without any whole vector there are no rows.
    """
    model = fit(df, components=components, vector=vector)
    schema = StructType([df.schema[id], *StructType.fromDDL(RESULT).fields])
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    rows = materialise(whiten(df, model, id, vector), "whitened")
    error = identity_error(rows, len(model.values))
    shares = F.array(*[F.lit(e) for e in model.explained])
    each = rows.select(id, "deviation", F.posexplode("whitened").alias("_place", "_whitened"))
    return each.select(
        id,
        (F.col("_place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        F.col("_whitened").alias("whitened"),
        shares[F.col("_place")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
