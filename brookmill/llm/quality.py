"""Quality by a regularised quadratic discriminant over transformed document statistics.

Each class is a normal distribution. Its covariance is shrunk towards the pooled one and that towards its
diagonal, so that it stays invertible with few rows. A score is the difference of two log densities, each a
Mahalanobis distance by a Cholesky factor that is computed once per model.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from math import log
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brookmill.llm.common import Rows, map_batches

STATISTICS = (
    "length", "word_length", "distinct_words", "same_neighbours", "top_word", "distinct_lines",
    "symbols", "digits", "capitals", "bars", "sentences", "short_words",
)
_SYMBOLS = str.maketrans("", "", "#$%&*@^~=+<>{}[]\\/_`")
_DIGITS = str.maketrans("", "", "0123456789")
_CAPITALS = str.maketrans("", "", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def statistics(text: str) -> list[float]:
    """The ``STATISTICS`` of a whole text: shares as log odds, amounts as logarithms."""
    words, n = text.split(), len(text)
    n_words = len(words)
    lines = text.split("\n")

    def share(part: float, whole: float) -> float:
        return log((part + 0.5) / (whole - part + 0.5))

    counts = Counter(words)
    return [
        log(n + 1),
        log((n + 1) / (n_words + 1)),
        share(len(counts), n_words),
        share(sum(map(eq, words, words[1:])), n_words),
        share(max(counts.values(), default=0), n_words),
        share(len(set(lines)), len(lines)),
        share(n - len(text.translate(_SYMBOLS)), n),
        share(n - len(text.translate(_DIGITS)), n),
        share(n - len(text.translate(_CAPITALS)), n),
        share(text.count("|"), n),
        share(text.count(". ") + text.count(".\n"), n_words + 1),
        share(sum(k for w, k in counts.items() if len(w) < 4), n_words),
    ]


def with_statistics(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """``id``, the columns of ``keep`` and one double per statistic, for every row. A null text counts as empty."""
    kept = docs.select(id, *[c.alias(name) for name, c in (keep or {}).items()], F.col(text).alias("_text"))
    names = kept.columns[:-1]
    schema = StructType(kept.schema.fields[:-1])
    for name in STATISTICS:
        schema = schema.add(name, "double")

    def work(batches: Rows) -> Rows:
        for batch in batches:
            values = [statistics(t or "") for t in batch["_text"]]
            columns = [[v[i] for v in values] for i in range(len(STATISTICS))]
            yield {c: batch[c] for c in names} | dict(zip(STATISTICS, columns))

    return map_batches(kept, work, schema)


@dataclass
class Discriminant:
    means: np.ndarray
    factors: np.ndarray  # inverse Cholesky factors
    offsets: np.ndarray  # log prior - log determinant / 2, per class
    scale: float = 1.0

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Of class 1, for each row."""
        density = [
            offset - 0.5 * np.square((x - mean) @ factor.T).sum(axis=1)
            for mean, factor, offset in zip(self.means, self.factors, self.offsets)
        ]
        return 1 / (1 + np.exp(-np.clip((density[1] - density[0]) * self.scale, -500, 500)))


def fit(rows: DataFrame, label: str, shrink: float = 0.3, ridge: float = 0.05) -> Discriminant:
    """Fit on all rows of ``with_statistics`` that have label 0 or 1; other labels are not used.

    Counts, sums and products are summed by Spark, in the map tasks first, so that the driver gets one row
    per class. With no rows of a class, its mean is that of the other and the score is the prior.
    """
    size = len(STATISTICS)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    sums = (
        rows.where(F.col(label).isin(0, 1))
        .groupBy(F.col(label).cast("int").alias("_class"))
        .agg(
            F.count("*").alias("n"),
            F.array(*[F.sum(c) for c in STATISTICS]).alias("s"),
            F.array(*[F.sum(F.col(STATISTICS[i]) * F.col(STATISTICS[j])) for i, j in pairs]).alias("p"),
        )
        .collect()
    )
    n, total, product = np.zeros(2), np.zeros((2, size)), np.zeros((2, size, size))
    for row in sums:
        n[row._class], total[row._class] = row.n, row.s
        for (i, j), value in zip(pairs, row.p):
            product[row._class, i, j] = product[row._class, j, i] = value
    everything = max(1.0, n.sum())
    shared = total.sum(axis=0) / everything
    means = np.array([total[k] / n[k] if n[k] else shared for k in (0, 1)])
    scatter = [product[k] - n[k] * np.outer(means[k], means[k]) if n[k] else np.zeros((size, size)) for k in (0, 1)]
    pooled = (scatter[0] + scatter[1]) / everything
    spread = np.diag(product.sum(axis=0) / everything - np.outer(shared, shared)).clip(1e-6)
    factors, offsets = [], []
    for k in (0, 1):
        own = scatter[k] / n[k] if n[k] else pooled
        trust = (1 - shrink) * n[k] / (n[k] + size)
        covariance = trust * own + (1 - trust) * pooled + ridge * np.diag(spread)
        lower = np.linalg.cholesky(covariance)
        factors.append(np.linalg.inv(lower))
        offsets.append(log((n[k] + 1) / (n.sum() + 2)) - np.log(np.diag(lower)).sum())
    if not n.all():
        factors, offsets = [factors[0]] * 2, [log((n[k] + 1) / (n.sum() + 2)) for k in (0, 1)]
    return Discriminant(means, np.array(factors), np.array(offsets))


def score(rows: DataFrame, model: Discriminant, keep: list[str], threshold: float = 0.3) -> DataFrame:
    """The columns of ``keep``, ``score`` (probability of label 1) and ``predicted`` for rows of statistics."""
    schema = rows.select(*keep).schema
    schema = StructType(schema.fields).add("score", "double").add("predicted", "integer")

    def work(batches: Rows) -> Rows:
        for batch in batches:
            x = np.array([batch[c] for c in STATISTICS], dtype=float).T.reshape(-1, len(STATISTICS))
            p = model.probability(x)
            yield {c: batch[c] for c in keep} | {"score": p.tolist(), "predicted": (p >= threshold).astype(int).tolist()}

    return map_batches(rows.select(*keep, *STATISTICS), work, schema)
