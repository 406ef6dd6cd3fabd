"""Toxicity by a factorization machine over hashed terms.

Every distinct word of a text is one hashed feature, and so is its beginning. The score is a bias, a weight per feature, and for each
pair of features the product of their latent vectors: a pair may tell more than its two words alone. The sum
over all pairs is taken in linear time, as half of (square of the sum - sum of the squares). Which terms are learnt at all is
decided by the loss on rows that were kept back: only those that tell alone, or all of them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from math import exp, log
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brookmill.llm.common import Rows, map_batches

BUCKET_BITS = 18
FACTORS = 4
SAMPLE = 20_000
BEGINNINGS = (3, 5)  # inflected and compound words share them
_WORD = re.compile(r"\w+")


def terms(text: str) -> np.ndarray:
    """Sorted distinct buckets of the lower-cased words and of their beginnings."""
    shift = 32 - BUCKET_BITS
    words = set(_WORD.findall(text.lower()))
    found = words.union(*({f"{w[:n]}-" for w in words if len(w) > n} for n in BEGINNINGS))
    return np.unique(np.array([crc32(t.encode()) >> shift for t in found], np.int32))


@dataclass
class FactorizationMachine:
    bias: float
    weights: np.ndarray  # buckets
    latent: np.ndarray  # buckets x factors

    def margin(self, features: np.ndarray) -> float:
        v = self.latent[features]
        total = v.sum(axis=0)
        return float(self.bias + self.weights[features].sum() + 0.5 * (total @ total - (v * v).sum()))

    def probability(self, features: np.ndarray) -> float:
        return 1 / (1 + exp(-min(max(self.margin(features), -60), 60)))


def telling(rows: list[np.ndarray], labels: np.ndarray, rarest: int = 3, least: float = 2.5) -> np.ndarray:
    """Which buckets occur in the two classes at rates whose log ratio is over ``least`` standard errors."""
    size = 1 << BUCKET_BITS
    inside, outside = (
        np.bincount(np.concatenate([rows[i] for i in np.flatnonzero(labels == k)]), minlength=size) for k in (1, 0)
    )
    ratio = np.log((inside + 0.5) / (labels.sum() + 1)) - np.log((outside + 0.5) / ((1 - labels).sum() + 1))
    error = np.sqrt(1 / (inside + 0.5) + 1 / (outside + 0.5))
    return (inside + outside >= rarest) & (np.abs(ratio) > least * error)


def occurring(rows: list[np.ndarray], labels: np.ndarray, rarest: int = 3) -> np.ndarray:
    """Which buckets occur in at least ``rarest`` rows, whatever they tell alone."""
    return np.bincount(np.concatenate(rows), minlength=1 << BUCKET_BITS) >= rarest


def train(rows: list[np.ndarray], labels: np.ndarray, epochs: int = 10, rate: float = 0.15, decay: float = 1e-4) -> FactorizationMachine:
    """Logistic loss, adaptive gradient steps one row at a time, in an order fixed by the seed.

    Two sets of terms are tried, each learnt on four fifths of the rows and measured by its loss on the rest: those that tell alone, and
    all that occur in several rows. The better one is learnt on all rows. With the first, the many neutral words of a long text
    neither outvote a few strong ones nor are learnt by heart; with the second, words of which only pairs tell are learnt too.
    """
    if not 0 < labels.sum() < len(labels):
        return descend(rows, labels, np.zeros(1 << BUCKET_BITS, bool), epochs, rate, decay)
    part = np.arange(len(rows)) % 5 == 0
    kept, left = ([rows[i] for i in np.flatnonzero(p)] for p in (~part, part))
    choices = [telling, occurring]
    if len(set(labels[~part])) > 1 and len(left):
        losses = [loss(descend(kept, labels[~part], c(kept, labels[~part]), epochs, rate, decay), left, labels[part]) for c in choices]
        choices = [choices[int(np.argmin(losses))]]
    return descend(rows, labels, choices[0](rows, labels), epochs, rate, decay)


def loss(model: FactorizationMachine, rows: list[np.ndarray], labels: np.ndarray) -> float:
    """Mean logistic loss."""
    p = np.array([model.probability(r) for r in rows]).clip(1e-6, 1 - 1e-6)
    return float(-np.log(np.where(labels > 0, p, 1 - p)).mean())


def descend(rows: list[np.ndarray], labels: np.ndarray, used: np.ndarray, epochs: int, rate: float, decay: float) -> FactorizationMachine:
    """Learn the weights and latent vectors of the buckets in ``used``; all others stay zero."""
    size = 1 << BUCKET_BITS
    random = np.random.default_rng(7)
    positive = float(labels.sum())
    model = FactorizationMachine(
        log((positive + 1) / (len(labels) - positive + 1)), np.zeros(size, np.float32), np.zeros((size, FACTORS), np.float32)
    )
    if not 0 < positive < len(labels):
        return model
    model.latent[used] = random.normal(0, 0.01, (int(used.sum()), FACTORS))
    rows = [r[used[r]] for r in rows]
    w, v = model.weights, model.latent
    w_seen, v_seen = np.full(size, 1e-2, np.float32), np.full((size, FACTORS), 1e-2, np.float32)
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            x = rows[i]
            own = v[x]
            total = own.sum(axis=0)
            error = model.probability(x) - labels[i]
            model.bias -= 0.01 * error
            if abs(error) < 1e-3:
                continue
            step = error + decay * w[x]
            w_seen[x] += step * step
            w[x] -= rate * step / np.sqrt(w_seen[x])
            step = error * (total - own) + decay * own
            v_seen[x] += step * step
            v[x] -= rate * 0.2 * step / np.sqrt(v_seen[x])
    return model


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> FactorizationMachine:
    """A machine fitted on at most ``sample`` labelled rows, those whose ids have the smallest hashes.

    The bound makes one training task enough; labels are read and counted everywhere else by Spark. Null ids, labels
    other than 0 and 1, and labels of unknown documents teach nothing; a repeated label counts again.
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1))
        .where(F.col(id).isNotNull())
        .select(F.col(id).alias("_id"), F.col(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(sample)
    )
    texts = docs.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    labelled = texts.join(F.broadcast(chosen), "_id")  # at most `sample` narrow rows

    def hashed(batches: Rows) -> Rows:
        for batch in batches:
            yield {"id": batch["_id"], "label": batch["_label"], "terms": [terms(t).tobytes() for t in batch["_text"]]}

    def learn(batches: Rows) -> Rows:
        rows, marks = [], []
        for batch in batches:
            rows += [np.frombuffer(t, np.int32) for t in batch["terms"]]
            marks += batch["label"]
        model = train(rows, np.array(marks, float))
        yield {"bias": [model.bias], "weights": [model.weights.tobytes()], "latent": [model.latent.tobytes()]}

    features = map_batches(labelled, hashed, "id BIGINT, label INT, terms BINARY")
    single = features.repartition(1).sortWithinPartitions("id", "label", "terms")
    row = map_batches(single, learn, "bias DOUBLE, weights BINARY, latent BINARY").first()
    if row is None:  # no labelled row at all
        return train([], np.zeros(0))
    return FactorizationMachine(
        row.bias, np.frombuffer(row.weights, np.float32), np.frombuffer(row.latent, np.float32).reshape(-1, FACTORS)
    )


def score(
    docs: DataFrame,
    model: FactorizationMachine,
    id: str = "doc_id",
    text: str = "text",
    threshold: float = 0.7,
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """``id``, the columns of ``keep``, ``score`` and ``predicted`` of every row, without a shuffle.

    A null or empty text has no terms and gets the score of the bias alone.
    """
    rows = docs.select(id, *[c.alias(name) for name, c in (keep or {}).items()], F.col(text).alias("_text"))
    names = rows.columns[:-1]
    schema = StructType(rows.schema.fields[:-1]).add("score", "double").add("predicted", "integer")
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Rows) -> Rows:
        machine = broadcast.value
        for batch in batches:
            p = [machine.probability(terms(t or "")) for t in batch["_text"]]
            yield {c: batch[c] for c in names} | {"score": p, "predicted": [int(x >= threshold) for x in p]}

    return map_batches(rows, work, schema)


def drop_toxic(docs: DataFrame, model: FactorizationMachine, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``threshold``."""
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def clean(texts):
        machine = broadcast.value
        return texts.map(lambda t: machine.probability(terms(t or "")) < threshold).astype(bool)

    return docs.where(clean(F.col(text)))
